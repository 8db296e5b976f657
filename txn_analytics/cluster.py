"""Session settings, and the two places where a plan is materialised on purpose."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores="*", partitions: int = 8, app: str = "txn_analytics") -> SparkSession:
    """Session for tests and the bench. A cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def work_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: ``spark.checkpoint.dir``, else a folder in the warehouse.

    Both are shared by the driver and the executors. The same rule holds for local and cluster sessions.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return (shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into the work folder, so that several readers do not each rescan the fact."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a table in the work folder."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the work folder and reads it back: readers then get only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_lookup(df: DataFrame, lookup: DataFrame, on: list[str], most_rows: int = 20_000) -> DataFrame:
    """Left join rows to a per-group lookup, without shuffling the rows if the lookup proves to be small.

    The lookup is computed once, here, and at most ``most_rows + 1`` of its rows are fetched. Up to
    ``most_rows`` it is broadcast. Beyond that it is joined as it is, and Spark picks the join (adaptive
    execution splits a hot key there). Keys match null-safely: a NULL key is a group like any other.
    """
    head = lookup.limit(most_rows + 1).collect()
    if len(head) <= most_rows:
        lookup = F.broadcast(df.sparkSession.createDataFrame(head, lookup.schema))
    for key in on:
        lookup = lookup.withColumnRenamed(key, f"_{key}")
    matches = [df[key].eqNullSafe(lookup[f"_{key}"]) for key in on]
    return df.join(lookup, matches, "left").drop(*[f"_{key}" for key in on])
