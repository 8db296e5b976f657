"""Reading and writing the model's tables."""

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txn_analytics.functions.dates import as_date
from txn_analytics.functions.values import completed_or_pending

BAD_LINE = "_bad_line"


def _typed(field: T.StructField):
    """The text of a column in its declared type; NULL if it does not fit."""
    text = F.trim(field.name)
    if isinstance(field.dataType, T.DateType):
        return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")
    return F.col(field.name) if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of CSV files with a header, in the declared types, and apart from them the lines that do not fit.

    Returns (rows, rejected); rejected rows are text and keep their line in ``_bad_line``. Nothing is inferred,
    and a header that names other columns, or the same in another order, is an error. Values are read as text
    and converted here: were the reader to convert, a query that skips a column would not see its bad values.
    """
    text = T.StructType([T.StructField(name, T.StringType()) for name in [*schema.fieldNames(), BAD_LINE]])
    lines = (
        spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE).option("enforceSchema", False).csv(path)
    )
    fits = F.col(BAD_LINE).isNull()
    for field in schema.fields:
        fits = fits & (F.col(field.name).isNull() | _typed(field).isNotNull())
    rows = lines.filter(fits).select(*[_typed(field).alias(field.name) for field in schema.fields])
    line = F.coalesce(BAD_LINE, F.to_csv(F.struct(*schema.fieldNames())))
    return rows, lines.filter(~fits).withColumn(BAD_LINE, line)


def tidy_text(df: DataFrame) -> DataFrame:
    """Trims text columns, and writes the status in its canonical case, so that comparisons may be binary."""
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            df = df.withColumn(field.name, F.trim(field.name))
    return df.withColumn("status", F.initcap("status")) if "status" in df.columns else df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _month_number(day) -> Column:
    return F.year(day) * 100 + F.month(day)


def _by_month(df: DataFrame) -> DataFrame:
    """Rows with the month that names their folder, dealt so that large months are split.

    Rows are not gathered by month first (one month may hold a third of them): Spark sizes the output partitions.
    """
    return df.withColumn("load_month", _month_number(F.col("date"))).hint("rebalance", "load_month")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by_month: bool = True) -> None:
    """Writes a table, facts in one folder per month so that a date filter opens only its months.

    An overwrite is written beside the table and put in its place at the end: if the job fails, the old table stays.
    """
    if by_month and "date" in df.columns:
        writer = _by_month(df).write.partitionBy("load_month")
    else:
        writer = df.write
    if mode != "overwrite":
        writer.mode(mode).parquet(path)
        return
    staged = staging_path(path)
    writer.parquet(staged)
    publish(df.sparkSession, staged, path)


def replace_months(df: DataFrame, path: str) -> None:
    """Puts the rows in place of all rows that the table has for their months; other months stay as they are.

    Loading the same rows again changes nothing. All files are written to a staging folder first and moved when the
    whole job has succeeded (dynamic partition overwrite), so a load that fails leaves every month as it was. Rows
    without a date are a month of their own. ``df`` must not read the months that it replaces from the same table.
    """
    _by_month(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_month").parquet(path)


def staging_path(path: str) -> str:
    """A new folder next to ``path``. Its name begins with an underscore: readers of the parent pass over it."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_{name}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Puts a finished folder in the place of ``path``: the old one is moved aside, the new one in, the old one deleted.

    Two renames, each atomic where the file system's are. If the second fails, the old folder is moved back.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    new, place, old = hadoop.Path(staged), hadoop.Path(path), hadoop.Path(staging_path(path))
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(place.getParent())
    had = system.exists(place)
    if had and not system.rename(place, old):
        raise OSError(f"{path} cannot be moved aside")
    if not system.rename(new, place):
        if had:
            system.rename(old, place)
        raise OSError(f"{staged} cannot be moved to {path}")
    if had:
        system.delete(old, True)


def extract(txn: DataFrame, first, last) -> DataFrame:
    """Non-failed rows with a date from ``first`` to ``last``, both included."""
    rows = txn.filter(completed_or_pending() & F.col("date").between(as_date(first), as_date(last)))
    if "load_month" in txn.columns:
        rows = rows.filter(F.col("load_month").between(*[_month_number(as_date(day)) for day in (first, last)]))
    return rows


def month_predicates(months: list[tuple[str, str]], column: str = "date") -> list[str]:
    """Conditions that share out all rows among queries: one for each (first day, first day of the next month).

    The months must follow each other. Rows before the first, after the last and without a date have conditions of their
    own, so that every row meets exactly one.
    """
    if any(after != first for (_, after), (first, _) in zip(months, months[1:])):
        raise ValueError("months do not follow each other")
    inside = [f"{column} >= '{first}' AND {column} < '{after}'" for first, after in months]
    if not months:
        return ["1 = 1"]
    return [f"{column} < '{months[0][0]}'", *inside, f"{column} >= '{months[-1][1]}'", f"{column} IS NULL"]


def read_jdbc(spark: SparkSession, url: str, table: str, months: list[tuple[str, str]], **options) -> DataFrame:
    """A fact table from a database, in one query per month and three for all other rows."""
    return spark.read.jdbc(url, table, predicates=month_predicates(months), properties=options)


def result_folder(folder: str, as_of) -> str:
    """Where everything of a report of that date goes."""
    return f"{folder}/as_of={str(as_of).replace('-', '')}"


def write_results(results: Mapping[str, DataFrame], folder: str, as_of, kind: str = "parquet") -> dict[str, str]:
    """Saves each result as its own dataset under ``as_of=YYYYMMDD``. Returns their paths."""
    paths = {name: f"{result_folder(folder, as_of)}/{name}" for name in results}
    for name, df in results.items():
        df.write.mode("overwrite").option("header", True).format(kind).save(paths[name])
    return paths


MANIFEST = "manifest"


def write_results_at_once(results: Mapping[str, DataFrame], folder: str, as_of, kind: str = "parquet") -> dict[str, str]:
    """``write_results`` that shows all results of a date together or none.

    Results are written to a staging folder, then counted in ``manifest`` (result, rows), and one rename makes the
    staging folder the folder of the date. Where a result fails there is no such folder, or the one of an earlier run.
    """
    if not results:
        return {}
    place = result_folder(folder, as_of)
    staged = staging_path(place)
    counts = []
    for name, df in results.items():
        df.write.option("header", True).format(kind).save(f"{staged}/{name}")
        written = df.sparkSession.read.schema(df.schema).option("header", True).format(kind).load(f"{staged}/{name}")
        counts.append((name, written.count()))
    spark = next(iter(results.values())).sparkSession
    spark.createDataFrame(counts, "result string, rows bigint").coalesce(1).write.parquet(f"{staged}/{MANIFEST}")
    publish(spark, staged, place)
    return {name: f"{place}/{name}" for name in [*results, MANIFEST]}


PLACE = "_place"


def write_ordered(df: DataFrame, path: str, order: list, kind: str = "parquet") -> None:
    """Writes rows so that the files, taken by name, hold them in order; no task has more than its range of the order.

    ``order`` has to end in a unique key, so that equal values can be spread over several files. Ranges have about even
    numbers of rows. An old table stays until the new one is complete.
    """
    staged = staging_path(path)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.option("header", True).format(kind).save(staged)
    publish(df.sparkSession, staged, path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_ordered`` with ``_place``, (file, row of the file), by which its rows are in order."""
    return spark.read.parquet(path).select(
        "*", F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")).alias(PLACE))
