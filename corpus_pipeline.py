"""From raw documents to token ids: rules, near duplicates, decontamination, personal data, encoding.

Every stage is (spark, docs, folder) -> DataFrame over all documents that the stage before kept, and is written as
Parquet before the next one reads it. All but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txn_analytics.cluster import saved
from txn_analytics.llm import decontaminate, near_duplicates, pieces, pii, quality_rules
from txn_analytics.llm.queries import PIECES, read_model, read_table


#: Rows of a batch between the JVM and Python. Whole texts travel, some of them very long: the default of 10,000 rows
#: would hold tens of megabytes several times over in every task.
BATCH_ROWS = 1000


def _in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _packed(docs: DataFrame) -> DataFrame:
    """The text, and all other columns in one, so that no name can clash with what an operator adds."""
    return docs.select(F.struct(*[name for name in docs.columns if name != "text"]).alias("_row"), "text")


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if name == "text" else F.col("_row")[name].alias(name) for name in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules keep; the language references are those of all documents given."""
    _in_small_batches(spark)
    judged = quality_rules.quality_rules(
        _packed(docs), quality_rules.learn_references(docs), ["_row", "text"], lang="_row.lang")
    return _unpacked(judged.filter("kept"), docs)


def deduplicate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows that share the id of a kept document are copies of it by the contract of the table; all but one go. Rows
    without an id are in no group and stay.
    """
    _in_small_batches(spark)
    kept = near_duplicates.near_duplicates(docs).filter("id = component").select("id").distinct()
    one = docs.filter("doc_id IS NOT NULL").join(kept, docs["doc_id"] == kept["id"], "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.filter("doc_id IS NULL"))


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    _in_small_batches(spark)
    hits = decontaminate.contamination(_packed(docs), read_table(spark, folder, "benchmark"), ["_row", "text"])
    return _unpacked(hits.filter("n_hit = 0"), docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, personal data replaced by its kind. ``n_chars`` is that of the new text."""
    _in_small_batches(spark)
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Ids of every text, and what they decode to."""
    _in_small_batches(spark)
    coded = pieces.encode_and_decode(docs, read_model(PIECES))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", deduplicate),
    ("decontamination", decontaminated),
    ("personal data", without_personal_data),
    ("encoding", encoded),
]

#: Learnt references, minhashes, EM and merges are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
