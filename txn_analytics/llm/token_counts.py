"""Token counts from the exact histogram of encoded lengths.

Documents are encoded once and counted by length; the counts are written as a table. Everything asked about a context
limit then comes from suffix sums over the lengths, of which there are at most as many as the longest document has tokens.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txn_analytics.cluster import saved
from txn_analytics.llm.pieces import SLICE_BYTES, vocabulary
from txn_analytics.llm.words import steps

BLOCK = 1024     # lengths that are summed together first


def encoded_lengths(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """One row ``n_tokens`` for each document, the end id included. A NULL or empty text has 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in (part for whole in batches for part in steps(whole, "text", SLICE_BYTES)):
            yield pa.RecordBatch.from_arrays([pc.list_value_length(words.encode(batch.column("text"))).cast(pa.int64())], ["n_tokens"])
    return docs.select(F.col(text).alias("text")).mapInArrow(run, "n_tokens bigint")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs) and suffix sums for every length that occurs.

    docs_at_least and tokens_at_least belong to documents of that length or more; tokens_truncated is what is
    left of all documents if each is cut at that length; docs_up_to is the rank that quantiles need. Rows with a
    NULL length are not counted. An empty table gives no rows. The sums are taken over blocks of lengths first,
    so no task sorts all lengths.
    """
    counts = lengths.filter("n_tokens IS NOT NULL").groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    counts = saved(counts, "lengths").withColumns({
        "block": F.floor(F.col("n_tokens") / BLOCK), "tokens": F.col("n_tokens") * F.col("n_docs")})
    blocks = counts.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    above, below = (Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1) for order in (F.desc("block"), F.asc("block")))
    blocks = blocks.select("block", *[
        F.coalesce(F.sum(f"block_{x}").over(w), F.lit(0)).alias(f"{x}_{side}")
        for x in ("docs", "tokens") for side, w in (("above", above), ("below", below))])
    up = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    down = Window.partitionBy("block").orderBy("n_tokens")
    rows = counts.join(blocks, "block").withColumns({
        "docs_at_least": F.sum("n_docs").over(up) + F.col("docs_above"),
        "tokens_at_least": F.sum("tokens").over(up) + F.col("tokens_above"),
        "docs_up_to": F.sum("n_docs").over(down) + F.col("docs_below"),
        "tokens_up_to": F.sum("tokens").over(down) + F.col("tokens_below")})
    return rows.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "docs_up_to",
        (F.col("tokens_up_to") - F.col("tokens") + F.col("n_tokens") * F.col("docs_at_least")).alias("tokens_truncated"))


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_longer, tokens_kept) for each limit: tokens left when every document is cut at it.

    Both follow from the suffix sums at the least length above the limit. An empty histogram gives zeros.
    """
    total = histogram.agg(F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("total"))
    asked = F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("limit")
    above = histogram.select("n_tokens", "docs_at_least", "tokens_at_least", asked).filter("n_tokens > limit").groupBy("limit").agg(
        F.min_by(F.struct("docs_at_least", "tokens_at_least"), "n_tokens").alias("s"))
    return total.select("total", asked).join(above, "limit", "left").select(
        "limit", F.coalesce("s.docs_at_least", F.lit(0)).alias("docs_longer"),
        (F.col("total") - F.coalesce("s.tokens_at_least", F.lit(0)) + F.col("limit") * F.coalesce("s.docs_at_least", F.lit(0)))
        .alias("tokens_kept"))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that at least this share of the documents does not exceed."""
    total = histogram.agg(F.sum("n_docs")).scalar()
    rows = histogram.select("n_tokens", "docs_up_to", F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share"))
    return rows.filter(F.col("docs_up_to") >= F.col("share") * total).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
