"""Order-dependent results over inputs that must not meet in one task.

A plain ``OVER (ORDER BY ...)`` brings all rows to one task, and ``PARTITION BY`` a group that holds a
third of the data is not much better. Here rows are range-partitioned by the sort order into blocks of
even size, each block is numbered on its own, and what the blocks before it contribute is added from a
summary with one row per block and group. The blocks are materialised, since a second range shuffle
would sample other cut points. The same code runs for every size of input.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txn_analytics.cluster import join_lookup, materialise

# Up to so many rows of a block summary are broadcast.
MOST_OFFSETS = 100_000


@dataclass(frozen=True)
class Rank:
    """A column with the place of each row by falling value: in all, or among the rows alike in ``within``."""

    column: str
    kind: str = "rank"  # or "dense" (no gaps after ties) or "number" (ties broken by the key)
    within: tuple[str, ...] = ()


def ordered_blocks(df: DataFrame, order: Sequence, blocks: int) -> DataFrame:
    """Rows with a ``_block`` number that never falls along ``order``, materialised.

    ``order`` has to end in a unique key, so that rows with equal values can be spread too.
    """
    return materialise(df.repartitionByRange(blocks, *order).withColumn("_block", F.spark_partition_id()))


def with_ranks(df: DataFrame, value: str, key: Sequence[str], ranks: Sequence[Rank],
               blocks: int | None = None) -> DataFrame:
    """Adds the ranks to ``df``, in as many blocks as there are shuffle partitions, two at least.

    NULL is the last value, like any other value where rows have it in common. ``key`` must be unique. Ranks
    among the same rows (``within``) share one summary of the blocks, one lookup and one sort.
    """
    blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = ordered_blocks(df, [F.col(value).desc(), *key], max(2, blocks))
    rows = cut
    for within in dict.fromkeys(rank.within for rank in ranks):
        rows = _across_blocks(rows, cut, value, key, [rank for rank in ranks if rank.within == within])
    return rows.select(*df.columns, *[rank.column for rank in ranks])


def _across_blocks(rows: DataFrame, blocks: DataFrame, value: str, key: Sequence[str], ranks: Sequence[Rank]) -> DataFrame:
    """Ranks from the places inside each block. Also right where one value fills several blocks."""
    within = list(ranks[0].within)
    group = ["_block", *within]

    # One row per block and group: how many rows and values it has, and the values at its two ends. In a struct
    # NULL is a value, and the smallest one.
    held = F.struct(F.col(value).alias("value"))
    ends = (
        blocks.groupBy(*group, held.alias("_value")).agg(F.count("*").alias("_n"))
        .groupBy(*group).agg(
            F.sum("_n").alias("_rows"),
            F.count("*").alias("_values"),
            F.max("_value").alias("_head"),
            F.min("_value").alias("_tail"),
            F.min_by("_n", "_value").alias("_tail_rows"),
        )
    )
    along = Window.partitionBy(*within).orderBy("_block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ends
        .withColumn("_rows_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        # The head of this block is the value that the block before it ended with.
        .withColumn("_joined", F.coalesce((F.lag("_tail").over(along) == F.col("_head")).cast("int"), F.lit(0)))
        .withColumn("_values_before",
                    F.coalesce(F.sum("_values").over(before), F.lit(0)) - F.sum("_joined").over(along))
        # Where the tail value first occurs, over all blocks that end with it.
        .withColumn("_tail_from", F.min(F.col("_rows_before") + F.col("_rows") - F.col("_tail_rows") + 1)
                    .over(Window.partitionBy(*within, "_tail")))
        .withColumn("_head_rank", F.when(F.col("_joined") == 1, F.lag("_tail_from").over(along))
                    .otherwise(F.col("_rows_before") + 1))
        .select(*group, "_head", "_rows_before", "_values_before", "_head_rank")
    )

    # The number needs the finest order; the other places find their rows in it.
    falling = F.col(value).desc()
    exact, alike = Window.partitionBy(*group).orderBy(falling, *key), Window.partitionBy(*group).orderBy(falling)
    kinds = {rank.kind for rank in ranks}
    if "number" in kinds:
        rows = rows.withColumn("_number_here", F.row_number().over(exact))
    for kind, place in (("rank", F.rank()), ("dense", F.dense_rank())):
        if kind in kinds:
            rows = rows.withColumn(f"_{kind}_here", place.over(alike))
    placed = join_lookup(rows, offsets, group, MOST_OFFSETS)
    places = {
        "rank": F.when(held == F.col("_head"), F.col("_head_rank"))
        .otherwise(F.col("_rows_before") + F.col("_rank_here")),
        "dense": F.col("_values_before") + F.col("_dense_here"),
        "number": F.col("_rows_before") + F.col("_number_here"),
    }
    added = [f"_{kind}_here" for kind in kinds] + ["_head", "_rows_before", "_values_before", "_head_rank"]
    return placed.withColumns({rank.column: places[rank.kind] for rank in ranks}).drop(*added)


def with_running_sums(df: DataFrame, group: str, order: Sequence[str], sums: dict[str, str],
                      blocks: int | None = None) -> DataFrame:
    """Adds running sums of columns ({new column: column}) and ``_seen``, the rows so far, within each group along ``order``.

    ``order`` must be unique within a group. A sum is NULL until a value is known, as in a window. NULL is a group.
    Rows are cut into blocks of even size by group and order. A group that a block begins with may have begun in
    earlier ones; only such groups get an offset, so there is one at most for each block. Each block then adds up its own
    rows: a group, or a day of it, may hold any share of all rows.
    """
    blocks = max(2, blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = ordered_blocks(df, [group, *order], blocks)
    held = F.struct(F.col(group).alias("value"))      # in a struct NULL is a value, and the smallest one
    ends = cut.groupBy("_block").agg(F.min(held).alias("_head"), F.max(held).alias("_tail"))
    # Of each block the group that it ends with: nothing else of it goes on in the next one. One row a block.
    tails = join_lookup(cut, ends.select("_block", "_tail"), ["_block"], MOST_OFFSETS).filter(held == F.col("_tail"))
    totals = tails.groupBy("_block").agg(
        *[F.sum(column).alias(f"_sum_{name}") for name, column in sums.items()], F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_tail").orderBy("_block")
    so_far = {f"_before_{name}": F.sum(f"_sum_{name}").over(earlier) for name in sums} | {"_rows_before": F.sum("_rows").over(earlier)}
    along = Window.orderBy("_block")
    # What the block before it has of the group that a block begins with.
    goes_on = F.lag("_tail").over(along) == F.col("_head")
    offsets = ends.join(totals, "_block").withColumns(so_far).select(
        "_block", "_head", *[F.when(goes_on, F.lag(name).over(along)).alias(name) for name in so_far])

    here = Window.partitionBy("_block", "_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = cut.withColumn("_group", held).withColumns(
        {f"_here_{name}": F.sum(column).over(here) for name, column in sums.items()} | {"_rows_here": F.count("*").over(here)})
    rows = join_lookup(rows, offsets, ["_block"], MOST_OFFSETS)

    def added(own: str, before: str):
        offset = F.when(F.col("_group") == F.col("_head"), F.col(before))
        return F.coalesce(F.col(own) + offset, F.col(own), offset)
    return rows.withColumns(
        {name: added(f"_here_{name}", f"_before_{name}") for name in sums} | {"_seen": added("_rows_here", "_rows_before")}
    ).select(*df.columns, *sums, "_seen")
