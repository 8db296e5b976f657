"""Keys that hold: rows that repeat a key or refer to nothing are set apart before a table is written."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txn_analytics.cluster import join_lookup, saved

KEPT, DUPLICATE, ORPHAN = "kept", "duplicate", "orphan"
VERDICT = "verdict"
FEW = 20_000    # keys in doubt that are broadcast to find their rows


def _every(columns: Sequence[str], test) -> Column:
    out = test(F.col(columns[0]))
    for name in columns[1:]:
        out = out & test(F.col(name))
    return out


def unknown_keys(rows: DataFrame, referenced: DataFrame, key: str) -> DataFrame:
    """Key values of the rows that the referenced table does not have; NULL is no key value.

    Both sides are reduced to one row per key before they meet, so a hot key is one row.
    """
    return rows.select(key).filter(F.col(key).isNotNull()).distinct().join(referenced.select(key), key, "left_anti")


def with_verdicts(rows: DataFrame, key: str, references: dict[str, DataFrame] | None = None,
                  taken: DataFrame | None = None) -> DataFrame:
    """The rows, written once, with ``verdict``: kept, duplicate or orphan.

    * An orphan has NULL or an unknown value in a column that refers to a table of ``references``.
    * Of the other rows with the same key the least one is kept, by all columns in their order (NULL first, as Spark
      sorts); rows that are equal in all columns keep one of them. The rest are duplicates, as are rows without a key
      and rows whose key is in ``taken``.

    Only keys that are in doubt are looked up: unknown references, and keys that occur twice or are taken. They are
    written once, so that no step computes them again and Spark knows their size. Few of them are broadcast and the rows
    do not move; many are joined, and adaptive execution splits a hot key there. Counting keys and finding least rows
    combine before their shuffle, so one key may hold any share of the rows. Least rows of many keys take one shuffle of
    whole rows; joins with many keys move the columns that the caller reads.
    """
    staged = saved(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    orphan = F.lit(False)
    for place, (column, referenced) in enumerate((references or {}).items()):
        flag = f"_unknown_{place}"
        unknown = saved(unknown_keys(staged, referenced.withColumnRenamed(referenced.columns[0], column), column), "unknown")
        staged = join_lookup(staged, unknown.withColumn(flag, F.lit(True)), [column])
        orphan = orphan | F.col(column).isNull() | F.coalesce(flag, F.lit(False))
    staged = staged.withColumn("_orphan", orphan)

    candidates = staged.filter(~F.col("_orphan") & F.col(key).isNotNull())
    twice = candidates.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key)
    doubted = twice.select(key, F.lit(False).alias("_taken"))
    if taken is not None:
        used = taken.select(key).join(candidates.select(key).distinct(), key, "left_semi").distinct()
        doubted = doubted.unionByName(used.select(key, F.lit(True).alias("_taken"))).groupBy(key).agg(
            F.max("_taken").alias("_taken"))
    doubted = saved(doubted, "doubted")
    least = F.min(F.struct(*[name for name in rows.columns if name != key], "_row"))["_row"].alias("_first")
    if doubted.limit(FEW + 1).count() <= FEW:
        candidates = candidates.join(F.broadcast(doubted.filter("NOT _taken").select(key)), key, "left_semi")
    doubted = saved(doubted.join(candidates.groupBy(key).agg(least), key, "left"), "first")

    free = F.col("_taken").isNull() | (~F.col("_taken") & (F.col("_row") == F.col("_first")))
    verdict = (
        F.when(F.col("_orphan"), ORPHAN)
        .when(F.col(key).isNotNull() & free, KEPT)
        .otherwise(DUPLICATE)
    )
    return join_lookup(staged, doubted, [key]).withColumn(VERDICT, verdict).select(*rows.columns, VERDICT)
