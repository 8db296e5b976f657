"""Checks that the tables keep their declared keys, and a profile of what they hold."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def check_foreign_key(df: DataFrame, referenced: DataFrame, key: str) -> DataFrame:
    """Key values without a row in the referenced table, with how many rows hold them.

    Both sides are reduced to one row per key first, so a hot key crosses the join once.
    """
    used = df.groupBy(key).agg(F.count("*").alias("rows"))
    return used.filter(F.col(key).isNotNull()).join(
        referenced.select(key).distinct(), key, "left_anti")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per required column, from one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], list(columns), "column", "nulls")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, largest table first."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("rows"), "table")


def profile_columns(df: DataFrame, table: str, exact: bool = False) -> DataFrame:
    """Type, NULLs, distinct values, smallest and largest value of every column, from one pass.

    Distinct values are estimates, or counted if ``exact``: then each column is read once more, alone, and its distinct
    values go through a shuffle. Counting all columns in the one pass would send every row once for each column through
    one sort, with the smallest and largest values at its side.
    """
    facts = []
    for position, field in enumerate(df.schema.fields, 1):
        column = F.col(field.name)
        estimate = [] if exact else [F.approx_count_distinct(column).alias("distinct_values")]
        facts.append(F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.count_if(column.isNull()).alias("nulls"),
            *estimate,
            F.min(column).cast("string").alias("smallest"),
            F.max(column).cast("string").alias("largest"),
        ))
    profile = (
        df.agg(F.array(*facts).alias("facts"))
        .select(F.lit(table).alias("table"), F.inline("facts"))
    )
    if exact:
        counts = [
            df.select(field.name).distinct().agg(F.count(field.name).alias("distinct_values"))
            .select(F.lit(position).alias("position"), "distinct_values")
            for position, field in enumerate(df.schema.fields, 1)]
        profile = profile.join(F.broadcast(reduce(DataFrame.unionByName, counts)), "position")
    return profile.select("table", "position", "column", "type", "nulls", "distinct_values", "smallest", "largest")
