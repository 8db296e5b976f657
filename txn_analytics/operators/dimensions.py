"""Dimension tables derived from the data, and defaults filled on load."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txn_analytics.cluster import materialise
from txn_analytics.functions.dates import as_date
from txn_analytics.operators.blocks import Rank, with_ranks


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        "full_date",
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofmonth(day).alias("day_num"),
        F.weekofyear(day).alias("week_num"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def date_dimension(spark: SparkSession, first, last) -> DataFrame:
    """One row per day from ``first`` to ``last``."""
    days = F.explode(F.sequence(as_date(first), as_date(last))).alias("full_date")
    return _calendar(spark.range(1).select(days))


def date_dimension_of(txn: DataFrame) -> DataFrame:
    """One row per day between the first and the last transaction."""
    span = txn.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return _calendar(span.select(F.explode(F.sequence("first", "last")).alias("full_date")))


def name_dimension(names: DataFrame, column: str, id_column: str, name_column: str) -> DataFrame:
    """Numbers 1..n for the distinct values of a column, in name order.

    Other columns of ``names`` go along with their name.
    """
    return _numbered(names, column, id_column, name_column, F.lit(0))


def _numbered(names: DataFrame, column: str, id_column: str, name_column: str, after) -> DataFrame:
    """Numbers from ``after`` on. The names are derived once, and both the count and the places read the result."""
    distinct = materialise(names.filter(F.col(column).isNotNull()).distinct())
    rest = [name for name in names.columns if name != column]
    from_the_end = with_ranks(distinct, column, rest, [Rank("_number", "number")])
    how_many = distinct.agg(F.count("*")).scalar()
    return from_the_end.select(
        (after + how_many + 1 - F.col("_number")).cast("int").alias(id_column),
        F.col(column).alias(name_column), *rest,
    ).orderBy(id_column)


def extend_name_dimension(stored: DataFrame, names: DataFrame, column: str, id_column: str, name_column: str) -> DataFrame:
    """The stored dimension, unchanged, and behind it the names that it does not have yet.

    New names go on from the highest stored number, in name order: a number once given stays, also where a new name
    sorts before old ones. Without new names nothing changes; a name that is no longer used keeps its number.
    """
    new = names.join(stored.select(F.col(name_column).alias(column)), column, "left_anti")
    highest = stored.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    added = _numbered(new, column, id_column, name_column, highest)
    return stored.unionByName(added, allowMissingColumns=True).orderBy(id_column)


def apply_defaults(df: DataFrame, load_date=None) -> DataFrame:
    """Fills ``is_anomaly`` with false and ``load_date`` with now (or the given time) where they are missing."""
    now = F.current_timestamp() if load_date is None else F.lit(load_date).cast("timestamp")
    for name, value in (("is_anomaly", F.lit(False)), ("load_date", now)):
        df = df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return df
