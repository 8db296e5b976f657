"""Exact states that merge: moments of amounts for outlier limits, bitmaps of dense numbers for distinct counts.

A state has one row per group and month. States of two loads, or of two months, are merged by adding or by OR, and what is
derived from them does not depend on how rows were partitioned.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics.cluster import join_lookup
from txn_analytics.operators.measures import not_failed

#: Numbers that one bitmap covers.
BITMAP_NUMBERS = 32_768


def moments(txn: DataFrame, by: str = "segment") -> DataFrame:
    """Count, sum and sum of squares of the amounts of rows that did not fail, per group and month, as exact decimals."""
    square = (F.col("amount") * F.col("amount")).cast("decimal(38,4)")
    return not_failed(txn).groupBy(by, F.trunc("date", "MM").alias("month_start")).agg(
        F.count("amount").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("total"),
        F.sum(square).cast("decimal(38,4)").alias("squares"))


def merged_moments(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group of ``by`` for states of any loads and months."""
    return states.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,2)").alias("total"), F.sum("squares").cast("decimal(38,4)").alias("squares"))


def limits(states: DataFrame, by: str = "segment", deviations: float = 3) -> DataFrame:
    """Per group the mean plus so many sample deviations, as ``_limit``; NULL for a group of one row."""
    n, total, squares = (F.col(name).cast("double") for name in ("n", "total", "squares"))
    variance = F.greatest((squares - total * total / n) / F.when(n > 1, n - 1), F.lit(0.0))
    merged = merged_moments(states, [by]).filter("n > 0")
    return merged.select(by, F.when(n > 1, total / n + deviations * F.sqrt(variance)).alias("_limit"))


def bitmaps(rows: DataFrame, by: Sequence[str], spread: str, numbers: Mapping[str, str], sums: Mapping[str, object]) -> DataFrame:
    """A state of distinct counts, and of aggregates that merge, without a row for each value.

    ``spread`` is a column of dense numbers from 1 on, as many as there are: rows are grouped by ``by`` and by its bucket of
    ``BITMAP_NUMBERS`` numbers, so a group with most of the rows is many. Its bitmap is called ``spread``, too. ``numbers``
    ({name: column}) are dense numbers from 1 to ``BITMAP_NUMBERS`` with one bitmap each. NULL is no number. ``sums`` are
    further aggregates by name. The rows are combined before they are shuffled, once for everything.
    """
    def bitmap(column):
        return F.bitmap_construct_agg(F.bitmap_bit_position(F.col(column)))

    return rows.groupBy(*by, F.bitmap_bucket_number(F.col(spread)).alias("_bucket")).agg(
        bitmap(spread).alias(spread), *[bitmap(column).alias(name) for name, column in numbers.items()],
        *[value.alias(name) for name, value in sums.items()])


def distinct_counts(state: DataFrame, by: Sequence[str], spread: str, names: Sequence[str], merges: Mapping[str, object]) -> DataFrame:
    """Distinct counts per group of ``by`` from states of any months: ``spread`` and ``names`` become numbers of values."""
    first = state.groupBy(*by, "_bucket").agg(
        F.bitmap_count(F.bitmap_or_agg(spread)).alias(spread), *[F.bitmap_or_agg(name).alias(name) for name in names],
        *[merge(name).alias(name) for name, merge in merges.items()])
    return first.groupBy(*by).agg(
        F.sum(spread).alias(spread), *[F.bitmap_count(F.bitmap_or_agg(name)).alias(name) for name in names],
        *[merge(name).alias(name) for name, merge in merges.items()])


def with_numbers(rows: DataFrame, column: str, names: DataFrame, number: str) -> DataFrame:
    """Adds the dense number of a column's value from a dimension (number, name); NULL where it has none."""
    key, value = names.columns[1], names.columns[0]
    return join_lookup(rows, names.select(F.col(key).alias(column), F.col(value).cast("long").alias(number)), [column])
