"""Volume over calendar periods: trends, changes, running totals and performance against a mean.

All windows here run over one row per period (and group), after aggregation, so they stay small however
many transactions there are. A lag goes to the period before it that has rows; with ``dense`` every month between the
first and the last has a row, in each group, and a lag goes to the month before.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txn_analytics import model
from txn_analytics.cluster import materialise
from txn_analytics.functions.dates import month_label, quarter_label, weekday_name
from txn_analytics.functions.values import against_mean, direction, percent
from txn_analytics.operators.measures import BASIC, measures, not_failed

# What a row is grouped by, and the columns shown for that key.
PERIODS = {
    "month": (
        lambda day: F.trunc(day, "MM"),
        lambda key: [F.year(key).alias("year"), F.month(key).alias("month_num"), month_label(key).alias("month")],
    ),
    "quarter": (
        lambda day: F.trunc(day, "QUARTER"),
        lambda key: [F.year(key).alias("year"), F.quarter(key).alias("quarter"),
                     quarter_label(key).alias("quarter_label")],
    ),
    "weekday": (
        lambda day: F.dayofweek(day),
        lambda key: [F.col(key).alias("day_num"), weekday_name(F.col(key)).alias("day_name")],
    ),
    "month_of_year": (
        lambda day: F.trunc(day, "MM"),
        lambda key: [F.month(key).alias("month_num"), F.date_format(key, "MMMM").alias("month_name"),
                     F.year(key).alias("year")],
    ),
}


def _shown(period: str) -> list:
    return PERIODS[period][1]("_period")


def _by_period(txn: DataFrame, period: str, by: Sequence[str], stats: Sequence[str], dense: bool = False) -> DataFrame:
    rows = not_failed(txn).withColumn("_period", PERIODS[period][0]("date"))
    groups = measures(rows, ["_period", *by], stats, exclude_failed=False)
    return _every_month(groups, by, stats) if dense else groups


def _every_month(groups: DataFrame, by: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """The groups with a row for each month between the first and the last of all; counts and volumes of new ones are 0.

    The groups are computed once: the span, the spine and the join read them.
    """
    groups = materialise(groups)
    first, last = (groups.agg(edge("_period")).scalar() for edge in (F.min, F.max))
    names = groups.select(*by).distinct() if by else groups.agg(F.count("*").alias("_n")).filter("_n > 0")
    spine = names.select(*[F.col(name).alias(f"_{name}") for name in by],
                         F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("_month"))
    same = spine["_month"] == groups["_period"]
    for name in by:
        same = same & spine[f"_{name}"].eqNullSafe(groups[name])
    kinds = {field.name: field.dataType for field in groups.schema.fields}
    empty = {"transactions", "total_volume", "customers", "branches"}
    return spine.join(groups, same, "left").select(
        F.col("_month").alias("_period"), *[F.col(f"_{name}").alias(name) for name in by],
        *[F.coalesce(name, F.lit(0).cast(kinds[name])).alias(name) if name in empty else F.col(name) for name in stats])


def trend(txn: DataFrame, period: str, by: Sequence[str] = (), stats: Sequence[str] = BASIC, dense: bool = False) -> DataFrame:
    """Measures per period (and group) in time order. ``dense`` is for months."""
    order = [F.month("_period"), F.year("_period")] if period == "month_of_year" else ["_period"]
    return _by_period(txn, period, by, stats, dense).orderBy(*order, *by).select(*_shown(period), *by, *stats)


def _with_previous(groups: DataFrame, window) -> DataFrame:
    previous = F.col("previous_volume")
    return (
        groups.withColumn("previous_volume", F.lag("total_volume").over(window))
        .withColumn("change", F.col("total_volume") - previous)
        .withColumn("change_pct", percent("change", previous))
    )


def month_over_month(txn: DataFrame, dense: bool = False) -> DataFrame:
    """Volume per month against the month before it, with the direction of the change."""
    months = _with_previous(_by_period(txn, "month", (), ("transactions", "total_volume"), dense), Window.orderBy("_period"))
    return months.orderBy("_period").select(
        *_shown("month"), "transactions", "total_volume", "previous_volume", "change", "change_pct",
        direction("total_volume", "previous_volume").alias("trend"),
    )


def year_over_year(txn: DataFrame, dense: bool = False) -> DataFrame:
    """Volume per month against the same month in the last year that has it."""
    months = _by_period(txn, "month", (), ("transactions", "total_volume"), dense).withColumn("_of_year", F.month("_period"))
    compared = _with_previous(months, Window.partitionBy("_of_year").orderBy("_period"))
    return compared.orderBy("_of_year", "_period").select(
        *_shown("month_of_year"), "transactions", "total_volume", "previous_volume", "change", "change_pct",
        direction("total_volume", "previous_volume").alias("trend"),
    )


def branch_performance(txn: DataFrame, dense: bool = False) -> DataFrame:
    """Branch months against the month before, a three-month mean and the mean of all the branch's months."""
    along = Window.partitionBy("branch").orderBy("_period")
    months = (
        _with_previous(_by_period(txn, "month", ["branch"], ("total_volume",), dense), along)
        .withColumn("moving_avg_3", F.avg("total_volume").over(along.rowsBetween(-2, 0)))
        .withColumn("_mean", F.avg("total_volume").over(Window.partitionBy("branch")))
    )
    versus = against_mean("total_volume", "_mean", model.VERSUS_BRANCH)
    return months.orderBy("branch", "_period").select(
        "branch", *_shown("month"), "total_volume", "previous_volume", "change_pct", "moving_avg_3",
        F.when(F.col("previous_volume").isNull(), model.BASELINE).otherwise(versus).alias("performance"),
    )


def product_performance(txn: DataFrame, dense: bool = False) -> DataFrame:
    """Product months against the month before and the mean of all the product's months."""
    along = Window.partitionBy("product").orderBy("_period")
    months = (
        _with_previous(_by_period(txn, "month", ["product"], ("transactions", "total_volume"), dense), along)
        .withColumn("product_avg", F.avg("total_volume").over(Window.partitionBy("product")))
    )
    return months.orderBy("product", "_period").select(
        "product", *_shown("month"), "transactions", "total_volume", "previous_volume", "change_pct",
        "product_avg",
        against_mean("total_volume", "product_avg", model.VERSUS_PRODUCT).alias("performance"),
    )


def period_change(txn: DataFrame, dense: bool = False) -> DataFrame:
    """Month over month without the direction."""
    return month_over_month(txn, dense).drop("trend")


def cumulative(txn: DataFrame, by: Sequence[str] = (), dense: bool = False) -> DataFrame:
    """Monthly count and volume with running totals, never reset at the end of a year."""
    so_far = Window.partitionBy(*by).orderBy("_period").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _by_period(txn, "month", by, ("transactions", "total_volume"), dense)
        .withColumn("running_transactions", F.sum("transactions").over(so_far))
        .withColumn("running_volume", F.sum("total_volume").over(so_far))
        .orderBy(*by, "_period")
        .select(*_shown("month"), *by, "transactions", "total_volume", "running_transactions", "running_volume")
    )


def moving_average(txn: DataFrame, spans: Sequence[int] = (3, 6), dense: bool = False) -> DataFrame:
    """Monthly volume with means over the last n months present (``dense``: of the calendar); the first months use what there is."""
    along = Window.orderBy("_period")
    months = _by_period(txn, "month", (), ("total_volume",), dense)
    for span in spans:
        months = months.withColumn(f"moving_avg_{span}", F.avg("total_volume").over(along.rowsBetween(1 - span, 0)))
    return months.orderBy("_period").select(
        *_shown("month"), "total_volume", *[f"moving_avg_{span}" for span in spans])


def daily_milestones(txn: DataFrame, span: int = 7) -> DataFrame:
    """Transactions per day with a running count and a mean over the last seven days that have any."""
    along = Window.orderBy("date")
    return (
        measures(txn, ["date"], ("transactions",))
        .withColumn("running_transactions", F.sum("transactions").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(f"moving_avg_{span}", F.avg("transactions").over(along.rowsBetween(1 - span, 0)))
        .orderBy("date")
    )


def month_share(txn: DataFrame) -> DataFrame:
    """Each month's share of the volume and count of all months."""
    everything = Window.partitionBy()
    return (
        _by_period(txn, "month", (), ("transactions", "total_volume"))
        .withColumn("whole_volume", F.sum("total_volume").over(everything))
        .withColumn("volume_share_pct", percent("total_volume", "whole_volume"))
        .withColumn("transaction_share_pct", percent("transactions", F.sum("transactions").over(everything)))
        .orderBy("_period")
        .select(*_shown("month"), "transactions", "total_volume", "whole_volume",
                "volume_share_pct", "transaction_share_pct")
    )


def month_activity_level(txn: DataFrame) -> DataFrame:
    """Months more than a fifth above (Peak) or below (Low) the mean month."""
    volume, mean = F.col("total_volume"), F.col("monthly_avg")
    level = (
        F.when(volume > mean * F.lit(model.PEAK_FACTOR).cast("decimal(2,1)"), model.PEAK)
        .when(volume < mean * F.lit(model.LOW_FACTOR).cast("decimal(2,1)"), model.LOW)
        .otherwise(model.NORMAL_MONTH)
    )
    return (
        _by_period(txn, "month", (), ("transactions", "total_volume"))
        .withColumn("monthly_avg", F.avg("total_volume").over(Window.partitionBy()))
        .orderBy("_period")
        .select(*_shown("month"), "transactions", "total_volume", "monthly_avg", level.alias("activity_level"))
    )
