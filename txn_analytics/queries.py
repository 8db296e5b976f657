"""Every operator run over the test tables, by name. The matching SQL is in ``oracle.py``."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txn_analytics import model
from txn_analytics.cluster import saved, scratch_path
from txn_analytics.operators.blocks import Rank, with_ranks
from txn_analytics.operators import (
    anomalies, dimensions, keys, measures as m, quality, ranking, running, segments, shares, states, trend,
)
from txn_analytics.plans import customer_report, load as load_plan, period_report as report, product_report, product_state
from txn_analytics.sources import files, retail_tables as tables

AS_OF, EVENTS_AS_OF = tables.AS_OF, tables.EVENTS_AS_OF

# Volume tiers that split the test customers evenly; the default ones put nearly all of them on top.
LARGE_TIERS = [(2000000, "VIP"), (1000000, "Premium"), (500000, "Regular")]
LARGE_VALUES = [(2000000, "Platinum"), (1000000, "Gold"), (500000, "Silver")]

# The period of the report over order lines.
PERIOD = ("1997-01-01", "1998-12-31")

Query = Callable[[SparkSession, str], DataFrame]


def presentable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, which every engine prints alike."""
    def shown(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)
    return df.select(*[shown(field) for field in df.schema.fields])


def _over(load, operator) -> Query:
    return lambda spark, folder: presentable(operator(load(spark, folder)))


def _valid(columns: str, operator) -> Query:
    """An operator over the non-failed order lines, reading the named columns."""
    names = ["amount", "status", *columns.split()]
    return _over(lambda s, d: tables.transactions(s, d, names, include_failed=False), operator)


def _all(columns: str, operator) -> Query:
    """An operator over all order lines."""
    return _over(lambda s, d: tables.transactions(s, d, columns.split()), operator)


def _customers(operator) -> Query:
    return _over(tables.customers, operator)


def _with_customers(columns: str, operator) -> Query:
    names = ["amount", "status", *columns.split()]
    return lambda s, d: presentable(
        operator(tables.customers(s, d), tables.transactions(s, d, names, include_failed=False)))


def _events(columns: str, operator) -> Query:
    """An operator over the flagged events."""
    names = ["segment", "amount", "status", *columns.split()]
    return _over(lambda s, d: anomalies.flag_anomalies(tables.event_transactions(s, d, names)), operator)


def _period(columns: str, operator) -> Query:
    """A result table of the report over one period of order lines."""
    names = ["date", "segment", "amount", "status", *columns.split()]
    return _over(
        lambda s, d: report.transform(files.extract(tables.transactions(s, d, names, include_failed=False), *PERIOD)),
        operator)


def _event_report(columns: str, operator) -> Query:
    names = ["date", "segment", "amount", "status", *columns.split()]
    return _over(lambda s, d: report.transform(tables.event_transactions(s, d, names)), operator)


def _some_months(txn: DataFrame, by: str | None = None) -> DataFrame:
    """Rows of every fifth month by a count that starts elsewhere for groups with names of other lengths."""
    shift = F.length(by) if by else F.lit(0)
    return txn.filter((F.year("date") * 12 + F.month("date") + shift) % 5 == 0)


def _loaded_table(spark: SparkSession, folder: str) -> DataFrame:
    """Load the fact: defaults, one folder per month, then read one year back."""
    path = scratch_path(spark, "transactions")
    files.write_table(dimensions.apply_defaults(tables.transactions(spark, folder), "2002-01-01 00:00:00"), path)
    rows = files.extract(files.read_table(spark, path), "1998-01-01", "1998-12-31")
    return presentable(
        rows.groupBy("load_month", "is_anomaly").agg(
            F.count("*").alias("transactions"), F.sum("amount").alias("total_volume"),
            F.max("load_date").cast("string").alias("load_date")))


def _whole_loaded_table(spark: SparkSession, folder: str) -> DataFrame:
    """Everything that a load of the fact wrote, by month and status."""
    path = scratch_path(spark, "transactions")
    files.write_table(dimensions.apply_defaults(tables.transactions(spark, folder), "2002-01-01 00:00:00"), path)
    return presentable(files.read_table(spark, path).groupBy("load_month", "status").agg(
        F.count("*").alias("transactions"), F.sum("amount").alias("total_volume"),
        F.countDistinct("transaction_id").alias("ids")))


def _load_of_events(spark: SparkSession, folder: str) -> DataFrame:
    """A load of events from CSV: every 97th amount is no number, every 101st row is there twice, every 50th customer is missing."""
    path = scratch_path(spark, "csv")
    event = F.col("transaction_id").cast("long")
    rows = tables.event_transactions(spark, folder)
    rows = rows.withColumn("amount", F.when(event % 97 == 0, "n/a").otherwise(F.col("amount").cast("string")))
    rows.unionByName(rows.filter(event % 101 == 0)).write.option("header", True).csv(f"{path}/transactions")
    tables.customers(spark, folder).filter(F.col("customer_id").cast("long") % 50 != 0).write.option("header", True).csv(
        f"{path}/customers")
    checks = load_plan.load(spark, f"{path}/transactions", f"{path}/customers", f"{path}/tables", "2024-02-01 00:00:00")
    counted = {
        "loaded": files.read_table(spark, f"{path}/tables/fact_transactions"),
        "rejected": files.read_table(spark, f"{path}/tables/rejected_transactions"),
        "duplicate_transactions": checks["duplicate_transactions"],
        "unknown_customers": checks["unknown_customers"],
        "duplicate_customers": checks["duplicate_customers"],
    }
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("measure"), "rows") for name, df in counted.items()])


def _keyed_load_of_events(spark: SparkSession, folder: str) -> DataFrame:
    """A load of events whose keys hold: every 101st row comes again with a larger amount, every 50th customer is missing."""
    path = scratch_path(spark, "csv")
    event = F.col("transaction_id").cast("long")
    rows = tables.event_transactions(spark, folder)
    again = rows.filter(event % 101 == 0).withColumn("amount", (F.col("amount") + 1).cast("decimal(15,2)"))
    rows = rows.unionByName(again).withColumn("amount", F.when(event % 97 == 0, "n/a").otherwise(F.col("amount").cast("string")))
    rows.write.option("header", True).csv(f"{path}/transactions")
    holders = tables.customers(spark, folder).filter(F.col("customer_id").cast("long") % 50 != 0)
    holders.unionByName(holders.filter(F.col("customer_id").cast("long") % 7 == 0)).write.option("header", True).csv(f"{path}/customers")
    load_plan.load_keyed(spark, f"{path}/transactions", f"{path}/customers", f"{path}/tables", "2024-02-01 00:00:00")
    names = [*load_plan.TABLES.values(), "rejected_transactions", "dim_customers", "duplicate_customers"]

    def counted(name):
        df = files.read_table(spark, f"{path}/tables/{name}")
        amount = F.sum("amount") if "amount" in df.columns and name != "rejected_transactions" else F.lit(None)
        return df.agg(F.count("*").alias("rows"), amount.cast("double").alias("total_volume")).select(
            F.lit(name).alias("measure"), "rows", "total_volume")
    return reduce(DataFrame.unionByName, map(counted, names))


def _keyed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines by order and line number, which repeat: what is kept and what is set apart, by month."""
    rows = tables.transactions(spark, folder).withColumn(
        "transaction_id", F.array_join(F.slice(F.split("transaction_id", "-"), 1, 2), "-"))
    holders = tables.customers(spark, folder).filter(F.col("customer_id").cast("long") % 50 != 0).select("customer_id")
    judged = keys.with_verdicts(rows, "transaction_id", {"customer_id": holders})
    return presentable(judged.groupBy(keys.VERDICT, (F.year("date") * 100 + F.month("date")).alias("load_month")).agg(
        F.count("*").alias("transactions"), F.countDistinct("transaction_id").alias("ids"), F.sum("amount").alias("total_volume")))


def _month_loaded_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The fact, then twice a new March 1998 in it: amounts one higher, and keys of April, which are not taken."""
    path = scratch_path(spark, "tables")
    fact = f"{path}/fact_transactions"
    files.write_table(tables.transactions(spark, folder), fact)
    march = F.col("date").between("1998-03-01", "1998-03-31")
    new = tables.transactions(spark, folder).filter(F.col("date").between("1998-03-01", "1998-04-30")).withColumns({
        "amount": (F.col("amount") + 1).cast("decimal(15,2)"),
        "date": F.when(march, F.col("date")).otherwise(F.lit("1998-03-31").cast("date"))})
    for _ in range(2):
        refused = load_plan.load_months(new, tables.customers(spark, folder), path)
    loaded = files.read_table(spark, fact).select("load_month", "amount", F.lit("fact").alias("table"))
    return presentable(loaded.unionByName(refused.select(F.lit(199803).alias("load_month"), "amount", F.col("verdict").alias("table"))).groupBy(
        "table", "load_month").agg(F.count("*").alias("transactions"), F.sum("amount").alias("total_volume")))


def _branches_of_two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Branches of Europe first, then those of all lines: the first keep their numbers."""
    used = tables.transactions(spark, folder, ["branch"]).distinct()
    names = used.join(tables.branches(spark, folder), "branch", "left")
    first = dimensions.name_dimension(names.filter("region = 'EUROPE'"), "branch", "branch_id", "branch_name")
    return presentable(dimensions.extend_name_dimension(first, names, "branch", "branch_id", "branch_name"))


def _csv_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as CSV and read back in the declared types."""
    path = scratch_path(spark, "customers")
    tables.customers(spark, folder).write.option("header", True).csv(path)
    rows, _ = files.read_csv(spark, path, model.CUSTOMERS)
    return presentable(rows)


def _saved_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report over one period of order lines, saved and read back: its branch table."""
    path = scratch_path(spark, "report")
    saved = report.run(tables.transactions(spark, folder), *PERIOD, AS_OF, path)
    return presentable(files.read_table(spark, saved["branch"]))


def _saved_flagged_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every flagged row of the report over the events, saved and read back."""
    path = scratch_path(spark, "report")
    saved = report.run(tables.event_transactions(spark, folder), "2024-01-01", "2024-12-31", EVENTS_AS_OF, path)
    return presentable(files.read_table(spark, saved["flagged"]))


def _report_at_once(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of the report over one period of order lines, and that the saved results have as many rows."""
    path = scratch_path(spark, "report")
    written = report.run_at_once(tables.transactions(spark, folder), *PERIOD, AS_OF, path)
    rows = [files.read_table(spark, written[name]).agg(F.count("*").alias("saved")).select(F.lit(name).alias("result"), "saved")
            for name in written if name != files.MANIFEST]
    return files.read_table(spark, written[files.MANIFEST]).join(reduce(DataFrame.unionByName, rows), "result")


def _running_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Running totals by customer, saved in order: the number of each row by its place in the files."""
    path = scratch_path(spark, "running")
    names = ["transaction_id", "date", "customer_id", "segment", "amount", "status"]
    rows = running.running_by_customer(tables.transactions(spark, folder, names, include_failed=False))
    files.write_ordered(rows, path, ["customer_id", "date", "transaction_id"])
    placed = with_ranks(files.read_ordered(spark, path), files.PLACE, [], [Rank("_from_the_end", "number")])
    total = placed.agg(F.count("*")).scalar()
    return presentable(placed.select(
        "customer_id", "date", "transaction_id", "running_total", (total + 1 - F.col("_from_the_end")).alias("row_number")))


def _all_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "fact_transactions": tables.transactions(spark, folder, ["transaction_id"]),
        "dim_customers": tables.customers(spark, folder),
        "dim_date": dimensions.date_dimension_of(tables.transactions(spark, folder, ["date"])),
        "dim_product": _products(spark, folder),
        "dim_branch": _branches(spark, folder),
    }


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.name_dimension(
        tables.transactions(spark, folder, ["product"]), "product", "product_id", "product_name")


def _branches(spark: SparkSession, folder: str) -> DataFrame:
    names = tables.transactions(spark, folder, ["branch"]).distinct()
    return dimensions.name_dimension(
        names.join(tables.branches(spark, folder), "branch", "left"), "branch", "branch_id", "branch_name")


def _dimension_profile(spark: SparkSession, folder: str) -> DataFrame:
    dims = _all_tables(spark, folder)
    del dims["fact_transactions"]
    return reduce(DataFrame.unionByName, [quality.profile_columns(df, name) for name, df in dims.items()])


def _flagged_lines(spark: SparkSession, folder: str, columns: list[str], include_failed: bool = True) -> DataFrame:
    """Order lines with the named columns and outlier flags; the limits read only what they need."""
    narrow = tables.transactions(spark, folder, ["segment", "amount", "status"], include_failed)
    return anomalies.flag_anomalies(tables.transactions(spark, folder, columns, include_failed), limits_from=narrow)


def _moments_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """The state of the outlier limits; the squares are digits without a point, which no engine rounds."""
    state = states.moments(tables.transactions(spark, folder, ["date", "segment", "amount", "status"], include_failed=False))
    return presentable(state.withColumn("squares", (F.col("squares") * 10000).cast("decimal(38,0)").cast("string")))


def _flags_from_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Flags of events by limits from two merged states, one of the failed and even events and one of the others."""
    events = tables.event_transactions(spark, folder)
    even = F.col("transaction_id").cast("long") % 2 == 0
    state = saved(states.moments(events.filter(even)).unionByName(states.moments(events.filter(~even))), "moments")
    return anomalies.flag_anomalies(events, moments=state).select("transaction_id", "segment", "is_anomaly")


def _product_report_from_state(spark: SparkSession, folder: str) -> DataFrame:
    """The product report from states of single months, limits of outliers from moments: nothing reads the lines a third time."""
    txn = saved(tables.transactions(spark, folder, [
        "transaction_id", "date", "customer_id", "segment", "branch", "product", "transaction_type", "amount", "status"]), "lines")
    flagged = anomalies.flag_anomalies(txn, moments=saved(states.moments(txn), "moments"))
    numbers = {column: dimensions.name_dimension(txn.select(column), column, "number", "name") for column in product_state.FEW.values()}
    holders = dimensions.name_dimension(tables.customers(spark, folder).select("customer_id"), "customer_id", "number", "name")
    state = saved(product_state.product_state(flagged, holders, numbers), "products")
    return presentable(product_state.report_from_state(state, AS_OF))


def _customer_report_events(spark: SparkSession, folder: str) -> DataFrame:
    events = anomalies.flag_anomalies(tables.event_transactions(spark, folder))
    return presentable(customer_report.customer_report(events, tables.customers(spark, folder), EVENTS_AS_OF))


def _customer_report(tiers) -> Query:
    def build(spark, folder):
        txn = _flagged_lines(spark, folder, [
            "transaction_id", "date", "customer_id", "segment", "branch", "product", "transaction_type", "amount", "status"], False)
        return presentable(
            customer_report.customer_report(txn, tables.customers(spark, folder), AS_OF, tiers))
    return build


QUERIES: dict[str, Query] = {
    # Distinct values
    "q02_1_customer_segments": _customers(lambda c: m.distinct_values(c, ["segment"])),
    "q02_2_customer_branches": _customers(lambda c: m.distinct_values(c, ["branch"])),
    "q02_3_segment_branch_pairs": _customers(lambda c: m.distinct_values(c, ["segment", "branch"])),
    "q02_4_transaction_types": _all("transaction_type", lambda t: m.distinct_values(t, ["transaction_type"])),
    "q02_5_products": _all("product", lambda t: m.distinct_values(t, ["product"])),
    "q02_6_type_category_pairs":
        _all("transaction_type category", lambda t: m.distinct_values(t, ["transaction_type", "category"])),
    "q02_7_statuses": _all("status", lambda t: m.distinct_values(t, ["status"])),
    "q02_8_fact_branches": _all("branch", lambda t: m.distinct_values(t, ["branch"])),
    "q02_9_dimension_combinations": _all(
        "segment branch product transaction_type",
        lambda t: m.distinct_values(t, ["segment", "branch", "product", "transaction_type"])),
    # Date ranges
    "q03_1_transaction_range": _all("date", lambda t: m.date_range(t, "date")),
    "q03_2_join_range": _customers(lambda c: m.date_range(c, "join_date").drop("months")),
    "q03_3_segment_range": _all(
        "date segment", lambda t: m.date_range(t, "date", ["segment"]).drop("months", "years").orderBy("segment")),
    "q03_4_branch_range": _all(
        "date branch", lambda t: m.date_range(t, "date", ["branch"]).drop("days", "years").orderBy("branch")),
    "q03_5_monthly_activity": _all("date", m.monthly_activity),
    "q03_6_tenure": _customers(lambda c: m.tenure(c, AS_OF)),
    # Measures
    "q04_1_kpis": _valid("customer_id branch", m.kpis),
    "q04_2_by_status": _all(
        "status amount",
        lambda t: m.largest_first(m.measures(t, ["status"], exclude_failed=False), "status", value="transactions")),
    "q04_3_by_type": _valid("transaction_type", lambda t: m.largest_first(
        m.measures(t, ["transaction_type"], (*m.BASIC, "min_amount", "max_amount")), "transaction_type")),
    "q04_4_by_product": _valid("product", lambda t: m.largest_first(m.measures(t, ["product"]), "product")),
    "q04_5_by_segment": _valid("segment customer_id", lambda t: m.largest_first(
        m.per_customer(m.measures(t, ["segment"], (*m.BASIC, "customers"))), "segment")),
    "q04_6_by_branch": _valid("branch customer_id", lambda t: m.largest_first(
        m.measures(t, ["branch"], (*m.BASIC, "customers")), "branch")),
    "q04_7_by_month": _valid("date", lambda t: trend.trend(t, "month").drop("month").withColumn(
        "month_name", F.date_format(F.make_date("year", "month_num", F.lit(1)), "MMMM"))),
    "q04_8_by_anomaly_flag": _events(
        "", lambda t: m.measures(t, ["is_anomaly"], exclude_failed=False).orderBy("is_anomaly")),
    # Magnitude
    "q05_1_branch_magnitude": _valid("branch", lambda t: m.largest_first(m.magnitude(t, "branch"), "branch")),
    "q05_2_segment_magnitude": _valid("segment customer_id", lambda t: m.largest_first(
        m.magnitude(t, "segment", (*m.BASIC, "customers")), "segment")),
    "q05_3_product_magnitude": _valid("product", lambda t: m.largest_first(
        m.magnitude(t, "product", (*m.BASIC, "min_amount", "max_amount")), "product")),
    "q05_4_type_magnitude": _valid("transaction_type", lambda t: m.largest_first(
        m.magnitude(t, "transaction_type"), "transaction_type")),
    "q05_5_segment_by_branch": _valid("segment branch", lambda t: m.measures(t, ["segment", "branch"])
                                      .orderBy("segment", F.desc("total_volume"), "branch")),
    "q05_6_segment_by_product": _valid("segment product", lambda t: m.measures(t, ["segment", "product"])
                                       .orderBy("segment", F.desc("total_volume"), "product")),
    "q05_7_amount_bands": _valid("", m.amount_bands),
    "q05_8_activity_bands": _valid("customer_id", m.activity_bands),
    # Ranking
    "q06_1_top_customers": _valid("customer_id segment branch", lambda t: ranking.top_k(t, segments.CUSTOMER)),
    "q06_2_customer_ranks": _valid("customer_id segment", ranking.global_rank),
    "q06_3_rank_within_segment": _valid("customer_id segment", ranking.rank_within_segment),
    "q06_4_branch_ranks": _valid("branch", lambda t: ranking.rank_groups(t, "branch")),
    "q06_5_product_ranks": _valid("product", lambda t: ranking.rank_groups(t, "product", dense=True)),
    "q06_6_top_customers_per_branch": _valid(
        "branch customer_id segment", lambda t: ranking.top_k_within(t, "branch")),
    "q06_7_bottom_customers": _valid("customer_id segment branch", lambda t: ranking.top_k(
        t, segments.CUSTOMER, stats=("transactions", "total_volume"), smallest=True)),
    "q06_8_types_within_branch": _valid("branch transaction_type", ranking.rank_types_within),
    # Change over time
    "q07_1_monthly_trend": _valid("date", lambda t: trend.trend(t, "month")),
    "q07_2_monthly_change": _valid("date", trend.period_change),
    "q07_3_quarterly_trend": _valid("date", lambda t: trend.trend(t, "quarter")),
    "q07_4_weekday_trend": _valid("date", lambda t: trend.trend(t, "weekday")),
    "q07_5_monthly_by_segment": _valid("date segment", lambda t: trend.trend(
        t, "month", ["segment"], ("transactions", "total_volume"))),
    "q07_6_monthly_by_branch": _valid("date branch", lambda t: trend.trend(
        t, "month", ["branch"], ("transactions", "total_volume"))),
    "q07_7_month_across_years": _valid("date", lambda t: trend.trend(
        t, "month_of_year", stats=("transactions", "total_volume"))),
    # Running totals
    "q08_1_running_volume": _valid("date", trend.cumulative),
    "q08_2_moving_averages": _valid("date", trend.moving_average),
    "q08_3_running_by_segment": _valid("date segment", lambda t: trend.cumulative(t, ["segment"])
                                       .drop("transactions", "running_transactions")),
    "q08_4_running_by_branch": _valid("date branch", lambda t: trend.cumulative(t, ["branch"]).drop("transactions")),
    "q08_5_running_by_customer": _valid("transaction_id date customer_id segment", running.running_by_customer),
    "q08_5_running_in_order": _running_in_order,
    "q08_6_daily_milestones": _valid("date", trend.daily_milestones),
    # Performance
    "q09_1_month_over_month": _valid("date", trend.month_over_month),
    # Months without rows filled in, over lines of some months only
    "q07_5_monthly_by_segment_dense": _valid("date segment", lambda t: trend.trend(
        _some_months(t, "segment"), "month", ["segment"], ("transactions", "total_volume"), dense=True)),
    "q08_2_moving_averages_dense": _valid("date", lambda t: trend.moving_average(_some_months(t), dense=True)),
    "q08_4_running_by_branch_dense": _valid("date branch", lambda t: trend.cumulative(
        _some_months(t, "branch"), ["branch"], dense=True)),
    "q09_1_month_over_month_dense": _valid("date", lambda t: trend.month_over_month(_some_months(t), dense=True)),
    "q09_2_year_over_year": _valid("date", trend.year_over_year),
    "q09_3_branch_performance": _valid("date branch", trend.branch_performance),
    "q09_4_product_performance": _valid("date product", trend.product_performance),
    "q09_5_customer_benchmark": _valid("customer_id segment branch", segments.benchmark),
    # Segmentation
    "q10_1_rfm": _valid("date customer_id segment branch", segments.rfm),
    "q10_1_rfm_large_values": _valid(
        "date customer_id segment branch", lambda t: segments.rfm(t, value_bands=LARGE_VALUES)),
    "q10_2_transaction_risk": _events(
        "transaction_id date customer_id branch transaction_type", segments.transaction_risk),
    "q10_2_transaction_risk_lines": _over(
        lambda s, d: _flagged_lines(s, d, [
            "transaction_id", "date", "customer_id", "segment", "branch", "transaction_type", "amount", "status"]),
        segments.transaction_risk),
    "q10_3_tenure_bands": _with_customers("customer_id", lambda c, t: segments.tenure_bands(c, t, AS_OF)),
    "q10_4_tenure_summary": _with_customers("customer_id", lambda c, t: segments.tenure_summary(c, t, AS_OF)),
    "q10_5_month_activity": _valid("date", trend.month_activity_level),
    # Parts of the whole
    "q11_1_branch_share": _valid("branch", lambda t: shares.volume_share(t, "branch")),
    "q11_2_segment_share": _valid("segment customer_id", shares.segment_share),
    "q11_3_product_share": _valid("product", lambda t: shares.volume_share(t, "product")),
    "q11_4_type_within_branch": _valid(
        "branch transaction_type", lambda t: shares.share_within(t, "branch", "transaction_type")),
    "q11_5_segment_within_branch": _valid("branch segment customer_id", lambda t: shares.share_within(
        t, "branch", "segment", ("customers", "total_volume"))),
    "q11_6_month_share": _valid("date", trend.month_share),
    "q11_7_product_mix": _valid("segment product", shares.product_mix),
    "q11_8_anomaly_share": _events("", shares.anomaly_share),
    # Consolidated reports
    "q12_customer_report": _customer_report(model.TIERS),
    "q12_customer_report_large_tiers": _customer_report(LARGE_TIERS),
    "q12_customer_report_events": _customer_report_events,
    "q13_product_report": _over(
        lambda s, d: _flagged_lines(s, d, [
            "transaction_id", "date", "customer_id", "segment", "branch", "product", "transaction_type", "amount", "status"]),
        lambda t: product_report.product_report(t, AS_OF)),
    "q13_product_report_from_state": _product_report_from_state,
    "q13_product_report_events": _over(
        lambda s, d: anomalies.flag_anomalies(tables.event_transactions(s, d)),
        lambda t: product_report.product_report(t, EVENTS_AS_OF)),
    # Periodic report
    "enrich_time_columns": _all(
        "transaction_id date",
        lambda t: anomalies.enrich_time(t)),
    "anomaly_moments": _moments_by_month,
    "flag_anomalies_from_moments": _flags_from_moments,
    "flag_anomalies": _events("transaction_id", lambda t: t.select("transaction_id", "segment", "is_anomaly")),
    "anomaly_rate": _events("", anomalies.anomaly_rate),
    "extract_period": _over(
        lambda s, d: tables.transactions(s, d, include_failed=False), lambda t: files.extract(t, *PERIOD)),
    "report_kpi_summary": _period("customer_id", lambda t: report.kpi_summary(t, AS_OF)),
    "report_kpi_summary_events": _event_report("customer_id", lambda t: report.kpi_summary(t, EVENTS_AS_OF)),
    "report_monthly": _period("", report.monthly),
    "report_by_branch": _period("branch customer_id", report.by_branch),
    "report_by_type": _period("transaction_type", report.by_type),
    "report_by_product": _period("product", report.by_product),
    "report_by_segment": _period("customer_id", report.by_segment),
    "report_top_customers": _period("customer_id", report.top_customers),
    "report_anomaly_list": _event_report("transaction_id customer_id branch transaction_type", report.anomaly_list),
    "report_flagged_rows": _event_report("transaction_id customer_id branch transaction_type", report.flagged),
    "report_month_ratios": _period("", lambda t: report.month_ratios(report.monthly(t))),
    "report_monthly_with_total": _period("", lambda t: report.with_total(report.monthly(t))),
    "report_branch_share": _period("branch customer_id", lambda t: report.branch_share(report.by_branch(t))),
    "report_top_customers_numbered": _period(
        "customer_id", lambda t: report.with_position(report.top_customers(t))),
    "report_saved_branch_table": _saved_report,
    "report_saved_flagged_rows": _saved_flagged_rows,
    "report_at_once": _report_at_once,
    # Sources, dimensions and checks
    "csv_customers": _csv_customers,
    "load_transactions": _loaded_table,
    "load_transactions_whole": _whole_loaded_table,
    "load_events_checks": _load_of_events,
    "load_events_keyed": _keyed_load_of_events,
    "load_lines_keyed": _keyed_lines,
    "load_month_twice": _month_loaded_twice,
    "dim_date": _all("date", dimensions.date_dimension_of),
    "dim_product": lambda s, d: presentable(_products(s, d)),
    "dim_branch": lambda s, d: presentable(_branches(s, d)),
    "dim_branch_second_load": _branches_of_two_loads,
    "load_defaults": _all(
        "transaction_id", lambda t: dimensions.apply_defaults(t, "2002-01-01 00:00:00")
        .withColumn("load_date", F.col("load_date").cast("string"))),
    "check_unique_transactions": _all(
        "transaction_id", lambda t: quality.check_unique(t, ["transaction_id"])),
    "check_unique_line_numbers": lambda s, d: quality.check_unique(
        s.read.parquet(f"{d}/lineitem.parquet"), ["l_orderkey", "l_linenumber"]),
    "check_foreign_key_customers": lambda s, d: quality.check_foreign_key(
        tables.transactions(s, d, ["customer_id"]), tables.customers(s, d), "customer_id"),
    "check_foreign_key_inactive": lambda s, d: quality.check_foreign_key(
        tables.customers(s, d), tables.transactions(s, d, ["customer_id", "status"], include_failed=False),
        "customer_id"),
    "check_not_null_transactions": _over(
        tables.transactions, lambda t: quality.check_not_null(t, list(tables.ALL))),
    "check_not_null_tenure": _with_customers("customer_id", lambda c, t: quality.check_not_null(
        segments.tenure_bands(c, t, AS_OF), ["customer_id", "transactions", "total_volume"])),
    "table_counts": lambda s, d: quality.table_counts(_all_tables(s, d)),
    # Distinct counts are estimates, so they are left to a test.
    "profile_dimensions": lambda s, d: presentable(_dimension_profile(s, d).drop("distinct_values")),
    "profile_customers_exact": lambda s, d: presentable(
        quality.profile_columns(tables.customers(s, d), "dim_customers", exact=True)),
    "profile_columns": _over(
        tables.transactions, lambda t: quality.profile_columns(t, "fact_transactions").drop("distinct_values")),
}
