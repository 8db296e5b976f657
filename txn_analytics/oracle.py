"""The SQL that each query must agree with, for DuckDB over the same Parquet tables.

Money is held in whole cents here, and every mean of money is rounded in integers, so that the expected
values carry no floating-point error of their own.
"""

from txn_analytics import model
from txn_analytics.queries import AS_OF, EVENTS_AS_OF, LARGE_TIERS, LARGE_VALUES, PERIOD

# ---------------------------------------------------------------- views of the tables

CUSTOMERS = """
cust as (
  select cast(c_custkey as varchar) customer_id, c_mktsegment segment, n_name branch,
         date '1994-01-01' + cast(c_custkey * 37 % 2000 as integer) join_date
  from customer left join nation on n_nationkey = c_nationkey)"""

LINES = """
lines as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) transaction_id,
         cast(l_shipdate as date) date, cast(o_custkey as varchar) customer_id, c_mktsegment segment,
         n_name branch, p_type product, l_returnflag transaction_type, l_linestatus category,
         cast(round(l_extendedprice * 100) as bigint) cents,
         case o_orderstatus when 'O' then 'Completed' when 'P' then 'Pending' when 'F' then 'Failed' end status
  from lineitem left join orders on o_orderkey = l_orderkey left join customer on c_custkey = o_custkey
       left join nation on n_nationkey = c_nationkey left join part on p_partkey = l_partkey)"""

EVENTS = """
lines as (
  select cast(event_id as varchar) transaction_id, cast(ts as date) date, cast(user_id as varchar) customer_id,
         c_mktsegment segment, n_name branch, event_type product, event_type transaction_type,
         event_type category, cast(round(value * 100) as bigint) cents,
         case event_type when 'error' then 'Failed' when 'signup' then 'Pending' else 'Completed' end status
  from events left join customer on c_custkey = user_id left join nation on n_nationkey = c_nationkey)"""

VALID = "valid as (select *, date_trunc('month', date) mon from lines where status <> 'Failed')"

FLAGGED = """
bounds as (
  select segment, avg(cents / 100) + 3 * stddev_samp(cents / 100) top
  from lines where status <> 'Failed' group by segment),
flagged as (
  select lines.*, coalesce(status <> 'Failed' and cents / 100 > top, false) is_anomaly
  from lines left join bounds using (segment))"""

MONTHS = "months as (select mon, count(*) n, sum(cents) c from valid group by mon)"


def _with(*views: str) -> str:
    return "with " + ",".join(views) + "\n"


def _valid(body: str, *more: str) -> str:
    return _with(LINES, VALID, *more) + body


def _period(body: str, *more: str) -> str:
    between = f"period as (select * from valid where date between date '{PERIOD[0]}' and date '{PERIOD[1]}')"
    return _with(LINES, VALID, between, *more) + body


# ---------------------------------------------------------------- expressions

def _rm(cents: str) -> str:
    """Cents as an amount."""
    return f"cast({cents} as double) / 100"


def _mean(cents: str, count: str, digits: int = 6) -> str:
    """cents / 100 / count, rounded half up in integers."""
    scaled = f"(2 * cast({cents} as hugeint) * {10 ** digits // 100})"
    return f"cast(({scaled} + ({count})) // nullif(2 * ({count}), 0) as double) / {10 ** digits}"


def _micros(cents: str, count: str) -> str:
    """The same, to six digits, as an integer of millionths."""
    return f"((2 * cast({cents} as hugeint) * 10000 + ({count})) // (2 * ({count})))"


def _pct(part: str, whole: str, digits: int | None = 2) -> str:
    ratio = f"cast({part} as double) / nullif(cast({whole} as double), 0) * 100"
    return ratio if digits is None else f"round({ratio}, {digits})"


def _case(value: str, test: str, steps, rest: str) -> str:
    arms = " ".join(f"when {value} {test} {limit} then '{label}'" for limit, label in steps)
    return f"case {arms} else '{rest}' end"


def _iso(day: str) -> str:
    return f"cast(cast({day} as date) as varchar)"


def _gap(first: str, last: str, unit: str = "month") -> str:
    return f"date_diff('{unit}', {first}, {last})"


VOLUME = f"{_rm('sum(cents)')} total_volume"
AVERAGE = f"{_mean('sum(cents)', 'count(*)')} avg_amount"
BASIC = f"count(*) transactions, {VOLUME}, {AVERAGE}"
EXTREMES = f"{_rm('min(cents)')} min_amount, {_rm('max(cents)')} max_amount"
HOLDERS = "count(distinct customer_id) customers"
SHARE = f"{_pct(_rm('sum(cents)'), _rm('sum(sum(cents)) over ()'), None)} volume_share_pct"
MONTH = "year(mon) as year, month(mon) month_num, strftime(mon, '%b %Y') as month"
MONTH_OF_YEAR = "month(mon) month_num, strftime(mon, '%B') month_name, year(mon) as year"


def _grouped(by: str, columns: str, source: str = "valid") -> str:
    return f"select {by}, {columns} from {source} group by {by}"


def _distinct(columns: str, source: str) -> str:
    views = CUSTOMERS if source == "cust" else LINES
    return _with(views) + f"select distinct {columns} from {source}"


def _changes(lag_over: str) -> str:
    """Columns that compare ``c`` with the row before it."""
    before = f"lag(c) over ({lag_over})"
    return f"""{_rm('c')} total_volume, {_rm(before)} previous_volume, {_rm(f'c - {before}')} change,
      {_pct(f'(c - {before})', before)} change_pct"""


def _trend(lag_over: str) -> str:
    before = f"lag(c) over ({lag_over})"
    return (f"case when {before} is null then '{model.BASELINE}' when c > {before} then '{model.GROWTH}' "
            f"when c < {before} then '{model.DECLINE}' else '{model.FLAT}' end trend")


def _group_months(by: str) -> str:
    return f"parts as (select {by}, mon, count(*) n, sum(cents) c from valid group by {by}, mon)"


def _part_columns(by: str) -> tuple[str, str]:
    """Change against the month before, and the mean of all months in millionths."""
    before = f"lag(c) over (partition by {by} order by mon)"
    change = f"""{_rm('c')} total_volume, {_rm(before)} previous_volume, {_pct(f'(c - {before})', before)} change_pct"""
    return change, _micros(f"sum(c) over (partition by {by})", f"count(*) over (partition by {by})")


def _running(by: str | None, columns: dict[str, str]) -> str:
    over = f"over ({f'partition by {by} ' if by else ''}order by mon rows unbounded preceding)"
    shown = ", ".join(f"{value.format(over=over)} {name}" for name, value in columns.items())
    group = f"{by}, " if by else ""
    source = "parts" if by else "months"
    return f"select {MONTH}, {group}{shown} from {source}"


RUNNING_VOLUME = "cast(sum(c) {over} as double) / 100"


def _shares(by: str) -> str:
    return f"""select {by}, count(*) transactions, {VOLUME}, {_rm('sum(sum(cents)) over ()')} whole_volume,
      {_pct('sum(cents)', 'sum(sum(cents)) over ()')} volume_share_pct,
      {_pct('count(*)', 'sum(count(*)) over ()')} transaction_share_pct from valid group by {by}"""


def _inside(within: str, part: str, more: str = "") -> str:
    return f"""select {within}, {part}, {more}{VOLUME},
      {_rm(f'sum(sum(cents)) over (partition by {within})')} {within}_volume,
      {_pct('sum(cents)', f'sum(sum(cents)) over (partition by {within})')} share_pct
      from valid group by {within}, {part}"""


CUSTOMER_VOLUMES = """
cv as (select customer_id, segment, branch, count(*) n, sum(cents) c, max(date) last_date
       from valid group by customer_id, segment, branch)"""


def _peer_band(value: str, mean: str, steps, rest: str) -> str:
    """Bands by multiples of a mean in millionths, for a value in cents; multiples are given in halves."""
    arms = " ".join(f"when {value} * 20000 > {mean} * {int(float(f) * 2)} then '{label}'" for f, label in steps)
    return f"case {arms} else '{rest}' end"


def _rfm(values) -> str:
    return _valid(f"""
select customer_id, segment, branch, {_iso('last_date')} last_date, n frequency, {_rm('c')} monetary, recency_days,
       recency_band, frequency_band, value_band,
       case when recency_band = 'Active' and value_band in ('Platinum', 'Gold') then '{model.CHAMPION}'
            when recency_band = 'Active' and frequency_band = 'High Frequency' then '{model.LOYAL}'
            when recency_band = 'Lapsing' and value_band in ('Platinum', 'Gold') then '{model.AT_RISK}'
            when recency_band = 'Dormant' then '{model.LOST}' else '{model.REGULAR}' end customer_group
from (select *, {_case('recency_days', '<=', model.RECENCY_BANDS, model.RECENCY_REST)} recency_band,
             {_case('n', '>=', model.FREQUENCY_BANDS, model.FREQUENCY_REST)} frequency_band,
             {_case('c', '>=', [(v * 100, name) for v, name in values], model.VALUE_REST)} value_band
      from (select *, {_gap('last_date', 'max(last_date) over ()', 'day')} recency_days from cv))""",
                  CUSTOMER_VOLUMES)


def _risk(views: str) -> str:
    in_cents = [(limit * 100, label) for limit, label in model.RISK_BANDS]
    return _with(views, FLAGGED) + f"""
select transaction_id, {_iso('date')} date, customer_id, segment, branch, transaction_type, {_rm('cents')} amount,
       is_anomaly,
       case when is_anomaly then '{model.RISK_OUTLIER}' else {_case('cents', '>=', in_cents, model.RISK_REST)} end
         risk_category,
       case when status = 'Failed' then '{model.REVIEW_FAILED}'
            when is_anomaly and cents >= {model.ESCALATE_FROM * 100} then '{model.ESCALATE}'
            when is_anomaly then '{model.FLAG}' else '{model.NO_ACTION}' end as action
from flagged"""


TENURE = f"""
held as (
  select cust.customer_id, cust.segment, cust.branch, join_date, {_gap('join_date', f"date '{AS_OF}'", 'year')} y,
         count(transaction_id) n, sum(cents) c
  from cust left join valid on valid.customer_id = cust.customer_id
  group by cust.customer_id, cust.segment, cust.branch, join_date)"""


def _customer_report(lines: str, as_of: str, tiers) -> str:
    tiers = [(limit * 100, label) for limit, label in tiers]
    today = f"date '{as_of}'"
    bank_mean = _micros("sum(c) over ()", "count(*) over ()")
    segment_mean = _micros("sum(c) over (partition by segment)", "count(*) over (partition by segment)")
    spend = f"(2 * c + greatest(life, 1)) // (2 * greatest(life, 1))"

    def cents(micros):
        """Millionths rounded half away from zero to cents."""
        return f"cast(sign({micros}) * ((abs({micros}) + 5000) // 10000) as double) / 100"

    return _with(lines, CUSTOMERS, FLAGGED) + f""",
base as (
  select f.customer_id, f.segment, f.branch, join_date, count(*) n, sum(cents) c, min(cents) low, max(cents) high,
         count(distinct product) products, count(distinct transaction_type) types,
         min(date) first_date, max(date) last_date, count(*) filter (is_anomaly) hits
  from flagged f join cust on cust.customer_id = f.customer_id
  where status <> 'Failed' group by f.customer_id, f.segment, f.branch, join_date),
timed as (
  select *, {_gap('join_date', today)} tenure, {_gap('first_date', 'last_date')} life,
         {_gap('last_date', today)} recency from base),
placed as (
  select *, {spend} spend, {bank_mean} bank_mean, {segment_mean} segment_mean,
         rank() over (order by c desc) overall_rank,
         rank() over (partition by segment order by c desc) segment_rank from timed)
select customer_id, segment, branch, {_iso('join_date')} join_date,
       {_case('c', '>=', tiers, model.TIER_REST)} customer_tier,
       {_case('tenure', '>=', model.REPORT_TENURE, model.REPORT_TENURE_REST)} tenure_band,
       case when recency = 0 then 'Active This Month' when recency <= 3 then 'Active (< 3 Months)'
            when recency <= 6 then 'Lapsing (3–6 Months)' else 'Dormant (6+ Months)' end activity_status,
       n transactions, products products_used, types types_used,
       {_iso('first_date')} first_date, {_iso('last_date')} last_date,
       {_rm('c')} total_volume, {_rm('low')} min_amount, {_rm('high')} max_amount,
       tenure tenure_months, life lifespan_months, recency recency_months,
       {_mean('c', 'n', 2)} avg_transaction, {_rm('spend')} avg_monthly_spend, hits anomalies,
       {_case('hits', '>=', model.CUSTOMER_RISK, model.RISK_CLEAN)} risk_flag,
       {cents('bank_mean')} bank_avg_volume,
       {cents(_micros('sum(spend) over ()', 'count(*) over ()'))} bank_avg_monthly_spend,
       {cents('(c * 10000 - bank_mean)')} diff_from_bank_avg,
       {cents('segment_mean')} segment_avg_volume,
       {_peer_band('c', 'segment_mean', model.SEGMENT_BANDS, model.SEGMENT_REST)} segment_performance,
       overall_rank, segment_rank
from placed"""


def _product_report(lines: str, as_of: str) -> str:
    tier = " ".join(f"when c * 100 >= whole * {int(float(f) * 100)} then '{name}'" for f, name in model.PRODUCT_TIERS)
    return _with(lines, FLAGGED) + f""",
base as (
  select product, count(*) n, count(*) filter (status = 'Completed') completed,
         count(*) filter (status = 'Pending') pending, count(*) filter (status = 'Failed') failed,
         count(distinct customer_id) customers, count(distinct branch) branches, count(distinct segment) segments,
         min(date) first_date, max(date) last_date, sum(cents) c, min(cents) low, max(cents) high,
         count(*) filter (is_anomaly) hits
  from flagged group by product),
rated as (
  select *, {_gap('first_date', 'last_date')} life, {_gap('last_date', f"date '{as_of}'")} recency,
         {_pct('completed', 'n')} completion, (2 * c + n) // (2 * n) per_order, sum(c) over () whole from base),
paced as (select *, (2 * c + greatest(life, 1)) // (2 * greatest(life, 1)) pace from rated)
select product, case {tier} else '{model.PRODUCT_TIER_REST}' end performance_tier,
       {_case('customers', '>=', model.ADOPTION, model.ADOPTION_REST)} adoption_band,
       case when recency = 0 and completion >= {model.HEALTHY_FROM} then '{model.HEALTHY}'
            when recency <= 1 and completion >= {model.ACTIVE_FROM} then '{model.ACTIVE}'
            when completion < {model.FAILING_BELOW} then '{model.FAILING}' else '{model.MONITOR}' end health,
       n transactions, completed, pending, failed, completion completion_pct, customers, branches, segments,
       {_iso('first_date')} first_date, {_iso('last_date')} last_date, life lifespan_months, recency recency_months,
       {_rm('c')} total_revenue, {_rm('low')} min_amount, {_rm('high')} max_amount,
       {_rm('per_order')} avg_order_revenue, {_rm('pace')} avg_monthly_revenue,
       {_mean('c', 'customers', 2)} revenue_per_customer, hits anomalies,
       {_case('hits', '>=', model.PRODUCT_RISK, model.RISK_CLEAN)} risk_flag,
       {_rm('whole')} bank_revenue, {_pct('c', 'whole')} revenue_share_pct,
       {_mean('whole', 'count(*) over ()', 2)} bank_avg_revenue,
       {_mean('sum(pace) over ()', 'count(*) over ()', 2)} bank_avg_monthly_revenue,
       rank() over (order by c desc) revenue_rank, rank() over (order by customers desc) adoption_rank,
       rank() over (order by per_order desc) order_revenue_rank
from paced"""


def _report_kpis(source: str, as_of_text: str) -> str:
    return f"""
select count(*) transactions, {VOLUME}, {_mean('sum(cents)', 'count(*)', 2)} avg_transaction, {HOLDERS},
       count(*) filter (is_anomaly) anomalies, '{as_of_text}' report_date from {source}"""


# Outliers of the period: bounds come from the rows inside it.
PERIOD_LINES = LINES.replace("lines as", "every_line as") + f""",
lines as (select * from every_line where status <> 'Failed'
          and date between date '{PERIOD[0]}' and date '{PERIOD[1]}')"""

REPORT_MONTHS = "months as (select date_trunc('month', date) mon, count(*) n, sum(cents) c from period group by 1)"
REPORT_MONTH = f"{_iso('mon')} month_start, strftime(mon, '%b %Y') as month"
BRANCH_TABLE = f"""branch, count(*) transactions, {VOLUME}, {HOLDERS},
  {_mean('sum(cents)', 'count(*)', 2)} avg_transaction"""
BRANCH_SHARE = f"{_pct('sum(cents)', 'sum(sum(cents)) over ()', 1)} volume_share_pct"
TOP = """select customer_id, count(*) transactions, sum(cents) c from period
  group by customer_id order by c desc, customer_id limit 10"""
FLAGGED_ROW = f"""transaction_id, strftime(date, '%d/%m/%Y') date, customer_id, segment, branch, transaction_type,
  {_rm('cents')} amount"""


_branch_change, _branch_mean = _part_columns("branch")
_product_change, _product_mean = _part_columns("product")
_last3 = "(partition by branch order by mon rows 2 preceding)"


def _moving(span: int) -> str:
    over = f"over (order by mon rows {span - 1} preceding)"
    return f"{_mean(f'sum(c) {over}', f'count(*) {over}')} moving_avg_{span}"


def _profile(table: str, column_types: dict[str, str], source: str, exact: bool = False) -> str:
    arms = []
    for position, (name, kind) in enumerate(column_types.items(), 1):
        def text(value):
            return value if kind == "string" else f"cast({value} as varchar)"
        lowest, highest = f'min("{name}")', f'max("{name}")'
        arms.append(f"""select '{table}' as "table", {position} as position, '{name}' as "column", '{kind}' as type,
          count(*) - count("{name}") nulls, {f'count(distinct "{name}") distinct_values, ' if exact else ''}{text(lowest)} smallest, {text(highest)} largest from {source}""")
    return "\nunion all ".join(arms)


DATE_DIMENSION = f"""
select cast(strftime(d, '%Y%m%d') as int) date_id, {_iso('d')} full_date, dayname(d) day_of_week, day(d) day_num,
       week(d) week_num, month(d) month_num, monthname(d) month_name, quarter(d) as quarter, year(d) as year,
       isodow(d) >= 6 is_weekend
from (select unnest(generate_series(min(date), max(date), interval 1 day)) d from lines)"""
PRODUCT_DIMENSION = """
select row_number() over (order by product) product_id, product product_name
from (select distinct product from lines where product is not null)"""
BRANCH_DIMENSION = """
select row_number() over (order by branch) branch_id, branch branch_name, r_name region
from (select distinct branch from lines where branch is not null)
     left join nation on n_name = branch left join region on r_regionkey = n_regionkey"""

CUSTOMER_TYPES = {field.name: field.dataType.simpleString() for field in model.CUSTOMERS.fields}
FACT_TYPES = {field.name: field.dataType.simpleString() for field in model.TRANSACTIONS.fields}

ORACLE: dict[str, str] = {
    "q02_1_customer_segments": _distinct("segment", "cust"),
    "q02_2_customer_branches": _distinct("branch", "cust"),
    "q02_3_segment_branch_pairs": _distinct("segment, branch", "cust"),
    "q02_4_transaction_types": _distinct("transaction_type", "lines"),
    "q02_5_products": _distinct("product", "lines"),
    "q02_6_type_category_pairs": _distinct("transaction_type, category", "lines"),
    "q02_7_statuses": _distinct("status", "lines"),
    "q02_8_fact_branches": _distinct("branch", "lines"),
    "q02_9_dimension_combinations": _distinct("segment, branch, product, transaction_type", "lines"),

    "q03_1_transaction_range": _with(LINES) + f"""
select {_iso('min(date)')} first_date, {_iso('max(date)')} last_date, {_gap('min(date)', 'max(date)', 'day')} as days,
       {_gap('min(date)', 'max(date)')} as months, {_gap('min(date)', 'max(date)', 'year')} as years from lines""",
    "q03_2_join_range": _with(CUSTOMERS) + f"""
select {_iso('min(join_date)')} first_date, {_iso('max(join_date)')} last_date,
       {_gap('min(join_date)', 'max(join_date)', 'day')} as days,
       {_gap('min(join_date)', 'max(join_date)', 'year')} as years from cust""",
    "q03_3_segment_range": _with(LINES) + _grouped("segment", f"""{_iso('min(date)')} first_date,
       {_iso('max(date)')} last_date, {_gap('min(date)', 'max(date)', 'day')} as days""", "lines"),
    "q03_4_branch_range": _with(LINES) + _grouped("branch", f"""{_iso('min(date)')} first_date,
       {_iso('max(date)')} last_date, {_gap('min(date)', 'max(date)')} as months""", "lines"),
    "q03_5_monthly_activity": _with(LINES) + f"""
select year(mon) as year, month(mon) month_num, strftime(mon, '%B') month_name, n transactions,
       {_iso('lo')} first_date, {_iso('hi')} last_date, {_gap('lo', 'hi', 'day')} days_with_activity
from (select date_trunc('month', date) mon, count(*) n, min(date) lo, max(date) hi from lines group by 1)""",
    "q03_6_tenure": _with(CUSTOMERS) + f"""
select customer_id, segment, {_iso('join_date')} join_date,
       {_gap('join_date', f"date '{AS_OF}'", 'year')} tenure_years,
       {_gap('join_date', f"date '{AS_OF}'")} tenure_months from cust""",

    "q04_1_kpis": _valid(f"""
select count(*) transactions, {HOLDERS}, count(distinct branch) branches, {VOLUME}, {AVERAGE}, {EXTREMES} from valid"""),
    "q04_2_by_status": _with(LINES) + _grouped("status", BASIC, "lines"),
    "q04_3_by_type": _valid(_grouped("transaction_type", f"{BASIC}, {EXTREMES}")),
    "q04_4_by_product": _valid(_grouped("product", BASIC)),
    "q04_5_by_segment": _valid(_grouped("segment", f"""{BASIC}, {HOLDERS},
       {_mean('sum(cents)', 'count(distinct customer_id)')} volume_per_customer""")),
    "q04_6_by_branch": _valid(_grouped("branch", f"{BASIC}, {HOLDERS}")),
    "q04_7_by_month": _valid(f"select year(mon) as year, month(mon) month_num, monthname(mon) month_name, {BASIC} from valid group by mon"),
    "q04_8_by_anomaly_flag": _with(EVENTS, FLAGGED) + _grouped("is_anomaly", BASIC, "flagged"),

    "q05_1_branch_magnitude": _valid(_grouped("branch", f"{BASIC}, {SHARE}")),
    "q05_2_segment_magnitude": _valid(_grouped("segment", f"{BASIC}, {HOLDERS}, {SHARE}")),
    "q05_3_product_magnitude": _valid(_grouped("product", f"{BASIC}, {EXTREMES}, {SHARE}")),
    "q05_4_type_magnitude": _valid(_grouped("transaction_type", f"{BASIC}, {SHARE}")),
    "q05_5_segment_by_branch": _valid(_grouped("segment, branch", BASIC)),
    "q05_6_segment_by_product": _valid(_grouped("segment, product", BASIC)),
    "q05_7_amount_bands": _valid(f"""
select {_case('cents', '<', [(v * 100, name) for v, name in model.AMOUNT_BANDS], model.AMOUNT_BAND_REST)} amount_band,
       {BASIC}, {_pct('count(*)', 'sum(count(*)) over ()', None)} count_share_pct from valid group by 1"""),
    "q05_8_activity_bands": _valid(f"""
select {_case('n', '<=', [(limit, at) for at, (limit, _) in enumerate(model.ACTIVITY_BANDS)],
              str(len(model.ACTIVITY_BANDS))).replace("'", "")} band_order,
       {_case('n', '<=', model.ACTIVITY_BANDS, model.ACTIVITY_BAND_REST)} activity_band,
       count(*) customers, avg(n) avg_transactions, {_rm('sum(c)')} group_volume,
       {_mean('sum(c)', 'count(*)')} avg_volume_per_customer
from (select customer_id, count(*) n, sum(cents) c from valid group by customer_id) group by 1, 2"""),

    "q06_1_top_customers": _valid(
        _grouped("customer_id, segment, branch", BASIC) + " order by sum(cents) desc, customer_id limit 10"),
    "q06_2_customer_ranks": _valid(f"""
select customer_id, segment, {_rm('c')} total_volume, rank() over (order by c desc) volume_rank,
       dense_rank() over (order by c desc) volume_dense_rank,
       row_number() over (order by c desc, customer_id, segment) volume_row_number from cv""", CUSTOMER_VOLUMES),
    "q06_3_rank_within_segment": _valid(f"""
select customer_id, segment, {_rm('c')} total_volume, n transactions,
       rank() over (partition by segment order by c desc) rank_in_segment from cv""", CUSTOMER_VOLUMES),
    "q06_4_branch_ranks": _valid(_grouped("branch", f"""{BASIC}, rank() over (order by sum(cents) desc) volume_rank,
       rank() over (order by count(*) desc) count_rank""")),
    "q06_5_product_ranks": _valid(_grouped("product", f"""{BASIC},
       dense_rank() over (order by sum(cents) desc) volume_rank,
       dense_rank() over (order by count(*) desc) count_rank""")),
    "q06_6_top_customers_per_branch": _valid(f"""
select branch, customer_id, segment, {_rm('c')} total_volume,
       row_number() over (partition by branch order by c desc, customer_id) as position from cv
qualify position <= 5""", CUSTOMER_VOLUMES),
    "q06_7_bottom_customers": _valid(_grouped("customer_id, segment, branch", f"count(*) transactions, {VOLUME}")
                                     + " order by sum(cents), customer_id limit 10"),
    "q06_8_types_within_branch": _valid(_grouped("branch, transaction_type", f"""count(*) transactions, {VOLUME},
       rank() over (partition by branch order by sum(cents) desc) rank_in_branch""")),

    "q07_1_monthly_trend": _valid(f"select {MONTH}, {BASIC} from valid group by mon"),
    "q07_2_monthly_change": _valid(f"select {MONTH}, n transactions, {_changes('order by mon')} from months", MONTHS),
    "q07_3_quarterly_trend": _valid(f"""
select year(q) as year, quarter(q) as quarter, 'Q' || quarter(q) || ' ' || year(q) quarter_label, {BASIC}
from (select *, date_trunc('quarter', date) q from valid) group by q"""),
    "q07_4_weekday_trend": _valid(f"""
select dayofweek(date) + 1 day_num, dayname(date) day_name, {BASIC} from valid group by 1, 2"""),
    "q07_5_monthly_by_segment": _valid(f"""
select {MONTH}, segment, count(*) transactions, {VOLUME} from valid group by mon, segment"""),
    "q07_6_monthly_by_branch": _valid(f"""
select {MONTH}, branch, count(*) transactions, {VOLUME} from valid group by mon, branch"""),
    "q07_7_month_across_years": _valid(f"""
select {MONTH_OF_YEAR}, count(*) transactions, {VOLUME} from valid group by mon"""),

    "q08_1_running_volume": _valid(_running(None, {
        "transactions": "n", "total_volume": _rm("c"), "running_transactions": "cast(sum(n) {over} as bigint)",
        "running_volume": RUNNING_VOLUME}), MONTHS),
    "q08_2_moving_averages": _valid(
        f"select {MONTH}, {_rm('c')} total_volume, {_moving(3)}, {_moving(6)} from months", MONTHS),
    "q08_3_running_by_segment": _valid(_running("segment", {
        "total_volume": _rm("c"), "running_volume": RUNNING_VOLUME}), _group_months("segment")),
    "q08_4_running_by_branch": _valid(_running("branch", {
        "total_volume": _rm("c"), "running_transactions": "cast(sum(n) {over} as bigint)",
        "running_volume": RUNNING_VOLUME}), _group_months("branch")),
    "q08_5_running_by_customer": _valid(f"""
select customer_id, segment, {_iso('date')} date, transaction_id, {_rm('cents')} amount,
       {_rm('sum(cents) over w')} running_total, {_mean('sum(cents) over w', 'count(*) over w')} running_avg
from valid window w as (partition by customer_id order by date, transaction_id rows unbounded preceding)"""),
    "q08_6_daily_milestones": _valid(f"""
select {_iso('date')} date, n transactions,
       cast(sum(n) over (order by date rows unbounded preceding) as bigint) running_transactions,
       avg(n) over (order by date rows 6 preceding) moving_avg_7
from (select date, count(*) n from valid group by date)"""),

    "q09_1_month_over_month": _valid(f"""
select {MONTH}, n transactions, {_changes('order by mon')}, {_trend('order by mon')} from months""", MONTHS),
    "q09_2_year_over_year": _valid(f"""
select {MONTH_OF_YEAR}, n transactions, {_changes('partition by month(mon) order by mon')},
       {_trend('partition by month(mon) order by mon')} from months""", MONTHS),
    "q09_3_branch_performance": _valid(f"""
select branch, {MONTH}, {_branch_change}, {_mean(f'sum(c) over {_last3}', f'count(*) over {_last3}')} moving_avg_3,
       case when lag(c) over (partition by branch order by mon) is null then '{model.BASELINE}'
            when c * 10000 > {_branch_mean} then '{model.VERSUS_BRANCH[0]}'
            when c * 10000 < {_branch_mean} then '{model.VERSUS_BRANCH[1]}' else '{model.VERSUS_BRANCH[2]}' end performance
from parts""", _group_months("branch")),
    "q09_4_product_performance": _valid(f"""
select product, {MONTH}, n transactions, {_product_change}, cast({_product_mean} as double) / 1000000 product_avg,
       case when c * 10000 > {_product_mean} then '{model.VERSUS_PRODUCT[0]}'
            when c * 10000 < {_product_mean} then '{model.VERSUS_PRODUCT[1]}' else '{model.VERSUS_PRODUCT[2]}' end performance
from parts""", _group_months("product")),
    "q09_5_customer_benchmark": _valid(f"""
select customer_id, segment, branch, n transactions, {_rm('c')} total_volume, {_mean('c', 'n')} avg_amount,
       cast(m as double) / 1000000 segment_avg_volume, cast(c * 10000 - m as double) / 1000000 diff_from_segment_avg,
       {_peer_band('c', 'm', model.PEER_BANDS, model.PEER_REST)} performance_band
from (select *, {_micros('sum(c) over (partition by segment)', 'count(*) over (partition by segment)')} m from cv)""",
                                       CUSTOMER_VOLUMES),

    "q10_1_rfm": _rfm(model.VALUE_BANDS),
    "q10_1_rfm_large_values": _rfm(LARGE_VALUES),
    "q10_2_transaction_risk": _risk(EVENTS),
    "q10_2_transaction_risk_lines": _risk(LINES),
    "q10_3_tenure_bands": _with(LINES, VALID, CUSTOMERS, TENURE) + f"""
select customer_id, segment, branch, {_iso('join_date')} join_date, y tenure_years,
       {_case('y', '>=', model.TENURE_BANDS, model.TENURE_REST)} tenure_band, n transactions,
       {_rm('c')} total_volume, {_mean('c', 'n')} avg_amount from held""",
    "q10_4_tenure_summary": _with(LINES, VALID, CUSTOMERS, TENURE) + f"""
select segment, {_case('y', '>=', model.TENURE_GROUPS, model.TENURE_GROUP_REST)} tenure_band, count(*) customers,
       cast(sum(n) as bigint) transactions, {_rm('sum(c)')} total_volume,
       {_mean('sum(c)', 'count(c)')} avg_volume_per_customer from held group by 1, 2""",
    "q10_5_month_activity": _valid(f"""
select {MONTH}, n transactions, {_rm('c')} total_volume, cast(m as double) / 1000000 monthly_avg,
       case when c * 100000 > m * 12 then '{model.PEAK}' when c * 100000 < m * 8 then '{model.LOW}'
            else '{model.NORMAL_MONTH}' end activity_level
from (select *, {_micros('sum(c) over ()', 'count(*) over ()')} m from months)""", MONTHS),

    "q11_1_branch_share": _valid(_shares("branch")),
    "q11_2_segment_share": _valid(f"""
select segment, count(*) transactions, {HOLDERS}, {VOLUME}, {_rm('sum(sum(cents)) over ()')} whole_volume,
       {_pct('sum(cents)', 'sum(sum(cents)) over ()')} volume_share_pct,
       {_pct('count(distinct customer_id)', 'sum(count(distinct customer_id)) over ()')} customer_share_pct
from valid group by segment"""),
    "q11_3_product_share": _valid(_shares("product")),
    "q11_4_type_within_branch": _valid(_inside("branch", "transaction_type")),
    "q11_5_segment_within_branch": _valid(_inside("branch", "segment", f"{HOLDERS}, ")),
    "q11_6_month_share": _valid(f"""
select {MONTH}, n transactions, {_rm('c')} total_volume, {_rm('sum(c) over ()')} whole_volume,
       {_pct('c', 'sum(c) over ()')} volume_share_pct, {_pct('n', 'sum(n) over ()')} transaction_share_pct
from months""", MONTHS),
    "q11_7_product_mix": _valid(f"""
select *, cast((2 * sum(cast(round(avg_amount * 1000000) as hugeint)) over (partition by segment)
                + count(*) over (partition by segment)) // (2 * count(*) over (partition by segment)) as double)
          / 1000000 segment_avg_amount
from ({_inside('segment', 'product', f'count(*) transactions, {AVERAGE}, ')})"""),
    "q11_8_anomaly_share": _with(EVENTS, FLAGGED) + f"""
select case when is_anomaly then '{model.ANOMALY}' else '{model.NORMAL}' end kind, count(*) transactions, {VOLUME},
       {_rm('sum(sum(cents)) over ()')} whole_volume, {_pct('count(*)', 'sum(count(*)) over ()')} count_share_pct,
       {_pct('sum(cents)', 'sum(sum(cents)) over ()')} volume_share_pct
from flagged where status <> 'Failed' group by is_anomaly""",

    "q12_customer_report": _customer_report(LINES, AS_OF, model.TIERS),
    "q12_customer_report_large_tiers": _customer_report(LINES, AS_OF, LARGE_TIERS),
    "q12_customer_report_events": _customer_report(EVENTS, EVENTS_AS_OF, model.TIERS),
    "q13_product_report": _product_report(LINES, AS_OF),
    "q13_product_report_events": _product_report(EVENTS, EVENTS_AS_OF),

    "enrich_time_columns": _with(LINES) + f"""
select transaction_id, {_iso('date')} date, {_iso("date_trunc('month', date)")} month_start,
       strftime(date, '%b %Y') as month, year(date) || 'Q' || quarter(date) as quarter, week(date) as week from lines""",
    "flag_anomalies": _with(EVENTS, FLAGGED) + "select transaction_id, segment, is_anomaly from flagged",
    "anomaly_rate": _with(EVENTS, FLAGGED) + """
select count(*) filter (is_anomaly) anomalies, count(*) transactions,
       avg(cast(is_anomaly as int)) * 100 anomaly_rate_pct from flagged where status <> 'Failed'""",
    "extract_period": _period(f"""
select transaction_id, {_iso('date')} date, customer_id, segment, branch, product, transaction_type, category,
       {_rm('cents')} amount, status from period"""),
    "report_kpi_summary": _with(PERIOD_LINES, FLAGGED) + _report_kpis("flagged", "31 December 2001"),
    "report_kpi_summary_events":
        _with(EVENTS, FLAGGED) + _report_kpis("flagged where status <> 'Failed'", "31 January 2024"),
    "report_monthly": _period(f"select {REPORT_MONTH}, n transactions, {_rm('c')} total_volume from months", REPORT_MONTHS),
    "report_by_branch": _period(f"select {BRANCH_TABLE} from period group by branch"),
    "report_by_type": _period(f"""
select transaction_type, count(*) transactions, {VOLUME},
       {_pct('sum(cents)', 'sum(sum(cents)) over ()', 1)} share_pct from period group by transaction_type"""),
    "report_by_product": _period(_grouped("product", f"count(*) transactions, {VOLUME}", "period")),
    "report_by_segment": _period(_grouped("segment", f"""count(*) transactions, {VOLUME}, {HOLDERS},
       {_mean('sum(cents)', 'count(distinct customer_id)', 2)} avg_per_customer""", "period")),
    "report_top_customers": _period(f"select customer_id, transactions, {_rm('c')} total_volume from ({TOP})"),
    "report_anomaly_list": _with(EVENTS, FLAGGED) + f"""
select {FLAGGED_ROW} from flagged where is_anomaly order by cents desc, transaction_id limit 20""",
    "report_flagged_rows": _with(EVENTS, FLAGGED) + f"select {FLAGGED_ROW} from flagged where is_anomaly",
    "report_saved_flagged_rows": _with(EVENTS, FLAGGED) + f"select {FLAGGED_ROW} from flagged where is_anomaly",
    "report_month_ratios": _period(f"""
select {REPORT_MONTH}, n transactions, {_rm('c')} total_volume,
       ({_rm('c')} - lag({_rm('c')}) over (order by mon)) / lag({_rm('c')}) over (order by mon) volume_change,
       cast(n - lag(n) over (order by mon) as double) / lag(n) over (order by mon) transaction_change
from months""", REPORT_MONTHS),
    "report_monthly_with_total": _period(f"""
select {REPORT_MONTH}, n transactions, {_rm('c')} total_volume from months
union all select null, '{model.TOTAL}', cast(sum(n) as bigint), {_rm('sum(c)')} from months""", REPORT_MONTHS),
    "report_branch_share": _period(f"select {BRANCH_TABLE}, {BRANCH_SHARE} from period group by branch"),
    "report_top_customers_numbered": _period(f"""
select row_number() over (order by c desc, customer_id) as position, customer_id, transactions,
       {_rm('c')} total_volume from ({TOP})"""),
    "report_saved_branch_table": _period(f"select {BRANCH_TABLE}, {BRANCH_SHARE} from period group by branch"),

    "csv_customers": _with(CUSTOMERS) + f"select customer_id, segment, branch, {_iso('join_date')} join_date from cust",
    "load_transactions": _valid(f"""
select year(mon) * 100 + month(mon) load_month, false is_anomaly, count(*) transactions, {VOLUME},
       '2002-01-01 00:00:00' load_date from valid where year(date) = 1998 group by mon"""),
    "load_transactions_whole": _with(LINES) + f"""
select year(date) * 100 + month(date) load_month, status, count(*) transactions, {VOLUME}, count(distinct transaction_id) ids
from lines group by 1, 2""",
    "load_events_checks": _with(EVENTS, CUSTOMERS, """
given as (select *, cast(transaction_id as bigint) id from lines
          union all select *, cast(transaction_id as bigint) id from lines where cast(transaction_id as bigint) % 101 = 0),
fit as (select * from given where id % 97 <> 0),
known as (select customer_id from cust where cast(customer_id as bigint) % 50 <> 0)""") + """
select 'loaded' measure, count(*) as rows from fit
union all select 'rejected', count(*) from given where id % 97 = 0
union all select 'duplicate_transactions', count(*) from (select id from fit group by id having count(*) > 1)
union all select 'unknown_customers', count(distinct customer_id) from fit
where customer_id is not null and customer_id not in (select customer_id from known)
union all select 'duplicate_customers', 0""",
    "dim_date": _with(LINES) + DATE_DIMENSION,
    "dim_product": _with(LINES) + PRODUCT_DIMENSION,
    "dim_branch": _with(LINES) + BRANCH_DIMENSION,
    "load_defaults": _with(LINES) + """
select transaction_id, false is_anomaly, '2002-01-01 00:00:00' load_date from lines""",
    "check_unique_transactions": _with(LINES) + """
select transaction_id, count(*) as rows from lines group by transaction_id having count(*) > 1""",
    "check_unique_line_numbers": """
select l_orderkey, l_linenumber, count(*) as rows from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
    "check_foreign_key_customers": _with(LINES, CUSTOMERS) + """
select customer_id, count(*) as rows from lines where customer_id is not null
and customer_id not in (select customer_id from cust) group by customer_id""",
    "check_foreign_key_inactive": _with(LINES, VALID, CUSTOMERS) + """
select customer_id, count(*) as rows from cust
where not exists (select 1 from valid where valid.customer_id = cust.customer_id) group by customer_id""",
    "load_events_keyed": _with(EVENTS, """
given as (select *, cast(transaction_id as bigint) id, 0 as again from lines
          union all select * replace (cents + 100 as cents), cast(transaction_id as bigint), 1 from lines
          where cast(transaction_id as bigint) % 101 = 0)""", """
sound as (select *, cast(customer_id as bigint) % 50 = 0 orphan from given where id % 97 <> 0)""") + """
select 'fact_transactions' measure, count(*) as rows, cast(sum(cents) as double) / 100 total_volume from sound where not orphan and again = 0
union all select 'duplicate_transactions', count(*), cast(sum(cents) as double) / 100 from sound where not orphan and again = 1
union all select 'orphan_transactions', count(*), cast(sum(cents) as double) / 100 from sound where orphan
union all select 'rejected_transactions', count(*), null from given where id % 97 = 0
union all select 'dim_customers', count(*), null from customer where c_custkey % 50 <> 0
union all select 'duplicate_customers', count(*), null from customer where c_custkey % 50 <> 0 and c_custkey % 7 = 0""",
    "load_lines_keyed": _with(LINES, """
numbered as (
  select * replace (split_part(transaction_id, '-', 1) || '-' || split_part(transaction_id, '-', 2) as transaction_id),
         cast(customer_id as bigint) % 50 = 0 orphan from lines)""", """
judged as (
  select *, case when orphan then 'orphan' when row_number() over (
      partition by transaction_id, orphan
      order by date, customer_id, segment, branch, product, transaction_type, category, cents, status) = 1
    then 'kept' else 'duplicate' end verdict from numbered)""") + f"""
select verdict, year(date) * 100 + month(date) load_month, count(*) transactions, count(distinct transaction_id) ids, {VOLUME}
from judged group by all""",
    "load_month_twice": _with(LINES, """
months as (select *, year(date) * 100 + month(date) load_month from lines)""") + f"""
select 'fact' as "table", load_month, count(*) transactions,
       {_rm('sum(cents + case when load_month = 199803 then 100 else 0 end)')} total_volume from months group by load_month
union all select 'duplicate', 199803, count(*), {_rm('sum(cents + 100)')} from months where load_month = 199804
having count(*) > 0""",
    "dim_branch_second_load": _with(LINES) + """
select cast(row_number() over (order by coalesce(r_name <> 'EUROPE', true), branch) as integer) branch_id, branch branch_name, r_name region
from (select distinct branch from lines where branch is not null) left join nation on n_name = branch left join region on r_regionkey = n_regionkey""",
    "check_not_null_transactions": _with(LINES) + "\nunion all ".join(
        f"""select '{name}' as "column", count(*) - count({'cents' if name == 'amount' else name}) nulls from lines"""
        for name in FACT_TYPES),
    "check_not_null_tenure": _with(LINES, VALID, CUSTOMERS, TENURE) + """
select 'customer_id' as "column", count(*) - count(customer_id) nulls from held
union all select 'transactions', count(*) - count(n) from held
union all select 'total_volume', count(*) - count(c) from held""",
    "table_counts": _with(LINES, CUSTOMERS) + """
select 'fact_transactions' as "table", count(*) as rows from lines
union all select 'dim_customers', count(*) from cust
union all select 'dim_date', date_diff('day', min(date), max(date)) + 1 from lines
union all select 'dim_product', count(distinct product) from lines
union all select 'dim_branch', count(distinct branch) from lines""",
    "profile_columns": _with(LINES, "shown as (select *, cast(cents / 100 as decimal(15,2)) amount from lines)")
    + _profile("fact_transactions", FACT_TYPES, "shown"),
    "profile_customers_exact": _with(CUSTOMERS) + _profile("dim_customers", CUSTOMER_TYPES, "cust", exact=True),
    "profile_dimensions": _with(
        LINES, CUSTOMERS, f"days as ({DATE_DIMENSION})", f"products as ({PRODUCT_DIMENSION})",
        f"branches as ({BRANCH_DIMENSION})")
    + "\nunion all ".join([
        _profile("dim_customers", CUSTOMER_TYPES, "cust"),
        _profile("dim_date", {
            "date_id": "int", "full_date": "date", "day_of_week": "string", "day_num": "int", "week_num": "int",
            "month_num": "int", "month_name": "string", "quarter": "int", "year": "int", "is_weekend": "boolean",
        }, "days"),
        _profile("dim_product", {"product_id": "int", "product_name": "string"}, "products"),
        _profile("dim_branch", {"branch_id": "int", "branch_name": "string", "region": "string"}, "branches"),
    ]),
}
ORACLE["anomaly_moments"] = _valid(f"""
select segment, {_iso('mon')} month_start, count(*) n, {_rm('sum(cents)')} total, cast(sum(cast(cents as hugeint) * cents) as varchar) squares
from valid group by segment, mon""")
# The same results by another way.
ORACLE["flag_anomalies_from_moments"] = ORACLE["flag_anomalies"]
ORACLE["q13_product_report_from_state"] = ORACLE["q13_product_report"]


def _spine(by: str | None = None) -> list[str]:
    """Views of the rows of some months, and of all months (by group) with what these have."""
    shift, group = (f"length({by})", f"{by}, ") if by else ("0", "")
    names = f"(select distinct {by} from chosen)" if by else "(select 1 from chosen limit 1)"
    using = f"({by}, mon)" if by else "(mon)"
    return [
        f"chosen as (select * from valid where (year(mon) * 12 + month(mon) + {shift}) % 5 = 0)",
        "calendar as (select unnest(generate_series(min(mon), max(mon), interval 1 month)) mon from chosen)",
        f"held as (select {group}mon, count(*) n, sum(cents) c from chosen group by {group}mon)",
        f"{'parts' if by else 'months'} as (select {group}mon, coalesce(n, 0) n, coalesce(c, 0) c "
        f"from {names} cross join calendar left join held using {using})",
    ]


ORACLE |= {
    "q07_5_monthly_by_segment_dense": _valid(f"select {MONTH}, segment, n transactions, {_rm('c')} total_volume from parts", *_spine("segment")),
    "q08_2_moving_averages_dense": _valid(f"select {MONTH}, {_rm('c')} total_volume, {_moving(3)}, {_moving(6)} from months", *_spine()),
    "q08_4_running_by_branch_dense": _valid(_running("branch", {
        "total_volume": _rm("c"), "running_transactions": "cast(sum(n) {over} as bigint)", "running_volume": RUNNING_VOLUME,
        "transactions": "n"}), *_spine("branch")),
    "q09_1_month_over_month_dense": _valid(f"""
select {MONTH}, n transactions, {_changes('order by mon')}, {_trend('order by mon')} from months""", *_spine()),
    "q08_5_running_in_order": _valid(f"""
select customer_id, {_iso('date')} date, transaction_id, {_rm('sum(cents) over (partition by customer_id order by date, transaction_id)')} running_total,
       row_number() over (order by customer_id, date, transaction_id) row_number from valid"""),
    "report_at_once": _period("""
select result, rows, rows saved from (
  select 'transactions' result, count(*) as rows from period
  union all select 'kpi', 1
  union all select 'monthly', count(distinct mon) + 1 from period
  union all select 'branch', count(distinct branch) from period
  union all select 'by_type', count(distinct transaction_type) from period
  union all select 'by_product', count(distinct product) from period
  union all select 'by_segment', count(distinct segment) from period
  union all select 'top_customers', least(10, count(distinct customer_id)) from period
  union all select 'anomalies', least(20, count(*)) from outliers
  union all select 'flagged', count(*) from outliers)""", """
outliers as (
  select period.* from period join (select segment, avg(cents / 100) + 3 * stddev_samp(cents / 100) top from period group by segment) using (segment)
  where cents / 100 > top)"""),
}
