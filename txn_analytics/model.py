"""Table schemas, and the labels and limits that every operator shares."""

from pyspark.sql import types as T

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("branch", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amount", T.DecimalType(15, 2)),
    T.StructField("status", T.StringType()),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("branch", T.StringType()),
    T.StructField("join_date", T.DateType()),
])

# Added on load, after the columns a file carries.
LOAD_COLUMNS = T.StructType([
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("load_date", T.TimestampType()),
])

# ---------------------------------------------------------------------------
# Fixed values. Labels and limits that results must show exactly as given.
# A list of (limit, label) runs in the order in which it is tried.
# ---------------------------------------------------------------------------

COMPLETED, PENDING, FAILED = "Completed", "Pending", "Failed"

# amount below the limit
AMOUNT_BANDS = [
    (1000, "1. Below RM 1,000"),
    (10000, "2. RM 1,000 – 9,999"),
    (50000, "3. RM 10,000 – 49,999"),
    (100000, "4. RM 50,000 – 99,999"),
]
AMOUNT_BAND_REST = "5. RM 100,000 and above"

# transactions of a customer, at or below the limit
ACTIVITY_BANDS = [
    (1, "1 Transaction"),
    (5, "2–5 Transactions"),
    (10, "6–10 Transactions"),
    (20, "11–20 Transactions"),
]
ACTIVITY_BAND_REST = "20+ Transactions"

# days since the last transaction, at or below the limit
RECENCY_BANDS = [(30, "Active"), (90, "Lapsing")]
RECENCY_REST = "Dormant"

# at or above the limit
FREQUENCY_BANDS = [(50, "High Frequency"), (20, "Medium Frequency")]
FREQUENCY_REST = "Low Frequency"
VALUE_BANDS = [(500000, "Platinum"), (100000, "Gold"), (20000, "Silver")]
VALUE_REST = "Bronze"

# customer groups by recency, frequency and value
CHAMPION, LOYAL, AT_RISK = "Champion", "Loyal Customer", "At Risk - High Value"
LOST, REGULAR = "Lost Customer", "Regular Customer"

RISK_OUTLIER = "Critical — Statistical Outlier"
RISK_BANDS = [
    (100000, "High Risk — Large Amount"),
    (50000, "Medium Risk — Elevated Amount"),
    (10000, "Low Risk — Standard Large"),
]
RISK_REST = "Normal — Routine Transaction"
ESCALATE_FROM = 100000
REVIEW_FAILED, ESCALATE, FLAG, NO_ACTION = (
    "Review Failed", "Escalate to Compliance", "Flag for Review", "No Action Required")

# a month against the mean month: above the first factor, below the second
PEAK_FACTOR, LOW_FACTOR = "1.2", "0.8"
PEAK, LOW, NORMAL_MONTH = "Peak Month", "Low Month", "Normal Month"

# a period against the one before it
BASELINE, GROWTH, DECLINE, FLAT = "Baseline", "Growth", "Decline", "Flat"

# a month against the mean of its branch or product: above, below, equal
VERSUS_BRANCH = ("Above Average", "Below Average", "Average")
VERSUS_PRODUCT = ("Above Annual Avg", "Below Annual Avg", "At Annual Avg")

ANOMALY, NORMAL = "Anomaly", "Normal"
TOTAL = "TOTAL"

# whole calendar years since joining, at or above the limit
TENURE_BANDS = [(5, "Veteran (5+ Years)"), (3, "Established (3–5 Years)"), (1, "Growing (1–3 Years)")]
TENURE_REST = "New (< 1 Year)"
TENURE_GROUPS = [(5, "Veteran"), (3, "Established"), (1, "Growing")]
TENURE_GROUP_REST = "New"

# share of the group mean that a customer's volume must exceed
PEER_BANDS = [("1.5", "High Performer"), ("1", "Above Average"), ("0.5", "Below Average")]
PEER_REST = "Low Performer"

# Customer report.
TIERS = [(500000, "VIP"), (100000, "Premium"), (20000, "Regular")]
TIER_REST = "New / Low Activity"
REPORT_TENURE = [(60, "Veteran (5+ Yrs)"), (36, "Established (3–5 Yrs)"), (12, "Growing (1–3 Yrs)")]
REPORT_TENURE_REST = "New (< 1 Yr)"
# months since the last transaction: none, then at or below the limit
REPORT_THIS_MONTH = "Active This Month"
REPORT_ACTIVITY = [(3, "Active (< 3 Months)"), (6, "Lapsing (3–6 Months)")]
REPORT_ACTIVITY_REST = "Dormant (6+ Months)"
CUSTOMER_RISK = [(3, "High Risk"), (1, "Monitor")]
PRODUCT_RISK = [(10, "High Risk"), (5, "Monitor")]
RISK_CLEAN = "Clean"
SEGMENT_BANDS = [("1.5", "Top Performer"), ("1", "Above Segment Avg"), ("0.5", "Below Segment Avg")]
SEGMENT_REST = "Low Performer"

# Product report.
PRODUCT_TIERS = [("0.25", "High Performer"), ("0.10", "Mid-Range")]
PRODUCT_TIER_REST = "Low Performer"
# completion percentages: healthy or active from, failing below
HEALTHY_FROM, ACTIVE_FROM, FAILING_BELOW = 90, 75, 60
HEALTHY, ACTIVE, FAILING, MONITOR = "Healthy", "Active", "High Failure Rate", "Monitor"
ADOPTION = [(100, "Widely Adopted"), (50, "Moderately Adopted"), (20, "Niche")]
ADOPTION_REST = "Low Adoption"
