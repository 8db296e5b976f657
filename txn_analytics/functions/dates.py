"""Calendar expressions. Gaps count the month or year boundaries crossed, not elapsed whole units."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value) -> Column:
    """A date column from a column, a ``date`` or an ISO string."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def day_gap(start, end) -> Column:
    return F.datediff(end, start)


def month_gap(start, end) -> Column:
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def year_gap(start, end) -> Column:
    return F.year(end) - F.year(start)


def month_label(day) -> Column:
    """``Jan 2024``"""
    return F.date_format(day, "MMM yyyy")


def quarter_label(day) -> Column:
    """``Q1 2024``"""
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"), F.lit(" "), F.year(day).cast("string"))


def quarter_code(day) -> Column:
    """``2024Q1``"""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def weekday_name(number) -> Column:
    """Name of a weekday number that counts Sunday as 1."""
    a_sunday = F.lit("2023-12-31").cast("date")
    return F.date_format(F.date_add(a_sunday, number - 1), "EEEE")
