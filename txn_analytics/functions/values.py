"""Arithmetic and banding expressions over amounts and counts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from txn_analytics import model


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def completed_or_pending() -> Column:
    """True for rows that did not fail; NULL (so dropped by a filter) where the status is NULL."""
    return F.col("status") != model.FAILED


def percent(part, whole, digits: int | None = 2) -> Column:
    """100 * part / whole, NULL where whole is zero. In doubles, so that no sum can overflow a decimal."""
    ratio = F.try_divide(_col(part).cast("double"), _col(whole).cast("double")) * 100
    return ratio if digits is None else F.round(ratio, digits)


def per_unit(total, units, digits: int = 2) -> Column:
    """An exact decimal total divided by a count, NULL where the count is zero."""
    return F.round(F.try_divide(_col(total), _col(units).cast("decimal(20,0)")), digits)


def at_least_one(months) -> Column:
    """The number of months, at least 1; NULL where it is not known."""
    return F.when(_col(months).isNotNull(), F.greatest(_col(months), F.lit(1)))


def band_below(value, steps, rest: str) -> Column:
    """Label of the first step whose limit the value stays below; NULL stays below none."""
    out = None
    for limit, label in steps:
        below = _col(value) < F.lit(limit)
        out = F.when(below, label) if out is None else out.when(below, label)
    return out.otherwise(rest)


def band_from(value, steps, rest: str) -> Column:
    """Label of the first step whose limit the value reaches."""
    out = None
    for limit, label in steps:
        reached = _col(value) >= F.lit(limit)
        out = F.when(reached, label) if out is None else out.when(reached, label)
    return out.otherwise(rest)


def band_upto(value, steps, rest: str) -> Column:
    """Label of the first step whose limit the value does not pass."""
    out = None
    for limit, label in steps:
        inside = _col(value) <= F.lit(limit)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out.otherwise(rest)


def band_against(value, base, steps, rest: str, strict: bool = True) -> Column:
    """Label of the first step whose multiple of ``base`` the value exceeds (or reaches, if not strict)."""
    out = None
    for factor, label in steps:
        limit = _col(base) * F.lit(factor).cast("decimal(4,2)")
        hit = _col(value) > limit if strict else _col(value) >= limit
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(rest)


def direction(value, previous) -> Column:
    """How a period compares with the one before it."""
    return (
        F.when(_col(previous).isNull(), model.BASELINE)
        .when(_col(value) > _col(previous), model.GROWTH)
        .when(_col(value) < _col(previous), model.DECLINE)
        .otherwise(model.FLAT)
    )


def against_mean(value, mean, labels) -> Column:
    above, below, equal = labels
    return F.when(_col(value) > _col(mean), above).when(_col(value) < _col(mean), below).otherwise(equal)
