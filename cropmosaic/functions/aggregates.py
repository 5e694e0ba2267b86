"""Aggregates with explicit NULL rules, and the diversity indices."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_sum(value: Column) -> Column:
    """Sum that is NULL as soon as one value is NULL."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def lenient_sum(value: Column) -> Column:
    """Sum that skips NULLs and is 0 when there is nothing to add."""
    return F.coalesce(F.sum(value), F.lit(0))


def strict_max(value: Column) -> Column:
    """Maximum that is NULL as soon as one value is NULL."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.max(value))


def distinct_with_null(value: Column) -> Column:
    """Distinct count in which NULL is one more value."""
    return F.count_distinct(value) + F.max(value.isNull().cast("long"))


def _checked(value: Column) -> Column:
    """The value as double; negative abundances stop the job."""
    return F.when(value < 0, F.raise_error(F.lit("diversity needs non-negative values"))).otherwise(
        value.cast("double")
    )


def shannon(value: Column) -> Column:
    """-sum(p ln p) with p = value / group sum, in one pass: ln S - sum(x ln x) / S.

    A NULL in the group gives NULL; a group of zeros gives 0.
    """
    x = _checked(value)
    total = F.sum(x)
    weighted = F.coalesce(F.sum(F.when(x > 0, x * F.ln(x))), F.lit(0.0))
    index = F.when(total > 0, F.ln(total) - weighted / F.nullif(total, F.lit(0.0))).otherwise(F.lit(0.0))
    return F.when(F.count(x) == F.count(F.lit(1)), F.greatest(index, F.lit(0.0)))


def simpson(value: Column) -> Column:
    """1 - sum(p^2) with p = value / group sum; a NULL gives NULL, a group of zeros gives 1."""
    x = _checked(value)
    total = F.sum(x)
    index = F.when(total > 0, 1 - F.sum(x * x) / F.nullif(total * total, F.lit(0.0))).otherwise(F.lit(1.0))
    return F.when(F.count(x) == F.count(F.lit(1)), F.greatest(index, F.lit(0.0)))
