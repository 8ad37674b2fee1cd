"""Aggregate expressions. All of them merge partial results map-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share_true(flag: Column) -> Column:
    """Percent of rows whose flag is true, over the rows where it is known."""
    return F.avg(flag.cast("double")) * 100


def share_of_rows(condition: Column) -> Column:
    """Percent of all rows meeting a condition; null on no rows."""
    return F.try_divide(F.count_if(condition) * F.lit(100.0), F.count(F.lit(1)))


def total(number: Column) -> Column:
    """Sum that is 0, not null, over no rows."""
    return F.coalesce(F.sum(number), F.lit(0))


def adjusted_skewness(value: Column) -> Column:
    """Sample skewness with the small-sample correction; null under three values."""
    n = F.count(value).cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n >= 3, F.coalesce(F.skewness(value), F.lit(0.0)) * factor)


def pearson(x: Column, y: Column, minimum: int = 3) -> Column:
    """Correlation over rows where both are known.

    ``corr`` raises on a constant input under ANSI, so the ratio is spelled out
    and a constant input, like too few rows, gives null.
    """
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    ratio = F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))
    return F.when(F.count(px) >= minimum, ratio)


def welch_t(value: Column, arm: Column) -> dict[str, Column]:
    """Unequal-variance t of ``arm`` true against false, with the parts it is made of."""
    yes, no = F.when(arm, value), F.when(~arm, value)
    gap = F.avg(yes) - F.avg(no)
    spread = F.sqrt(
        F.try_divide(F.var_samp(yes), F.count(yes)) + F.try_divide(F.var_samp(no), F.count(no))
    )
    return {
        "rating_gap": gap,
        "welch_t": F.try_divide(gap, spread),
        "n_yes": F.count(yes),
        "n_no": F.count(no),
    }
