"""Sums, means and rates used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts, miles, minutes and surge carry at most two decimals; four leave room.
UNITS = 10_000.0


def exact_sum(name: str) -> Column:
    """Sum of a double column that does not depend on the order in which tasks finish (see `exact_sum_sql`)."""
    return F.expr(exact_sum_sql(name))


def exact_mean(name: str) -> Column:
    """Mean of the non-NULL values, built on `exact_sum`; NULL if there are none."""
    return F.expr(exact_mean_sql(name))


def exact_sum_sql(name: str) -> str:
    """SQL for an order-independent sum.

    Whole units are added as longs, which is exact in any order, and what is left of each value
    (nothing, for values of up to four decimals) is added as a double. Unlike a plain double sum the
    result of such values stays the same when lost tasks are run again, at a fraction of a decimal sum's cost.
    Where the units do not fit a long, the plain double sum stands in. NULL if all values are NULL; NaN and
    infinity come through as in a plain sum.
    """
    units = f"coalesce(try_cast(rint(`{name}` * {UNITS}D) AS BIGINT), 0L)"
    return f"coalesce(try_sum({units}) / {UNITS}D + sum(`{name}` - {units} / {UNITS}D), sum(`{name}`))"


def exact_mean_sql(name: str) -> str:
    return f"try_divide({exact_sum_sql(name)}, count(`{name}`))"


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, or NULL when there is nothing to divide by."""
    return F.try_divide(part, whole) * 100
