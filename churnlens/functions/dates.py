"""Calendar arithmetic as JVM-side column expressions (no UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: fallback as-of date per source when a source is empty.
AS_OF_FALLBACK = _dt.date(2000, 1, 1)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """date_trunc('month', x)::date — returns a DATE (not a timestamp)."""
    return F.trunc(col_(c).cast("date"), "MM")


def month_end(c) -> Column:
    """month_start + 1 month - 1 day."""
    return F.last_day(col_(c).cast("date"))


def whole_month_diff(later, earlier) -> Column:
    """(year(a)-year(b))*12 + (month(a)-month(b)) as INT; calendar months,
    not the fractional months_between."""
    a, b = col_(later), col_(earlier)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("int")


def days_between(later, earlier) -> Column:
    """date - date -> integer days."""
    return F.datediff(col_(later), col_(earlier))


def month_sequence(start, stop) -> Column:
    """Months from ``start`` to ``stop`` (both month starts, inclusive);
    empty when start > stop and NULL (no rows) when either side is NULL,
    matching generate_series. ``sequence`` itself throws on start > stop."""
    s, e = col_(start), col_(stop)
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 MONTH")))


def lit_date(d: _dt.date) -> Column:
    return F.lit(d).cast("date")
