"""Date column functions: parsing model dates and placing dates in buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import DATE_FMT


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_model_date(c: str | Column, fmt: str = DATE_FMT) -> Column:
    """M/d/yy text to DATE; blank, 'null', 4-digit years, impossible
    days give null (``try_to_date`` keeps ANSI mode on without raising)."""
    c = _c(c)
    return F.when(c.isNotNull() & (F.trim(c) != ""), F.try_to_date(c, fmt)).otherwise(
        F.lit(None).cast("date")
    )


def elapsed_bucket(t: str | Column, start: str | Column, width: int) -> Column:
    """floor(months_between(t, start) / width) * width as INT."""
    m = F.months_between(_c(t), _c(start))
    return (F.floor(m / width) * width).cast("int")


def calendar_bucket(t: str | Column, start: str | Column, width: int) -> Column:
    """The k with add_months(start, k) <= t < add_months(start, k + width).

    months_between floors to the right bucket except at month ends, where the
    calendar bucket can be one later; one add_months comparison decides it.
    A pure projection: no join with a bucket table is needed.
    """
    t, start = _c(t), _c(start)
    k0 = elapsed_bucket(t, start, width)
    return F.when(t >= F.add_months(start, k0 + width), k0 + width).otherwise(k0)


def as_date(c: str | Column) -> Column:
    """Dates, timestamps and yyyy-MM-dd text to DATE; bad text to null."""
    return _c(c).try_cast("date")
