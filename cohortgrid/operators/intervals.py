"""Overlap join of two interval tables, off any grid.

Intervals are put into bins of a level that fits their length: bins of level
``k`` are ``BASE ** k`` times as wide as those of level 0, and an interval's
own level is the lowest at which it touches two bins at most; the top level
is one bin, for open ends and whatever is longer. Two intervals meet at the
higher of their own levels, so each interval is listed in its bins of its own
level and of those above that are an own level of the other side: at most two
a level. A pair is reported in its first common bin only, so no pair comes
twice and nothing is made distinct.

The join keys hold the bin, so a hot key is dealt out along its time axis.
Bins cost rows and save pairs to be looked at; a key of few rows is joined
whole, as one bin, and is listed once. Keys with more than ``DENSE`` rows on a
side have bins. The width of level 0 is the median length of the closed
intervals of those keys; if it is given, all keys have bins. Either changes
speed only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import materialize

BASE = 8
LEVELS = 5
DENSE = 256


def median_length(*sides: tuple[DataFrame, str, str]) -> int:
    """The approximate median length in days of the closed intervals of
    some tables; one aggregate of a few numbers a table."""
    found = []
    for df, start, end in sides:
        days = F.date_diff(F.col(end).cast("date"), F.col(start).cast("date"))
        n, median = df.filter(days >= 0).agg(F.count("*"), F.percentile_approx(days, 0.5, 1000)).first()
        found.append((n or 0, median or 0))
    total = sum(n for n, _ in found)
    return max(1, round(sum(n * m for n, m in found) / total)) if total else 1


def _bin(day: Column, level: int, width: int) -> Column:
    return F.floor(day / (width * BASE**level)).cast("int")


def _days(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows that are intervals, with ``__s`` and ``__e`` (day numbers, a null
    end is open)."""
    epoch = F.lit("1970-01-01").cast("date")
    first, last = F.date_diff(start, epoch), F.date_diff(end, epoch)
    return df.withColumns({"__s": first, "__e": last}).filter(F.col("__s").isNotNull() & (F.col("__e").isNull() | (F.col("__e") >= F.col("__s"))))


def _levelled(df: DataFrame, start: Column, end: Column, width: int) -> DataFrame:
    """``_days`` with the own level: the top one for rows that a column
    ``__dense`` does not mark."""
    own = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        own = F.when(_bin(F.col("__e"), k, width) - _bin(F.col("__s"), k, width) <= 1, k).otherwise(own)
    if "__dense" in df.columns:
        own = F.when(F.col("__dense"), own).otherwise(LEVELS)
    return _days(df, start, end).withColumn("__own", own)


def _dense_keys(left: DataFrame, right: DataFrame, keys: list[str], most: int) -> DataFrame | None:
    """The keys with more than ``most`` rows on a side, written with a mark;
    none if there are none."""
    of = lambda df: df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") > most).select(*keys)
    found = materialize(of(left).unionByName(of(right)).distinct(), "dense_keys")
    return None if found.isEmpty() else found.withColumn("__dense", F.lit(True))


def _own_levels(df: DataFrame, start: Column, end: Column, width: int) -> set[int]:
    """The own levels that a side has; one aggregate of a few numbers."""
    counts = _levelled(df, start, end, width).agg(*(F.count_if(F.col("__own") == k) for k in range(LEVELS + 1))).first()
    return {k for k, n in enumerate(counts) if n}


def _binned(df: DataFrame, start: Column, end: Column, width: int, others: Iterable[int] = range(LEVELS + 1)) -> DataFrame:
    """One row per (level, bin) of a row's own level and of the higher ones
    among ``others``, the own levels of the other side."""

    def listed(k: int) -> Column:
        meets = F.col("__own") <= k if k in others else F.col("__own") == k
        if k == LEVELS:
            top = F.array(F.struct(F.lit(k).alias("__level"), F.lit(0).alias("__bin"), F.lit(0).alias("__first")))
            return F.when(meets, top).otherwise(F.array().cast("array<struct<__level:int,__bin:int,__first:int>>"))
        lo = _bin(F.col("__s"), k, width)
        bins = F.transform(F.sequence(lo, _bin(F.col("__e"), k, width)), lambda b: F.struct(F.lit(k).alias("__level"), b.alias("__bin"), lo.alias("__first")))
        return F.when(meets, bins).otherwise(F.array().cast("array<struct<__level:int,__bin:int,__first:int>>"))

    return _levelled(df, start, end, width).select("*", F.inline(F.concat(*(listed(k) for k in range(LEVELS + 1)))))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Iterable[str],
    left_interval: tuple[str, str],
    right_interval: tuple[str, str],
    width: int | None = None,
    dense: int = DENSE,
) -> DataFrame:
    """Pairs of rows with equal ``keys`` whose closed day intervals overlap:
    all columns of both sides (the right's keys once) with ``overlap_start``
    and ``overlap_end``, the days that both hold (a null end: both are open).

    A null end is open. Rows with a null key or start, or an end before the
    start, pair with nothing. Other column names must differ between sides.
    Repeated rows pair each. Keys with more than ``dense`` rows on a side have
    bins, all keys if ``width`` is given. Both sides are read by aggregates
    before they are joined, so what is costly to derive is best written first.
    """
    keys = list(keys)
    (ls, le), (rs, re_) = left_interval, right_interval
    day = lambda c: F.col(c).cast("date")
    one, other = (left, day(ls), day(le)), (right, day(rs), day(re_))
    many = None if width is not None else _dense_keys(left, right, keys, dense)
    binned = width is not None or many is not None
    if binned:
        dense_left, dense_right = left, right  # the rows that have bins
        if many is not None:
            one, other = ((df.join(many, keys, "left"), *days) for df, *days in (one, other))
            dense_left, dense_right = one[0].filter("__dense"), other[0].filter("__dense")
            width = median_length((dense_left, ls, le), (dense_right, rs, re_))
        a = _binned(*one, width, _own_levels(dense_right, *other[1:], width))
        b = _binned(*other, width, _own_levels(dense_left, *one[1:], width))
    else:
        a, b = _days(*one), _days(*other)
    b = b.select(*(F.col(c).alias(f"__r_{c}") if c in keys or c.startswith("__") else F.col(c) for c in b.columns))
    same = [F.col(k) == F.col(f"__r_{k}") for k in (*keys, *(("__level", "__bin") if binned else ()))]
    condition = (F.col("__r___e").isNull() | (F.col("__s") <= F.col("__r___e"))) & (F.col("__e").isNull() | (F.col("__r___s") <= F.col("__e")))
    if binned:
        meets = F.greatest("__own", "__r___own") == F.col("__level")
        first = F.greatest("__first", "__r___first") == F.col("__bin")
        condition = meets & first & condition
    for c in same:
        condition = c & condition
    # The size of a side's files says little of its rows in bins: no broadcast.
    joined = a.join(b.hint("merge"), condition)
    out = [c for c in [*left.columns, *right.columns] if c not in keys]
    return joined.select(*keys, *out, F.greatest(day(ls), day(rs)).alias("overlap_start"), F.least(day(le), day(re_)).alias("overlap_end"))
