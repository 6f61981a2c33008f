"""Medication coverage per bucket, provider names and the parallel rows.

Range joins (event in bucket, order overlaps bucket) are rewritten as
projections: each event gets its calendar bucket directly, each order the
bucket range it overlaps (at most ``len(domain)`` rows per order), then a
plain equi-join / distinct on (mrn, bucket). No patient x bucket x event
product is ever formed.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, calendar_bucket
from ..functions.text import rlike_any
from ..spec import DEFAULT_DRUG_PATTERN, FULL_SPEC, MatrixSpec
from .matrix import META, LongMatrix

NAME_COLUMNS = ("simple_generic", "display_name", "description")


def provider_names(providers: DataFrame, patients: DataFrame, default: str | None = None) -> DataFrame:
    """Per matrix patient the sorted distinct provider names joined by
    ', '. Pairs are de-duplicated first (shuffle on (mrn, name)), so a
    patient with a huge provider table only ships its distinct names; those
    make one cell, so they are bounded by the names there are."""
    p = providers.select(
        F.col("MRN").cast("string").alias("mrn"), F.col("Provider").alias("provider_name")
    ).filter(F.col("provider_name").isNotNull())
    p = p.join(patients.select("mrn"), "mrn", "left_semi").distinct()
    names = p.groupBy("mrn").agg(
        F.concat_ws(", ", F.array_sort(F.collect_list("provider_name"))).alias("note_author")
    )
    if default is None:
        return names
    return patients.select("mrn").join(names, "mrn", "left").select(
        "mrn", F.coalesce(F.col("note_author"), F.lit(default)).alias("note_author")
    )


def matching_names(names: DataFrame, pattern: str = DEFAULT_DRUG_PATTERN, cols: Iterable[str] = NAME_COLUMNS) -> DataFrame:
    """The distinct name tuples that match ``pattern`` in any column.
    ``names`` is the drug dimension, or the event rows themselves."""
    return names.select(*cols).distinct().filter(rlike_any(cols, pattern))


def match_medication(
    df: DataFrame,
    patients: DataFrame,
    pattern: str = DEFAULT_DRUG_PATTERN,
    cols: Iterable[str] = NAME_COLUMNS,
    names: DataFrame | None = None,
) -> DataFrame:
    """Rows of matrix patients whose drug name matches in any column
    (semi-joins instead of a collected IN list). With the drug dimension
    ``names`` each distinct name is matched once and the event rows only meet
    a semi-join on it; otherwise the pattern runs on every row."""
    d = df.withColumn("mrn", F.col("mrn").cast("string"))
    if names is None:
        d = d.filter(rlike_any(cols, pattern))
    else:
        known = matching_names(names, pattern, cols).select(*(F.col(c).alias(f"__{c}") for c in cols))
        d = d.join(known, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cols)), "left_semi")
    return d.join(patients.select("mrn"), "mrn", "left_semi")


def bucket_windows(patients: DataFrame, spec: MatrixSpec = FULL_SPEC) -> DataFrame:
    """Each patient x bucket with [add_months(s, k), add_months(s, k+w))."""
    s = F.col("enrollment_start_date").cast("date")
    b = patients.select("mrn", s.alias("enrollment_start_date"), F.explode(F.sequence(F.lit(spec.lo), F.lit(spec.hi), F.lit(spec.width))).alias("time_bucket"))
    return b.withColumns(
        {
            "time_bucket_label": F.concat(F.col("time_bucket").cast("string"), F.lit("_months")),
            "bucket_start": F.add_months(F.col("enrollment_start_date"), F.col("time_bucket")),
            "bucket_end": F.add_months(F.col("enrollment_start_date"), F.col("time_bucket") + spec.width),
        }
    )


def _starts(patients: DataFrame) -> DataFrame:
    return patients.select("mrn", F.col("enrollment_start_date").cast("date").alias("__start"))


def point_coverage(events: DataFrame, patients: DataFrame, spec: MatrixSpec = FULL_SPEC, date_col: str = "event_date") -> DataFrame:
    """Distinct (mrn, bucket) holding at least one event date in the
    half-open calendar window. Events are de-duplicated per (mrn, day)
    map-side before the join."""
    ev = events.select("mrn", F.col(date_col).alias("__d")).filter(F.col("__d").isNotNull()).distinct()
    k = calendar_bucket("__d", "__start", spec.width)
    hit = ev.join(_starts(patients), "mrn").select("mrn", k.alias("time_bucket"))
    return hit.filter(F.col("time_bucket").between(spec.lo, spec.hi)).distinct()


def interval_coverage(orders: DataFrame, patients: DataFrame, spec: MatrixSpec = FULL_SPEC, flag_cols: Iterable[str] = ()) -> DataFrame:
    """C30b/c: (mrn, bucket[, flags]) for every bucket an order overlaps:
    start < bucket_end and (no end or end >= bucket_start). Null starts
    never match. Each order expands to the bucket range between the
    calendar buckets of its start and end, clamped to the domain."""
    o = orders.join(_starts(patients), "mrn").filter(F.col("order_start").isNotNull())
    first = F.greatest(calendar_bucket("order_start", "__start", spec.width), F.lit(spec.lo))
    last = F.least(F.coalesce(calendar_bucket("order_end", "__start", spec.width), F.lit(spec.hi)), F.lit(spec.hi))
    o = o.withColumns({"__f": first, "__l": last}).filter(F.col("__f") <= F.col("__l"))
    return o.select(
        "mrn", *flag_cols, F.explode(F.sequence(F.col("__f"), F.col("__l"), F.lit(spec.width))).alias("time_bucket")
    )


def admin_events(
    administered: DataFrame, patients: DataFrame, pattern: str = DEFAULT_DRUG_PATTERN, names: DataFrame | None = None
) -> DataFrame:
    m = match_medication(administered, patients, pattern, names=names)
    return m.select("mrn", as_date("taken_time").alias("event_date"))


def order_intervals(
    orders: DataFrame, patients: DataFrame, pattern: str = DEFAULT_DRUG_PATTERN, names: DataFrame | None = None
) -> DataFrame:
    """Matched orders with dates and ``has_refill`` (integer refills > 0;
    non-numeric text counts as none)."""
    m = match_medication(orders, patients, pattern, names=names)
    refills = F.col("refills").cast("string").try_cast("int")
    return m.select(
        "mrn",
        as_date("order_start_date").alias("order_start"),
        as_date("order_end_date").alias("order_end"),
        F.coalesce(refills > 0, F.lit(False)).alias("has_refill"),
    )


def coverage_flags(
    patients: DataFrame,
    administered: DataFrame,
    orders: DataFrame,
    spec: MatrixSpec = FULL_SPEC,
    pattern: str = DEFAULT_DRUG_PATTERN,
    names: DataFrame | None = None,
) -> DataFrame:
    """C30d: every (mrn, bucket) with ``epic_med`` = administration or order
    coverage and ``refill`` = coverage by orders with refills, as Yes/No
    cells in long form (mrn, variable, time_bucket, cell)."""
    admin = point_coverage(admin_events(administered, patients, pattern, names), patients, spec).withColumns(
        {"__adm": F.lit(True), "__ord": F.lit(False), "__ref": F.lit(False)}
    )
    iv = interval_coverage(order_intervals(orders, patients, pattern, names), patients, spec, ["has_refill"])
    ordh = iv.select("mrn", "time_bucket", F.lit(False).alias("__adm"), F.lit(True).alias("__ord"), F.col("has_refill").alias("__ref"))
    hits = admin.unionByName(ordh).groupBy("mrn", "time_bucket").agg(
        F.bool_or("__adm").alias("admin_hit"), F.bool_or("__ord").alias("order_hit"), F.bool_or("__ref").alias("refill_hit")
    )
    grid = patients.select("mrn", F.explode(F.sequence(F.lit(spec.lo), F.lit(spec.hi), F.lit(spec.width))).alias("time_bucket"))
    g = grid.join(hits, ["mrn", "time_bucket"], "left")
    yes_no = lambda c: F.when(c, F.lit("Yes")).otherwise(F.lit("No"))
    cells = g.select(
        "mrn",
        "time_bucket",
        F.array(
            F.struct(F.lit("epic_med").alias("variable"), yes_no(F.col("admin_hit") | F.col("order_hit")).alias("cell")),
            F.struct(F.lit("refill").alias("variable"), yes_no(F.col("refill_hit")).alias("cell")),
        ).alias("__v"),
    )
    return cells.select("mrn", "time_bucket", F.inline("__v")).select("mrn", "variable", "time_bucket", "cell")


def parallel_rows(
    m: LongMatrix,
    administered: DataFrame,
    orders: DataFrame,
    pattern: str = DEFAULT_DRUG_PATTERN,
    names: DataFrame | None = None,
) -> LongMatrix:
    """Symptom, medication and refill rows per patient (long form);
    ``wide_parallel`` adds each patient's ``note_author``."""
    flags = coverage_flags(m.patients, administered, orders, m.spec, pattern, names)
    return m.with_cells(m.cells.unionByName(flags))


def wide_parallel(m: LongMatrix, authors: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Wide parallel-row matrix: ``mrn, start, end, variable, note_author
    [, extra columns], <k>_months``; dates as strings."""
    from .matrix import to_wide

    w = to_wide(m, by_variable=True).join(authors, "mrn", "left")
    cols = [*META, "variable", "note_author"]
    if extra is not None:
        w = w.join(extra, "mrn", "left")
        cols += [c for c in extra.columns if c != "mrn"]
    return w.select(*cols, *m.spec.columns)
