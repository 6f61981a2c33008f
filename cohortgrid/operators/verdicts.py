"""Model replies to dated verdicts, and the enrollment gate.

Parsing uses ``from_json`` with fixed schemas (malformed text -> null),
``get`` instead of ``[0]`` and ``try_to_date`` so that ANSI mode stays on
and nothing raises on a normal but empty reply (D3).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.dates import parse_model_date
from ..functions.status import merged_severity, merged_verdict
from ..functions.text import clean_llm_json, normalize_verdict
from ..spec import ENROLLMENT_SCHEMA, ENTRY_SCHEMA, INELIGIBLE_STATUSES


def parse_payload(c: str | Column, schema: DataType) -> Column:
    """fenced/bare JSON text to a typed value; malformed -> null."""
    return F.from_json(clean_llm_json(c), schema)


def pick_entry(arr: str | Column, phenotype: str = "Diarrhea", match: str = "exact") -> Column:
    """First entry whose phenotype equals ``phenotype`` (``exact``) or
    contains it in any case (``contains``); null when none."""
    a = F.col(arr) if isinstance(arr, str) else arr
    if match == "exact":
        hit = F.filter(a, lambda x: x["phenotype"] == phenotype)
    else:
        pat = f"%{phenotype.lower()}%"
        hit = F.filter(a, lambda x: F.lower(x["phenotype"]).like(pat))
    return F.get(hit, 0)


def explode_entries(replies: DataFrame, cols: Iterable[str], schema: DataType, id_col: str = "note_id") -> DataFrame:
    """C9, all entries instead of the first: (id, pos, the entry's fields),
    numbered through the reply columns in their order. A reply that is missing
    or can't be parsed has none and leaves the others."""
    none = F.array().cast(schema)
    lists = [F.coalesce(parse_payload(c, schema), none) for c in cols]
    return replies.select(id_col, F.posexplode(F.concat(*lists)).alias("pos", "e")).select(id_col, "pos", "e.*")


def parse_llm_outputs(raw: DataFrame, phenotype: str = "Diarrhea") -> DataFrame:
    """C7-C10 on the three reply columns: enrollment fields, and extractor /
    validator present, severity and time of the picked entry."""
    enr = parse_payload("enrollment", ENROLLMENT_SCHEMA)
    ext = pick_entry(parse_payload("extracted_llm", ENTRY_SCHEMA), phenotype)
    val = pick_entry(parse_payload("val_llm", ENTRY_SCHEMA), phenotype)
    df = raw.withColumns({"__enr": enr, "__ext": ext, "__val": val})
    df = df.withColumns(
        {
            "enroll_confirmed_start": F.col("__enr.confirmed_start"),
            "enroll_confirmed_start_date": F.col("__enr.confirmed_start_date"),
            "enroll_confirmed_end": F.col("__enr.confirmed_end"),
            "enroll_confirmed_end_date": F.col("__enr.confirmed_end_date"),
            "enroll_status": F.col("__enr.enrollment_status_this_note"),
            "enroll_confidence": F.col("__enr.confidence"),
            "enroll_start_date_parsed": F.try_to_date(F.col("__enr.confirmed_start_date"), "M/d/yy"),
            "enroll_end_date_parsed": F.try_to_date(F.col("__enr.confirmed_end_date"), "M/d/yy"),
            "extractor_present": normalize_verdict(F.col("__ext.present")),
            "extractor_severity": F.col("__ext.severity_level"),
            "extractor_time": F.col("__ext.time"),
            "extractor_evidence": F.col("__ext.evidence_text"),
            "validator_present": normalize_verdict(F.col("__val.present")),
            "validator_severity": F.col("__val.severity_level"),
        }
    )
    return df.drop("__enr", "__ext", "__val")


def merge_verdicts(df: DataFrame) -> DataFrame:
    """C11: one verdict and severity per note from the two sources."""
    return df.withColumns(
        {
            "diarrhea_present": merged_verdict("extractor_present", "validator_present"),
            "severity_level": merged_severity("validator_present", "validator_severity", "extractor_severity"),
        }
    )


def merge_audit(merged: DataFrame) -> DataFrame:
    """C11 audit: rows per (extractor, validator, merged) verdict, sorted
    (O2); the rows are as few as the verdicts."""
    verdicts = ["extractor_present", "validator_present", "diarrhea_present"]
    return merged.groupBy(*verdicts).agg(F.count(F.lit(1)).alias("n")).orderBy(*verdicts)


def observation_date(df: DataFrame, time_col: str = "extractor_time", fallback: str | None = None) -> DataFrame:
    """``note_time`` from the model's M/d/yy date. Strict (no
    fallback) drops undated rows; with ``fallback`` the contact date fills in."""
    t = parse_model_date(time_col)
    if fallback is not None:
        return df.withColumn("note_time", F.coalesce(t, F.col(fallback).cast("date")))
    return df.withColumn("note_time", t).filter(F.col("note_time").isNotNull())


def enrollment_rollup(df: DataFrame, ineligible: Iterable[str] = INELIGIBLE_STATUSES) -> DataFrame:
    """C14: per mrn any confirmed start, any ineligible status, earliest
    confirmed start date, latest confirmed end date, and ``enrolled``."""
    started = F.col("enroll_confirmed_start")
    return (
        df.groupBy("mrn")
        .agg(
            F.bool_or(started).alias("any_confirmed_start"),
            F.bool_or(F.coalesce(F.col("enroll_status").isin(list(ineligible)), F.lit(False))).alias(
                "any_ineligible"
            ),
            F.min(F.when(started, F.col("enroll_start_date_parsed"))).alias("enrollment_start_date"),
            F.max(F.when(F.col("enroll_confirmed_end"), F.col("enroll_end_date_parsed"))).alias(
                "enrollment_end_date"
            ),
        )
        .withColumn("enrolled", F.col("any_confirmed_start") & ~F.col("any_ineligible"))
    )


def enrollment_gate(rollup: DataFrame) -> DataFrame:
    """C14: enrolled patients with a start date -> (mrn, start, end)."""
    return rollup.filter(F.col("enrolled") & F.col("enrollment_start_date").isNotNull()).select(
        "mrn", "enrollment_start_date", "enrollment_end_date"
    )


def enrollment_audit(rollup: DataFrame) -> DataFrame:
    """C14 audit: total / enrolled / dropped patients in one aggregate."""
    return rollup.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce(F.col("enrolled"), F.lit(False))).alias("enrolled")
    ).withColumn("dropped", F.col("total") - F.col("enrolled"))


def in_treatment_window(df: DataFrame, t: str = "note_time") -> DataFrame:
    """Start <= t and (no end or t <= end)."""
    end = F.col("enrollment_end_date")
    return df.filter(
        F.col(t).isNotNull()
        & (F.col(t) >= F.col("enrollment_start_date"))
        & (end.isNull() | (F.col(t) <= end))
    )
