"""Registered queries: one per operator, each over whole fixture views.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names match the SQL oracle. Some write intermediate tables first. Date and timestamp columns leave as
``yyyy-MM-dd`` text so both engines compare the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.segments import sentence_spans
from ..functions.status import format_status
from ..functions.text import clean_llm_json, contains_any
from ..operators import coverage as cov
from ..operators import extraction as ex
from ..operators import matrix as mx
from ..operators import notes as nt
from ..operators import requests as rq
from ..operators import rules as ru
from ..operators import shift as sh
from ..operators import validator as va
from ..operators import verdicts as vd
from ..operators.intervals import interval_join
from ..sources import fixtures as fx
from ..sources.sinks import materialize
from ..sources.tables import Tables
from ..spec import ENTRY_FIELDS, ENTRY_SCHEMA, FULL_SPEC, STAGE2_SPEC, BaselineSpec, MentionSpec
from . import stages

MENTION = MentionSpec(keywords=fx.FIXTURE_KEYWORDS, max_chars=fx.FIXTURE_MAX_CHARS)
BASELINE = BaselineSpec(max_chars=fx.FIXTURE_MAX_CHARS)
PATTERN = fx.FIXTURE_PATTERN


REPLY_COLUMNS = ("enrollment", "extracted_llm", "val_llm")


class FixtureInputs:
    """Study inputs as fixture views over the driver tables, each built on
    first use (a query only plans the views it reads)."""

    _VIEWS = {
        "cohort": fx.patients,
        "mapping": fx.mapping,
        "notes": fx.notes,
        "enrollment": fx.enrollment,
        "observations": fx.observations,
        "llm_outputs": fx.llm_outputs,
        "prior_outputs": fx.prior_outputs,
        "administered": fx.administered_meds,
        "orders": fx.order_meds,
        "providers": fx.providers,
        "drug_names": fx.drug_names,
    }

    def __init__(self, tables: Tables):
        self._t = tables
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._VIEWS:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._VIEWS[name](self._t)
        return self._built[name]


def inputs(spark: SparkSession, sf_dir: str) -> FixtureInputs:
    return FixtureInputs(Tables(spark, sf_dir))


def as_text_dates(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("date").cast("string").alias(f.name)
        out.append(c)
    return df.select(*out)


# --------------------------------------------------------------------------
# Stage 1 and 3: notes
# --------------------------------------------------------------------------


def q_cohort_resolve(i):
    return nt.resolve_cohort(i.cohort, i.mapping)


def q_mention_filter(i):
    return nt.mention_filter(i.notes, nt.resolve_cohort(i.cohort, i.mapping), MENTION.keywords, MENTION.floor)


def q_first_mention_anchor(i):
    return nt.with_first_mention(stages.stage1_mentions(i, MENTION))


def _cohort_notes_flagged(i):
    """All cohort notes after the floor, flagged 1/0 by keyword."""
    ids = nt.resolve_cohort(i.cohort, i.mapping)
    n = i.notes.filter(F.col("contact_date") >= F.lit(MENTION.floor).cast("date")).join(ids, "patient_id")
    flag = F.when(contains_any("note_text", MENTION.keywords), 1).otherwise(0)
    return n.withColumn("medication_mentioned", flag)


def q_anchor_lookback(i):
    flagged = _cohort_notes_flagged(i).select("patient_id", "note_id", "mrn", "contact_date", "medication_mentioned")
    flagged = materialize(flagged, "cohort_notes_flagged")
    a = nt.anchor_lookback(nt.with_first_mention(flagged), MENTION.lookback_months)
    return a.select(
        "patient_id", "note_id", "mrn", "contact_date", "medication_mentioned", "first_medication_mention_date", "medication_start_date"
    )


def q_dedup_rows(i):
    return nt.dedup_rows(i.notes.select("note_text", "note_type_ip"))


def q_chunk_text(i):
    return nt.chunk_text(i.notes, MENTION.max_chars)


def q_mention_notes(i):
    return stages.stage1_notes(i, MENTION)


def q_baseline_notes(i):
    return nt.baseline_notes(i.notes, i.enrollment, i.mapping, BASELINE.days, BASELINE.note_types, BASELINE.max_chars)


def q_date_envelope(i):
    return nt.date_envelope(nt.enrollment_windows(i.enrollment, i.mapping, BASELINE.days))


# --------------------------------------------------------------------------
# Stage 2: replies to verdicts
# --------------------------------------------------------------------------


def q_fenced_json_clean(i):
    r = i.llm_outputs
    return r.select(
        "note_id",
        clean_llm_json("enrollment").alias("enrollment_cleaned"),
        clean_llm_json("extracted_llm").alias("extractor_cleaned"),
        clean_llm_json("val_llm").alias("validator_cleaned"),
    )


def q_payload_parse(i):
    p = vd.parse_llm_outputs(i.llm_outputs)
    ext = vd.parse_payload("extracted_llm", ENTRY_SCHEMA)
    val = vd.parse_payload("val_llm", ENTRY_SCHEMA)
    return p.select(
        "note_id",
        "enroll_confirmed_start",
        "enroll_confirmed_start_date",
        "enroll_confirmed_end",
        "enroll_confirmed_end_date",
        "enroll_status",
        "enroll_confidence",
        "enroll_start_date_parsed",
        "enroll_end_date_parsed",
        ext.isNotNull().alias("extractor_parsed"),
        F.coalesce(F.size(ext), F.lit(0)).alias("extractor_entries"),
        val.isNotNull().alias("validator_parsed"),
        F.coalesce(F.size(val), F.lit(0)).alias("validator_entries"),
    )


def q_pick_entry(i):
    r = i.llm_outputs
    e = vd.pick_entry(vd.parse_payload("extracted_llm", ENTRY_SCHEMA))
    v = vd.pick_entry(vd.parse_payload("val_llm", ENTRY_SCHEMA))
    return r.select(
        "note_id",
        e["phenotype"].alias("extractor_phenotype"),
        e["present"].alias("extractor_present_raw"),
        e["severity_level"].alias("extractor_severity"),
        e["time"].alias("extractor_time"),
        v["present"].alias("validator_present_raw"),
        v["severity_level"].alias("validator_severity"),
    )


def q_normalize_verdict(i):
    p = vd.parse_llm_outputs(i.llm_outputs)
    raw = vd.pick_entry(vd.parse_payload("extracted_llm", ENTRY_SCHEMA))["present"]
    return p.select("note_id", raw.alias("extractor_present_raw"), "extractor_present", "validator_present")


def _merged(i):
    """Parsed and merged replies, written: later filters on parsed columns
    read them instead of repeating the parse."""
    return materialize(vd.merge_verdicts(vd.parse_llm_outputs(i.llm_outputs)).drop(*REPLY_COLUMNS), "parsed_replies")


def q_verdict_merge(i):
    return _merged(i).select("note_id", "mrn", "extractor_present", "validator_present", "diarrhea_present", "severity_level")


def q_verdict_merge_audit(i):
    return vd.merge_audit(_merged(i))


def q_observation_date_strict(i):
    return vd.observation_date(_merged(i)).select("note_id", "mrn", "note_time")


def q_observation_date_fallback(i):
    return vd.observation_date(_merged(i), fallback="contact_date").select("note_id", "mrn", "note_time")


def _rollup(i):
    return vd.enrollment_rollup(vd.observation_date(_merged(i)))


def q_enrollment_rollup(i):
    return _rollup(i)


def q_enrollment_gate(i):
    return vd.enrollment_gate(_rollup(i))


def q_enrollment_audit(i):
    return vd.enrollment_audit(_rollup(i))


def q_treatment_window(i):
    return vd.in_treatment_window(i.observations).select("note_id", "mrn", "note_time")


def q_bucket_elapsed(i):
    b = mx.bucket_elapsed(i.observations, FULL_SPEC)
    return b.select("note_id", "mrn", "time_bucket", "time_bucket_label")


def _bucket_rollup(i):
    return mx.bucket_rollup(mx.bucket_elapsed(vd.in_treatment_window(i.observations), STAGE2_SPEC))


def q_bucket_rollup(i):
    return _bucket_rollup(i)


def q_status_format(i):
    r = _bucket_rollup(i)
    return r.select(
        "mrn",
        "time_bucket_label",
        format_status("diarrhea_status", "severity").alias("cell"),
        format_status("diarrhea_status", "severity", missing="No").alias("cell_missing_no"),
    )


def q_bucket_audit(i):
    return mx.bucket_audit(_bucket_rollup(i))


def q_symptom_matrix(i):
    return mx.to_wide(stages.stage2_long(i))


def q_llm_symptom_matrix(i):
    return mx.to_wide(stages.stage2_long(i, from_replies=True))


def q_matrix_summary(i):
    return mx.matrix_summary(mx.to_wide(stages.stage2_long(i)))


def q_matrix_with_summary(i):
    return stages.stage2_matrix(i)


def q_positive_rate(i):
    return mx.positive_rate(mx.to_wide(stages.stage2_long(i)))


# --------------------------------------------------------------------------
# Stage 4: prior events
# --------------------------------------------------------------------------


def _prior_events(i):
    return mx.prior_events(i.prior_outputs, i.mapping, stages.stage2_long(i).patients)


def q_bucket_pre_baseline(i):
    return _prior_events(i).select("note_id", "mrn", "time_bucket", "time_bucket_label", "diarrhea_present", "severity_level")


def q_prior_rollup(i):
    return mx.prior_rollup(_prior_events(i))


def q_matrix_extended(i):
    return stages.stage4_matrix(_stage4(i))


# --------------------------------------------------------------------------
# Stage 5: coverage, providers, parallel rows
# --------------------------------------------------------------------------


def _patients(i):
    return stages.stage2_long(i).patients


def _stage4(i, write=True):
    return stages.stage4_long(i, stages.stage2_long(i), write=write)


def _stage5(i):
    return stages.stage5_long(i, _stage4(i, write=False), PATTERN)


def _shifts(i):
    """Shifts need the refill rows only, not the other stages' cells."""
    return sh.detect_shift(cov.coverage_flags(_patients(i), i.administered, i.orders, FULL_SPEC, PATTERN, i.drug_names))


def q_provider_attribution(i):
    return cov.provider_names(i.providers, _patients(i), "No Provider Record")


def q_medication_match(i):
    return cov.match_medication(i.administered, _patients(i), PATTERN, names=i.drug_names)


def q_bucket_windows(i):
    return cov.bucket_windows(_patients(i), FULL_SPEC).select("mrn", "time_bucket", "time_bucket_label", "bucket_start", "bucket_end")


def q_point_coverage(i):
    p = _patients(i)
    return cov.point_coverage(cov.admin_events(i.administered, p, PATTERN, i.drug_names), p, FULL_SPEC)


def q_interval_coverage(i):
    p = _patients(i)
    return cov.interval_coverage(cov.order_intervals(i.orders, p, PATTERN, i.drug_names), p, FULL_SPEC).distinct()


def q_refill_coverage(i):
    p = _patients(i)
    o = cov.order_intervals(i.orders, p, PATTERN, i.drug_names).filter("has_refill")
    return cov.interval_coverage(o, p, FULL_SPEC).distinct()


def q_coverage_flags(i):
    return cov.coverage_flags(_patients(i), i.administered, i.orders, FULL_SPEC, PATTERN, i.drug_names)


def q_coverage_matrix(i):
    p = _patients(i)
    flags = cov.coverage_flags(p, i.administered, i.orders, FULL_SPEC, PATTERN, i.drug_names)
    w = flags.groupBy("mrn", "variable").pivot("time_bucket", FULL_SPEC.buckets).agg(F.first("cell"))
    return w.select("mrn", "variable", *[F.col(f"`{b}`").alias(f"{b}_months") for b in FULL_SPEC.buckets])


def q_parallel_rows(i):
    return stages.stage5_matrix(i, _stage5(i))


# --------------------------------------------------------------------------
# Stage 6: shift
# --------------------------------------------------------------------------


def q_shift_detect(i):
    return _shifts(i)


def q_matrix_shift(i):
    m = stages.stage6_long(_stage5(i))
    return cov.wide_parallel(m, stages.authors(i, m))


def q_start_date_correction(i):
    m = sh.shift_matrix(stages.stage2_long(i), _shifts(i))
    return m.patients.select("mrn", "enrollment_start_date", "correct_enrollment_date")


def q_corrected_matrix(i):
    return stages.stage6_matrix(i, stages.stage6_long(_stage5(i)))


def q_shift_audit(i):
    return sh.shift_audit(_shifts(i))


def q_study_final_matrix(i):
    """The whole chain from raw replies."""
    return stages.stage6_matrix(i, stages.run_study(i, PATTERN).stage6)


# --------------------------------------------------------------------------
# Instruction rules
# --------------------------------------------------------------------------


def q_passage_extract(i, t):
    c = fx.clinical_notes(t)
    return c.select("note_id", ex.passage("note_text").alias("passage"))


def q_passage_spans(i, t):
    c = fx.clinical_notes(t).select("note_id", F.inline(ex.passage_spans("note_text")))
    return c.withColumnRenamed("text", "passage")


def q_sentence_spans(i, t):
    c = fx.clinical_notes(t).select("note_id", F.inline(sentence_spans("note_text")))
    return c.withColumnRenamed("text", "sentence")


def q_response_contract(i):
    return ex.response_contract(i.llm_outputs)


def _quotes(t):
    """Quotes derived from clinical notes: the note's own first sentence
    shouted without punctuation (grounded) or another sentence."""
    c = fx.clinical_notes(t)
    doc = F.col("note_id").cast("long")
    n = len(fx.CLINICAL_PHRASES)
    own = F.upper(F.regexp_replace(fx._pick(doc % n, fx.CLINICAL_PHRASES), r"[.,;]", ""))
    other = fx._pick((doc + 5) % n, fx.CLINICAL_PHRASES)
    return c.select("note_id", F.when(doc % 2 == 0, own).otherwise(other).alias("evidence_text"))


def q_evidence_grounding(i, t):
    return ex.evidence_grounding(_quotes(t), fx.clinical_notes(t))


def q_evidence_spans(i, t):
    return ex.evidence_spans(_quotes(t), fx.clinical_notes(t))


def note_entries(t):
    """Five entries for each clinical note: its first phrase shouted, another
    phrase, the first again with another verdict word, the first denied, and
    its last phrase for another phenotype."""
    c = fx.clinical_notes(t)
    doc, n = F.col("note_id").cast("long"), len(fx.CLINICAL_PHRASES)
    phrase = lambda k: fx._pick(k % n, fx.CLINICAL_PHRASES)
    shouted = F.upper(F.regexp_replace(phrase(doc), r"[.,;]", ""))
    date = F.when(doc % 3 == 0, "2/15/24").when(doc % 3 == 1, "February 15, 2024")
    rows = [
        ("Diarrhea", F.lit("Yes"), "4", date, shouted),
        ("Diarrhea", F.lit("YES"), "N/A", F.when(doc % 2 == 1, "soon"), phrase(doc + 5)),
        ("Diarrhea", F.lit("true"), "4", date, shouted),
        ("Diarrhea", F.lit("No"), "4", date, shouted),
        ("Hand use", F.lit("Yes"), "low", F.lit(None), phrase(F.floor(doc / n))),
    ]
    entry = lambda r: F.struct(*(v.cast("string").alias(f) for f, v in zip(ENTRY_FIELDS, (F.lit(r[0]), r[1], F.lit(r[2]), r[3], r[4]), strict=True)))
    return c.select("note_id", F.array(*map(entry, rows)).alias("entries"))


def q_validated_entries(i, t):
    done = va.validate_entries(note_entries(t), fx.clinical_notes(t))
    said = lambda o: F.concat_ws(":", o["pos"].cast("string"), o["action"], F.array_join(o["reasons"], "+"))
    kept = lambda e: F.concat_ws("~", e["phenotype"], e["severity_level"], F.coalesce(e["time"], F.lit("-")), e["evidence_text"])
    return done.select("note_id", F.array_join(F.transform("outcomes", said), "|").alias("outcomes"), F.array_join(F.transform("validated", kept), "|").alias("validated"))


def _entries(i):
    """The entries of both replies, written once."""
    return materialize(vd.explode_entries(i.llm_outputs, ("extracted_llm", "val_llm"), ENTRY_SCHEMA), "reply_entries")


def q_positive_only(i):
    return ex.positive_only(_entries(i)).select("note_id", "pos", "phenotype", "present", "severity_level", "time")


def q_severity_rules(i, t):
    c = fx.clinical_notes(t)
    return c.select("note_id", ru.severity_level("note_text").alias("severity_level"))


def q_intensity_rules(i, t):
    c = fx.clinical_notes(t)
    return c.select("note_id", ru.intensity("note_text").alias("intensity"))


DATE_OUTPUT_FORMATS = ("M/d/yy", "M/d/yyyy", "MMMM d, yyyy", "MMM yyyy", "MMMM yyyy")


def q_date_normalize(i, t):
    o = t.orders
    k = F.col("o_orderkey")
    d = F.add_months(F.col("o_orderdate").cast("date"), fx.PAYLOAD_YEARS_AHEAD_MONTHS)
    raw = F.when(k % 5 == 0, F.date_format(d, DATE_OUTPUT_FORMATS[0]))
    for j, f in enumerate(DATE_OUTPUT_FORMATS[1:], start=1):
        raw = raw.when(k % 5 == j, F.date_format(d, f))
    x = o.select(F.col("o_orderkey").cast("string").alias("note_id"), raw.alias("raw"))
    return x.select("note_id", "raw", ex.normalize_date("raw").alias("normalized"))


def q_date_grounding(i, t):
    c = fx.clinical_notes(t)
    doc = F.col("note_id").cast("long")
    tm = F.when(doc % 4 == 0, "2/15/24").when(doc % 4 == 1, "12/5/23").when(doc % 4 == 2, "2/1/24")
    return c.select("note_id", tm.alias("time"), ex.grounded_date(tm, "note_text").alias("grounded_time"))


def q_entry_dedup(i):
    return ex.entry_dedup(_entries(i)).select("note_id", "pos", "phenotype", "present", "severity_level", "time")


def q_status_rules(i, t):
    c = fx.clinical_notes(t)
    return ru.enrollment_record(c).select(
        "note_id", "enrollment_status", "confirmed_start", "confirmed_start_date", "confirmed_end", "confirmed_end_date", "confidence", "evidence_text"
    )


def q_chronicity_rules(i, t):
    return ru.chronicity(fx.clinical_notes(t))


def q_enrollment_from_notes(i, t):
    return ru.enrollment_from_notes(fx.clinical_notes(t))


def q_chronic_entries(i, t):
    return ru.chronic_entries(fx.clinical_notes(t))


def q_relative_time(i, t):
    c = fx.clinical_notes(t)
    return c.select("note_id", ex.relative_time("note_text").alias("time_description"))


def q_llm_requests(i, t):
    chunks = nt.chunk_text(fx.clinical_notes(t), MENTION.max_chars)
    return rq.requests(chunks, fx.note_responses(chunks)).select("note_id", "stage", "request_text")


def q_request_ledger(i, t):
    """The ledger after some answers: those of every third note were given
    to an older instruction, and name no open request."""
    notes = fx.clinical_notes(t)
    given = fx.note_responses(notes)
    ledger = rq.request_ledger(notes, given)
    answers = ledger.join(given, ["note_id", "stage"])
    old = F.when(F.col("note_id").cast("long") % 3 == 0, F.lit("older")).otherwise(F.col("request_id"))
    answers = answers.select("note_id", "stage", old.alias("request_id"), "response")
    return rq.open_requests(ledger, answers).select("note_id", "stage", "request_id")


def q_interval_overlaps(i):
    """Each order's interval against the patient's spans of two
    administrations: free intervals, neither on a grid."""
    orders = materialize(i.orders.select("mrn", "order_start_date", "order_end_date", "refills").distinct(), "order_spans")
    given = i.administered.select("mrn", F.col("taken_time").cast("date").alias("given")).distinct()
    in_order = W.partitionBy("mrn").orderBy("given")
    stays = materialize(given.withColumn("until", F.lead("given").over(in_order)), "given_spans")
    pairs = interval_join(orders, stays, ["mrn"], ("order_start_date", "order_end_date"), ("given", "until"))
    days = F.date_diff("overlap_end", "overlap_start") + 1
    return pairs.groupBy("mrn").agg(F.count("*").alias("pairs"), F.sum(days).alias("days"), F.count_if(F.col("overlap_end").isNull()).alias("open_pairs"), F.min("overlap_start").alias("first_overlap"))


def q_llm_responses(i, t):
    chunks = nt.chunk_text(fx.clinical_notes(t), MENTION.max_chars)
    return rq.attach_responses(chunks, fx.note_responses(chunks))


def q_annotation_agreement(i):
    m = stages.stage2_long(i)
    b = mx.bucket_elapsed(vd.in_treatment_window(i.observations), STAGE2_SPEC)
    ann = b.groupBy("mrn", "time_bucket").agg(
        F.max(F.when(F.col("severity_level") == "1", "Yes").otherwise("No")).alias("annotation")
    ).withColumn("variable", F.lit("diarrhea"))
    return rq.agreement(m.cells, ann)


_WITH_TABLES = {
    "passage_extract": q_passage_extract,
    "passage_spans": q_passage_spans,
    "sentence_spans": q_sentence_spans,
    "evidence_spans": q_evidence_spans,
    "validated_entries": q_validated_entries,
    "enrollment_from_notes": q_enrollment_from_notes,
    "chronic_entries": q_chronic_entries,
    "evidence_grounding": q_evidence_grounding,
    "severity_rules": q_severity_rules,
    "intensity_rules": q_intensity_rules,
    "date_normalize": q_date_normalize,
    "date_grounding": q_date_grounding,
    "status_rules": q_status_rules,
    "chronicity_rules": q_chronicity_rules,
    "relative_time": q_relative_time,
    "llm_requests": q_llm_requests,
    "llm_responses": q_llm_responses,
    "request_ledger": q_request_ledger,
}

_PLAIN = {
    "cohort_resolve": q_cohort_resolve,
    "mention_filter": q_mention_filter,
    "first_mention_anchor": q_first_mention_anchor,
    "anchor_lookback": q_anchor_lookback,
    "dedup_rows": q_dedup_rows,
    "chunk_text": q_chunk_text,
    "mention_notes": q_mention_notes,
    "fenced_json_clean": q_fenced_json_clean,
    "payload_parse": q_payload_parse,
    "pick_entry": q_pick_entry,
    "normalize_verdict": q_normalize_verdict,
    "verdict_merge": q_verdict_merge,
    "verdict_merge_audit": q_verdict_merge_audit,
    "observation_date_strict": q_observation_date_strict,
    "observation_date_fallback": q_observation_date_fallback,
    "enrollment_rollup": q_enrollment_rollup,
    "enrollment_gate": q_enrollment_gate,
    "enrollment_audit": q_enrollment_audit,
    "treatment_window": q_treatment_window,
    "bucket_elapsed": q_bucket_elapsed,
    "bucket_rollup": q_bucket_rollup,
    "status_format": q_status_format,
    "bucket_audit": q_bucket_audit,
    "symptom_matrix": q_symptom_matrix,
    "llm_symptom_matrix": q_llm_symptom_matrix,
    "matrix_summary": q_matrix_summary,
    "matrix_with_summary": q_matrix_with_summary,
    "positive_rate": q_positive_rate,
    "baseline_notes": q_baseline_notes,
    "date_envelope": q_date_envelope,
    "bucket_pre_baseline": q_bucket_pre_baseline,
    "prior_rollup": q_prior_rollup,
    "matrix_extended": q_matrix_extended,
    "provider_attribution": q_provider_attribution,
    "medication_match": q_medication_match,
    "bucket_windows": q_bucket_windows,
    "point_coverage": q_point_coverage,
    "interval_coverage": q_interval_coverage,
    "refill_coverage": q_refill_coverage,
    "interval_overlaps": q_interval_overlaps,
    "coverage_flags": q_coverage_flags,
    "coverage_matrix": q_coverage_matrix,
    "parallel_rows": q_parallel_rows,
    "shift_detect": q_shift_detect,
    "matrix_shift": q_matrix_shift,
    "start_date_correction": q_start_date_correction,
    "corrected_matrix": q_corrected_matrix,
    "shift_audit": q_shift_audit,
    "study_final_matrix": q_study_final_matrix,
    "response_contract": q_response_contract,
    "positive_only": q_positive_only,
    "entry_dedup": q_entry_dedup,
    "annotation_agreement": q_annotation_agreement,
}


def _make(fn, with_tables: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        i = inputs(spark, sf_dir)
        df = fn(i, Tables(spark, sf_dir)) if with_tables else fn(i)
        return as_text_dates(df)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: _make(f, False) for k, f in _PLAIN.items()}
    out.update({k: _make(f, True) for k, f in _WITH_TABLES.items()})
    return out
