"""The six stages end to end, each a function of the stage before it.

Stage outputs are wide matrices with summary rows; between stages the long
form is passed, so later stages never re-discover columns or strip summary
rows. Building a stage runs jobs: its parsed replies, roll-up or cells are
written once under the checkpoint folder, and what follows scans those.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.coverage import parallel_rows, provider_names, wide_parallel
from ..operators.matrix import LongMatrix, extend_matrix, present_matrix, to_wide
from ..operators.notes import (
    anchor_lookback,
    baseline_notes,
    chunk_text,
    dedup_rows,
    mention_filter,
    resolve_cohort,
    with_first_mention,
    with_position,
)
from ..operators.shift import detect_shift, shift_matrix
from ..operators.matrix import bucket_elapsed, bucket_rollup, rollup_to_long
from ..operators.verdicts import (
    enrollment_gate,
    enrollment_rollup,
    in_treatment_window,
    merge_verdicts,
    parse_llm_outputs,
)
from ..functions.dates import parse_model_date
from ..sources.sinks import materialize, write_stage
from ..spec import FULL_SPEC, NO_PROVIDER, STAGE2_SPEC, BaselineSpec, MatrixSpec, MentionSpec

# Columns of parsed replies that the later steps read (no long texts).
DATED_COLUMNS = (
    "note_id",
    "mrn",
    "note_time",
    "diarrhea_present",
    "severity_level",
    "enroll_confirmed_start",
    "enroll_status",
    "enroll_start_date_parsed",
    "enroll_confirmed_end",
    "enroll_end_date_parsed",
)


@dataclass(frozen=True)
class StudyInputs:
    cohort: DataFrame
    mapping: DataFrame
    notes: DataFrame
    enrollment: DataFrame
    observations: DataFrame
    llm_outputs: DataFrame
    prior_outputs: DataFrame
    administered: DataFrame
    orders: DataFrame
    providers: DataFrame
    drug_names: DataFrame | None = None


def stage1_mentions(i: StudyInputs, m: MentionSpec = MentionSpec()) -> DataFrame:
    """Cohort notes mentioning a keyword, written once: the per-patient
    anchor and the rows it is joined back to then read this small table
    instead of scanning and substring-matching every note twice."""
    ids = resolve_cohort(i.cohort, i.mapping)
    return materialize(mention_filter(i.notes, ids, m.keywords, m.floor), "stage1_mentions")


def stage1_notes(i: StudyInputs, m: MentionSpec = MentionSpec()) -> DataFrame:
    """Stage 1: mentions -> first-mention anchor -> lookback -> dedup -> chunks."""
    # The written mentions' positions, taken before a join hides them.
    anchored = anchor_lookback(with_first_mention(with_position(stage1_mentions(i, m))), m.lookback_months)
    return chunk_text(dedup_rows(anchored), m.max_chars)


def reply_observations(replies: DataFrame, rollup_before_date_filter: bool = False) -> DataFrame:
    """Stage 2 front half: parse, merge, date the replies, then the
    enrollment roll-up and gate joined back. The parsed projection is
    written once so the JSON is parsed once, not once per join side.
    By default undated replies are dropped before the roll-up, as in the
    reference (D2); the option lets start dates stated only in undated
    replies count."""
    parsed = merge_verdicts(parse_llm_outputs(replies)).withColumn("note_time", parse_model_date("extractor_time"))
    dated = F.col("note_time").isNotNull()
    if rollup_before_date_filter:
        rows = materialize(parsed.select(*DATED_COLUMNS), "stage2_parsed")
        return rows.filter(dated).join(enrollment_gate(enrollment_rollup(rows)), "mrn")
    rows = materialize(parsed.filter(dated).select(*DATED_COLUMNS), "stage2_dated")
    return rows.join(enrollment_gate(enrollment_rollup(rows)), "mrn")


def stage2_long(
    i: StudyInputs, spec: MatrixSpec = STAGE2_SPEC, from_replies: bool = False, rollup_before_date_filter: bool = False
) -> LongMatrix:
    """Symptom matrix (long) from parsed observations, or from raw replies.
    The per (patient, bucket) roll-up is the stage output: written once,
    then patients and cells are projections of it."""
    obs = reply_observations(i.llm_outputs, rollup_before_date_filter) if from_replies else i.observations
    rollup = bucket_rollup(bucket_elapsed(in_treatment_window(obs), spec))
    return rollup_to_long(materialize(rollup, "stage2_rollup"), spec)


def stage2_matrix(i: StudyInputs, spec: MatrixSpec = STAGE2_SPEC, from_replies: bool = False) -> DataFrame:
    return stage4_matrix(stage2_long(i, spec, from_replies))


def stage3_notes(i: StudyInputs, m: LongMatrix, b: BaselineSpec = BaselineSpec()) -> DataFrame:
    """Notes before the starts that the matrix ``m`` has."""
    return baseline_notes(i.notes, m.patients, i.mapping, b.days, b.note_types, b.max_chars)


def stage4_long(i: StudyInputs, m: LongMatrix, spec: MatrixSpec = FULL_SPEC, write: bool = True) -> LongMatrix:
    """The extended matrix; its cells are written unless only one plan
    (stage 5) goes on from them."""
    out = extend_matrix(m, i.prior_outputs, i.mapping, spec)
    return out.with_cells(materialize(out.cells, "stage4_cells")) if write else out


def stage4_matrix(m: LongMatrix) -> DataFrame:
    return present_matrix(to_wide(m), cells=m)


def stage5_long(i: StudyInputs, m: LongMatrix, pattern: str) -> LongMatrix:
    out = parallel_rows(m, i.administered, i.orders, pattern, i.drug_names)
    return out.with_cells(materialize(out.cells, "stage5_cells"))


def authors(i: StudyInputs, m: LongMatrix) -> DataFrame:
    return provider_names(i.providers, m.patients, NO_PROVIDER)


def stage5_matrix(i: StudyInputs, m: LongMatrix) -> DataFrame:
    return present_matrix(wide_parallel(m, authors(i, m)), by="variable", cells=m)


def stage6_long(m: LongMatrix) -> LongMatrix:
    return shift_matrix(m, detect_shift(m.cells, spec=m.spec))


def stage6_matrix(i: StudyInputs, m: LongMatrix) -> DataFrame:
    corr = m.patients.select("mrn", F.col("correct_enrollment_date").cast("string").alias("correct_enrollment_date"))
    return present_matrix(wide_parallel(m, authors(i, m), extra=corr), by="variable", cells=m)


@dataclass(frozen=True)
class Study:
    """The long matrices of stages 2, 4, 5 and 6, each built on the one
    before; stage 2 is from the raw replies unless told otherwise."""

    stage2: LongMatrix
    stage4: LongMatrix
    stage5: LongMatrix
    stage6: LongMatrix


def run_study(i: StudyInputs, pattern: str, from_replies: bool = True) -> Study:
    m2 = stage2_long(i, from_replies=from_replies)
    m4 = stage4_long(i, m2)
    m5 = stage5_long(i, m4, pattern)
    return Study(m2, m4, m5, stage6_long(m5))


STAGE_OUTPUTS = (
    "stage1_notes",
    "stage2_matrix",
    "stage3_notes",
    "stage4_matrix",
    "stage5_matrix",
    "stage6_matrix",
)


def write_study(
    i: StudyInputs,
    out_dir: str,
    pattern: str,
    mention: MentionSpec = MentionSpec(),
    baseline: BaselineSpec = BaselineSpec(),
) -> dict[str, str]:
    """Run the six stages and publish each output as a new version of its
    own path under ``out_dir`` (S2/S3); returns the versions' folders."""
    study = run_study(i, pattern)
    outputs = {
        "stage1_notes": stage1_notes(i, mention),
        "stage2_matrix": stage4_matrix(study.stage2),
        "stage3_notes": stage3_notes(i, study.stage2, baseline),
        "stage4_matrix": stage4_matrix(study.stage4),
        "stage5_matrix": stage5_matrix(i, study.stage5),
        "stage6_matrix": stage6_matrix(i, study.stage6),
    }
    paths = {}
    for name in STAGE_OUTPUTS:
        paths[name] = write_stage(outputs[name], f"{out_dir.rstrip('/')}/{name}")
    return paths
