"""Parameters, fixed vocabularies and payload schemas.

Everything a study might change (bucket width and range, keywords, name
pattern, verdict words, lookback) is a field of a small frozen dataclass
rather than a module constant, so the same operators run on any cohort.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# Verdict words (compared after trim + lower).
YES_WORDS = ("yes", "true", "present", "positive", "1")
NO_WORDS = ("no", "false", "absent", "negative", "0", "none", "n/a")

# Enrollment statuses that make a patient ineligible.
INELIGIBLE_STATUSES = ("deceased_or_ineligible",)

# Default drug-name pattern for medication tables.
DEFAULT_DRUG_PATTERN = r"(?i)(daybue|trofinetide|trofine|trofi\s*netide)"

# Default mention keywords for notes (lower-case substring match).
DEFAULT_KEYWORDS = ("daybue", "trofinetide")

# Default earliest note date of stage 1.
DEFAULT_NOTE_FLOOR = "2022-09-01"

# Note types read for the baseline (pre-enrollment) lookback.
BASELINE_NOTE_TYPES = ("Progress Notes", "Telephone Encounter", "H&P", "Letter")

# Chunk limit used by the reference code.
DEFAULT_MAX_CHARS = 600_000

# Markdown fence opener and the lazy body pattern of a fenced JSON reply.
JSON_FENCE = "```json"
JSON_FENCE_BODY = r"```json\s*([\s\S]*?)\s*```"

# Cell texts.
SUMMARY_MRN = "SUMMARY"
NO_PROVIDER = "No Provider Record"
NO_PASSAGE = "No Daybue-related information found"
DATE_FMT = "M/d/yy"

# ---------------------------------------------------------------------------
# Payload schemas (JSON text written by the extraction model).
# ---------------------------------------------------------------------------

ENROLLMENT_SCHEMA = T.StructType(
    [
        T.StructField("confirmed_start", T.BooleanType()),
        T.StructField("confirmed_start_date", T.StringType()),
        T.StructField("confirmed_end", T.BooleanType()),
        T.StructField("confirmed_end_date", T.StringType()),
        T.StructField("enrollment_status_this_note", T.StringType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("evidence_text", T.StringType()),
    ]
)

ENTRY_FIELDS = ("phenotype", "present", "severity_level", "time", "evidence_text")
ENTRY_SCHEMA = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in ENTRY_FIELDS]))

PRIOR_FIELDS = (
    "phenotype",
    "present",
    "chronicity_indicator",
    "severity_level",
    "time",
    "time_description",
    "evidence_text",
)
PRIOR_SCHEMA = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in PRIOR_FIELDS]))


@dataclass(frozen=True)
class MatrixSpec:
    """Time axis of a patient x bucket matrix.

    ``width`` months per bucket; buckets ``lo, lo+width, ..., hi``;
    ``cutoff`` is the last bucket a shifted patient may keep.
    """

    width: int = 6
    lo: int = -6
    hi: int = 36
    cutoff: int = 30

    @property
    def buckets(self) -> list[int]:
        return list(range(self.lo, self.hi + 1, self.width))

    @property
    def columns(self) -> list[str]:
        return [bucket_label(b) for b in self.buckets]

    @property
    def pre_baseline(self) -> list[int]:
        """Buckets before the start."""
        return [b for b in self.buckets if b < 0]

    def with_range(self, lo: int | None = None, hi: int | None = None) -> MatrixSpec:
        return MatrixSpec(self.width, self.lo if lo is None else lo, self.hi if hi is None else hi, self.cutoff)


# Stage 2 of the reference buckets -6..36; the completed matrix spans -12..36.
STAGE2_SPEC = MatrixSpec(6, -6, 36, 30)
FULL_SPEC = MatrixSpec(6, -12, 36, 30)


def bucket_label(k: int) -> str:
    return f"{k}_months"


def label_to_bucket(name: str) -> int:
    return int(name[: -len("_months")])


def time_columns(columns: list[str]) -> list[str]:
    """Bucket columns of a wide matrix, in numeric order."""
    return sorted((c for c in columns if c.endswith("_months")), key=label_to_bucket)


@dataclass(frozen=True)
class MentionSpec:
    keywords: tuple[str, ...] = DEFAULT_KEYWORDS
    floor: str = DEFAULT_NOTE_FLOOR
    lookback_months: int = 6
    max_chars: int = DEFAULT_MAX_CHARS


@dataclass(frozen=True)
class BaselineSpec:
    days: int = 365
    note_types: tuple[str, ...] = BASELINE_NOTE_TYPES
    max_chars: int = DEFAULT_MAX_CHARS
