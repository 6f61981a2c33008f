"""Word rules standing in for model judgments (severity, intensity,
enrollment status, chronicity).

These are approximations of what the extraction instructions ask a
language model to judge; they are deterministic, documented, and run as
built-in ``rlike``/``when`` expressions (no rule-table join, no UDF).
Patterns are parameters; the defaults restate the instruction text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.segments import SPAN_TYPE, let, sentence_spans, sentences
from ..functions.text import contains_any
from ..sources.sinks import materialize
from ..spec import DEFAULT_KEYWORDS
from .assertions import PLANNED, has_event, scoped_events
from .extraction import DATE_MENTION_PATTERN, normalize_date, relative_time
from .verdicts import enrollment_rollup

# ---------------------------------------------------------------------------
# Fixed values restating the instruction text.
# ---------------------------------------------------------------------------

# Severity levels of the target phenotype, highest first.
SEVERITY_RULES = (
    ("4", r"(?i)watery.*outside (of )?(the )?clothes"),
    ("3", r"(?i)watery.*\bon (the )?clothes"),
    ("2", r"(?i)watery.*diaper"),
    ("1", r"(?i)loose.*diaper"),
)

# Improvement intensity, highest first.
INTENSITY_RULES = (
    ("high", r"(?i)\b(much better|significantly|dramatically|great improvement)\b"),
    ("moderate", r"(?i)\b(improved|better|noticeable|more than before)\b"),
    ("low", r"(?i)\b(slight|slightly|a little|minimal|somewhat)\b"),
)

# What a sentence that names the drug may say, as trigger phrases of
# ``assertions`` (matched in any case, as whole words).
DRUG = r"(?:daybue|trofinetide)"
ENROLLMENT_EVENTS = {
    "stop": (r"discontinued", r"stopped", r"ceased", r"quit", r"no longer (?:on|taking|takes|receiving|using)", r"(?:came|weaned|taken) off"),
    "onset": (r"started", r"starting", r"began", r"begun", r"initiated", r"resumed", r"restarted", r"commenced"),
    "ongoing": (
        rf"on (?:(?:the|her|his|their|daily) )?{DRUG}", r"taking", r"takes", r"took", r"tolerat(?:es|ed|ing)", r"receiv(?:es|ing)",
        r"continu(?:e|es|ed|ing)", r"dose (?:was )?(?:increased|decreased|reduced)", r"titrat(?:e|es|ed|ing|ion)",
    ),
    "refusal": (r"denied", r"denial", r"rejected", r"not covered"),
}
#: Without evidence of a start, these speak of a plan.
INTENT_PATTERN = r"(?i)\b(start|begin|discuss(ed|ing|ion)?)\b"
# Phrases of any sentence.
INELIGIBLE_EVENTS = {"gone": (r"passed away", r"died", r"deceased", r"terminally ill", r"prolonged hospitalization", r"palliative care", r"hospice")}

# Chronic / recurrent qualification, in a sentence that names the phenotype.
MENTION_PATTERN = r"(?i)(diarrh|loose stool|watery stool)"
MENTION_EVENTS = {"mention": (r"diarrh\p{L}*", r"loose stools?", r"watery stools?")}
CHRONIC_INCLUDE = (
    r"(?i)(chronic|persistent|ongoing|recurrent|continued|long-standing|longstanding"
    r"|for several (days|weeks|months)|for the (past|last) \d+ (weeks?|months?|years?)"
    r"|problem list|malabsorption|\bibd\b|celiac|workup)"
)
CHRONIC_EXCLUDE = r"(?i)(one episode|single episode|resolved same day)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_date(text: Column) -> Column:
    """The first date written in a text, as M/d/yy; null without one."""
    mention = F.regexp_extract(text, DATE_MENTION_PATTERN, 0)
    return F.when(mention != "", normalize_date(mention))


def _first_rule(text: Column, rules: Iterable[tuple[str, str]], default: str | None) -> Column:
    rules = list(rules)
    out = F.when(text.rlike(rules[0][1]), F.lit(rules[0][0]))
    for label, pat in rules[1:]:
        out = out.when(text.rlike(pat), F.lit(label))
    return out.otherwise(F.lit(default) if default is not None else F.lit(None).cast("string"))


def severity_level(evidence: str | Column, phenotype: str | Column | None = None, target: str = "diarrhea") -> Column:
    """The highest level 1-4 whose words stand in one sentence of the
    evidence, else "N/A"; other phenotypes N/A."""

    def highest(parts: Column) -> Column:
        level = F.lit("N/A")
        for name, pattern in reversed(SEVERITY_RULES):
            level = F.when(F.exists(parts, lambda s: s.rlike(pattern)), F.lit(name)).otherwise(level)
        return level

    level = let(sentences(evidence), highest)
    if phenotype is None:
        return level
    return F.when(F.lower(_c(phenotype)).contains(target), level).otherwise(F.lit("N/A"))


def intensity(evidence: str | Column) -> Column:
    """Low / moderate / high improvement language; highest wins; N/A."""
    return _first_rule(_c(evidence), INTENSITY_RULES, "N/A")


def enrollment_record(df: DataFrame, text_col: str = "note_text", keywords: Iterable[str] = DEFAULT_KEYWORDS) -> DataFrame:
    """A note's enrollment record, from what its sentences that name
    the drug assert (``assertions``). Columns added: ``enrollment_status``,
    the two independent flags, the dates of the start and of the end (M/d/yy),
    the ``confidence`` (high with a date or an ineligible patient, medium for
    a start or end without one, else low) and the ``evidence_text`` (the
    sentence that decided, verbatim).

    Only what is stated about the patient counts: a start that is negated,
    planned or held off is a plan; one of a relative is nothing. An end that
    is negated says that the drug is taken. An ineligible patient outranks
    everything, also in a note that does not name the drug."""
    words = [k.lower() for k in keywords]
    text = F.col(text_col)
    gone_word = "(?i)" + "|".join(INELIGIBLE_EVENTS["gone"])
    to_read = F.when(contains_any(text, words) | text.rlike(gone_word), sentences(text))
    df = df.withColumn("__all", F.coalesce(to_read, F.array().cast("array<string>")))

    def read(s: Column) -> Column:
        return F.struct(s.alias("text"), scoped_events(s, ENROLLMENT_EVENTS, dated=("onset", "stop")).alias("events"))

    gone = F.filter("__all", lambda s: s.rlike(gone_word) & has_event(scoped_events(s, INELIGIBLE_EVENTS), ["gone"]))
    df = df.withColumns({"__drug": F.transform(F.filter("__all", lambda s: contains_any(s, words)), read), "__gone": F.get(gone, 0)})

    def first(said: Callable[[Column], Column]) -> Column:
        return F.get(F.filter("__drug", said), 0)["text"]

    def date_of(names: list[str]) -> Column:
        stated = F.flatten(F.transform("__drug", lambda s: F.filter(s["events"], lambda e: e["event"].isin(names) & e["scope"].isNull() & e["date"].isNotNull())))
        return F.get(stated, 0)["date"]

    taken, aside = ["onset", "ongoing"], ["negated", "planned"]
    found = {
        "__start": first(lambda s: has_event(s["events"], taken) | has_event(s["events"], ["stop"], ["negated"])),
        "__end": first(lambda s: has_event(s["events"], ["stop"])),
        "__denied": first(lambda s: has_event(s["events"], ["refusal"])),
        "__planned": first(lambda s: has_event(s["events"], taken, aside) | s["text"].rlike(INTENT_PATTERN) | s["text"].rlike(rf"(?i)\b(?:{'|'.join(PLANNED)})\b")),
    }
    df = df.withColumns(found)
    columns = ["__gone", *found]
    labels = ("deceased_or_ineligible", "confirmed_start", "confirmed_end", "denied", "planned_only")
    status = F.when(F.col("__gone").isNotNull(), labels[0])
    for column, label in zip(columns[1:], labels[1:], strict=True):
        status = status.when(F.col(column).isNotNull(), label)
    status = status.when(F.size("__drug") > 0, "ambiguous").otherwise("no_mention")
    df = df.withColumns(
        {
            "enrollment_status": status,
            "confirmed_start": F.col("__start").isNotNull(),
            "confirmed_start_date": date_of(taken),
            "confirmed_end": F.col("__end").isNotNull(),
            "confirmed_end_date": date_of(["stop"]),
            "evidence_text": F.coalesce(*columns, F.get("__drug", 0)["text"]),
        }
    )
    dated = F.col("confirmed_start_date").isNotNull() | F.col("confirmed_end_date").isNotNull()
    sure = F.when(F.col("__gone").isNotNull() | dated, "high").when(F.col("confirmed_start") | F.col("confirmed_end"), "medium")
    return df.withColumn("confidence", sure.otherwise("low")).drop("__all", "__drug", *columns)


def enrollment_from_notes(notes: DataFrame, patient_col: str = "patient_id", text_col: str = "note_text") -> DataFrame:
    """C14's roll-up over the notes' own records: per patient (as ``mrn``)
    the flags and dates that ``verdicts.enrollment_gate`` reads."""
    r = enrollment_record(notes, text_col)
    as_reply = r.select(
        F.col(patient_col).alias("mrn"),
        F.col("confirmed_start").alias("enroll_confirmed_start"),
        F.col("confirmed_end").alias("enroll_confirmed_end"),
        F.col("enrollment_status").alias("enroll_status"),
        *(F.try_to_date(f"confirmed_{k}_date", "M/d/yy").alias(f"enroll_{k}_date_parsed") for k in ("start", "end")),
    )
    return enrollment_rollup(as_reply)


def mentions(text: Column) -> Column:
    """The sentences that state the phenotype of the patient: (start, end,
    text) spans. Negated, hypothetical and other people's mentions, isolated
    episodes and warnings do not count; a text without one of the words is
    not cut into sentences."""

    def stated(s: Column) -> Column:
        return s.rlike(MENTION_PATTERN) & ~s.rlike(CHRONIC_EXCLUDE) & has_event(scoped_events(s, MENTION_EVENTS), ["mention"])

    return F.coalesce(F.when(text.rlike(MENTION_PATTERN), sentence_spans(text, stated)), F.array().cast(SPAN_TYPE))


def chronicity(notes: DataFrame, text_col: str = "note_text", key: str = "patient_id") -> DataFrame:
    """Per patient, notes with a sentence that states the phenotype,
    their distinct dates, notes with chronic language in such a sentence, and
    ``qualifies`` = chronic language or >= 2 dates. Partial aggregates only."""
    found = notes.select(key, "contact_date", mentions(F.col(text_col)).alias("__m"))
    mention, chronic = F.size("__m") > 0, F.exists("__m", lambda s: s["text"].rlike(CHRONIC_INCLUDE))
    agg = found.groupBy(key).agg(
        F.count_if(mention).alias("mention_notes"),
        F.count_distinct(F.when(mention, F.col("contact_date"))).alias("mention_dates"),
        F.count_if(chronic).alias("chronic_notes"),
    )
    return agg.withColumn("qualifies", (F.col("chronic_notes") > 0) | (F.col("mention_dates") >= 2))


# ---------------------------------------------------------------------------
# Chronic / recurrent entries
# ---------------------------------------------------------------------------

# The word that names the kind of a chronic mention, strongest first.
INDICATORS = (
    ("chronic", r"(?i)(chronic|long-standing|longstanding|problem list|malabsorption|\bibd\b|celiac|workup)"),
    ("recurrent", r"(?i)(recurrent|recurs|recurring)"),
    ("persistent", r"(?i)(persistent|persists|ongoing|continued)"),
    ("prolonged", r"(?i)(for several (days|weeks|months)|for the (past|last) \d+ (weeks?|months?|years?))"),
)


def mention_episodes(dates: DataFrame, key: str = "patient_id", date_col: str = "mention_date", max_gap_days: int = 30) -> DataFrame:
    """Episodes of each patient's mention dates: runs of dates no more than
    ``max_gap_days`` apart, numbered from 1: (key, date, episode,
    episode_start, episode_end, episode_dates, episodes, mention_dates).
    Dates are made distinct before the window, so that a patient's group holds
    calendar days, however many notes there are. Null dates have no episode."""
    days = dates.filter(F.col(date_col).isNotNull()).select(key, F.col(date_col).cast("date").alias(date_col)).distinct()
    in_order = W.partitionBy(key).orderBy(date_col)
    opens = F.when(F.date_diff(date_col, F.lag(date_col).over(in_order)) <= max_gap_days, 0).otherwise(1)
    marked = days.withColumn("__opens", opens).withColumn("episode", F.sum("__opens").over(in_order).cast("int"))
    whole, own = W.partitionBy(key), W.partitionBy(key, "episode")
    return marked.select(
        key,
        date_col,
        "episode",
        F.min(date_col).over(own).alias("episode_start"),
        F.max(date_col).over(own).alias("episode_end"),
        F.count("*").over(own).alias("episode_dates"),
        F.max("episode").over(whole).alias("episodes"),
        F.count("*").over(whole).alias("mention_dates"),
    )


def chronic_entries(notes: DataFrame, text_col: str = "note_text", key: str = "patient_id", max_gap_days: int = 30) -> DataFrame:
    """L11 per entry: one row per sentence that states the phenotype, with
    its span, severity, date (``time``) or relative time, the patient's episode
    it falls in, and ``chronicity_indicator``: the word of the sentence, else
    ``recurrent`` for a patient with several episodes and ``persistent`` for
    one whose single episode has several dates, else null (it does not
    qualify). A mention is dated by its sentence, else by its note."""
    spans = notes.select(key, "note_id", "contact_date", F.explode(mentions(F.col(text_col))).alias("s"))
    sentence = F.col("s.text")
    time = F.get(F.filter(scoped_events(sentence, MENTION_EVENTS, dated=("mention",)), lambda e: e["scope"].isNull()), 0)["date"]
    rows = spans.select(key, "note_id", "contact_date", F.col("s.start").alias("start"), F.col("s.end").alias("end"), sentence.alias("evidence_text"), time.alias("time"))
    rows = rows.withColumn("mention_date", F.coalesce(F.try_to_date("time", "M/d/yy"), F.col("contact_date").cast("date")))
    rows = materialize(rows, "phenotype_mentions")
    episodes = mention_episodes(rows, key, "mention_date", max_gap_days).select(key, "mention_date", "episode", "episode_dates", "episodes", "mention_dates")
    joined = rows.join(episodes, [key, "mention_date"], "left")
    word = _first_rule(F.col("evidence_text"), INDICATORS, None)
    by_dates = F.when(F.col("episodes") > 1, "recurrent").when(F.col("mention_dates") > 1, "persistent")
    return joined.select(
        key,
        "note_id",
        "start",
        "end",
        "evidence_text",
        "time",
        F.when(F.col("time").isNull(), relative_time("evidence_text")).alias("time_description"),
        severity_level("evidence_text").alias("severity_level"),
        "episode",
        "episode_dates",
        F.coalesce(word, by_dates).alias("chronicity_indicator"),
    )
