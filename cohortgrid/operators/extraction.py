"""Deterministic parts of the extraction instructions as table jobs:
passages, reply contract, quote and date grounding, positive-only,
date normalization, entry dedup, relative time phrases.

All are built-in expressions (``regexp_extract_all``, higher-order
``filter``/``transform``, ``posexplode``); no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quotes import quote_span
from ..functions.segments import SPAN_TYPE, sentence_spans, sentences
from ..functions.text import contains_any, match_form, normalize_verdict
from ..spec import DEFAULT_KEYWORDS, ENTRY_SCHEMA, NO_PASSAGE
from .verdicts import parse_payload

# Accepted reply values of the extraction contract.
VERDICTS = ("Yes", "No")
SEVERITIES = ("1", "2", "3", "4", "N/A")
MDYY_PATTERN = r"^\d{1,2}/\d{1,2}/\d{2}$"

# Date formats understood by the normalizer, tried in this order.
DATE_INPUT_FORMATS = ("M/d/yy", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "MMMM yyyy", "MMM yyyy")
# What a text must have for a format to fit. Trying one in vain costs an
# exception, many times a match.
DATE_SHAPES = {"M/d/yy": r"/\d\d\z", "M/d/yyyy": r"/.*\d{4}\z", "MMMM d, yyyy": r", .*\d{4}\z", "MMM d, yyyy": r", .*\d{4}\z", "MMMM yyyy": r" .*\d{4}\z", "MMM yyyy": r" .*\d{4}\z"}

# Date mentions found in free text: numeric, "Month d, yyyy", "Mon[th] yyyy".
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
MONTHS_SHORT = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
DATE_MENTION_PATTERN = (
    r"\d{1,2}/\d{1,2}/\d{2,4}" + "|(" + MONTHS + r") \d{1,2}, \d{4}" + "|(" + MONTHS_SHORT + r")[a-z]* \d{4}"
)

# Relative time phrases kept as text.
RELATIVE_TIME_PATTERN = (
    r"(?i)\b(for the (past|last) \d+ (days?|weeks?|months?|years?)"
    r"|for several (days|weeks|months|years)"
    r"|since (starting|last) \w+)"
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def passage_spans(text: str | Column, keywords: Iterable[str] = DEFAULT_KEYWORDS) -> Column:
    """L1: the sentences that mention a keyword, as (start, end, text) spans
    of the note in order; a note without a keyword is not cut at all."""
    words = [k.lower() for k in keywords]
    hit = F.when(contains_any(text, words), sentence_spans(text, lambda s: contains_any(s, words)))
    return F.coalesce(hit, F.when(_c(text).isNotNull(), F.array().cast(SPAN_TYPE)))


def passage(text: str | Column, keywords: Iterable[str] = DEFAULT_KEYWORDS, none_text: str = NO_PASSAGE) -> Column:
    """L1: the sentences that mention a keyword, verbatim, in order, joined
    by one space; ``none_text`` when none does; null text stays null."""
    words = [k.lower() for k in keywords]
    kept = F.when(contains_any(text, words), F.filter(sentences(text), lambda s: contains_any(s, words)))
    joined = F.array_join(kept, " ")
    return F.when(_c(text).isNull(), F.lit(None).cast("string")).when(F.coalesce(joined, F.lit("")) == "", F.lit(none_text)).otherwise(joined)


def normalize_date(c: str | Column, formats: Iterable[str] = DATE_INPUT_FORMATS) -> Column:
    """A date written in any known format, as M/d/yy text (month-year
    forms give the 1st); unknown text -> null."""
    c = _c(c)
    tried = lambda f: F.when(c.rlike(DATE_SHAPES[f]), F.try_to_date(c, f)) if f in DATE_SHAPES else F.try_to_date(c, f)
    parsed = F.coalesce(*map(tried, formats))
    return F.date_format(parsed, "M/d/yy")


def date_mentions(text: str | Column) -> Column:
    """All dates written in a text, normalized to M/d/yy."""
    found = F.regexp_extract_all(_c(text), F.lit(DATE_MENTION_PATTERN), 0)
    return F.filter(F.transform(found, lambda s: normalize_date(s)), lambda s: s.isNotNull())


def grounded_date(time: str | Column, text: str | Column) -> Column:
    """The reply's date if the note states that date, else null."""
    t = normalize_date(time)
    return F.when(F.array_contains(date_mentions(text), t), t)


def grounded_quote(quote: str | Column, text: str | Column, text_is_form: bool = False) -> Column:
    """L3: the quote occurs in the note, ignoring case, punctuation and
    spacing (whole texts compared). ``text_is_form``: ``text`` is already
    in match form."""
    q = match_form(quote)
    form = _c(text) if text_is_form else match_form(text)
    return F.when(_c(quote).isNull() | _c(text).isNull(), F.lit(False)).otherwise((q != "") & F.contains(form, q))


def evidence_grounding(entries: DataFrame, notes: DataFrame, quote_col: str = "evidence_text") -> DataFrame:
    """L3: every entry with ``grounded``; ungrounded ones are the ones the
    validator removes. Only notes that an entry cites are brought to match
    form, each once, before entries join their note on ``note_id``."""
    cited = notes.join(entries.select("note_id"), "note_id", "left_semi")
    n = cited.select("note_id", match_form("note_text").alias("__form"))
    j = entries.join(n, "note_id", "left")
    return j.withColumn("grounded", grounded_quote(quote_col, "__form", text_is_form=True)).drop("__form")


def evidence_spans(entries: DataFrame, notes: DataFrame, quote_col: str = "evidence_text") -> DataFrame:
    """L3: every entry with ``grounded`` and where its quote stands in the
    note: ``quote_start``, ``quote_end`` (code points, the end exclusive) and
    ``quote_text``, the note's own words; null where it does not occur. Only
    notes that an entry cites are read, and each is brought to match form
    once."""
    cited = notes.join(entries.select("note_id"), "note_id", "left_semi")
    n = cited.select("note_id", F.col("note_text").alias("__text"), match_form("note_text").alias("__form"))
    j = entries.join(n, "note_id", "left").withColumn("__span", quote_span(quote_col, "__text", "__form"))
    return j.withColumns(
        {
            "grounded": F.col("__span").isNotNull(),
            "quote_start": F.col("__span.start"),
            "quote_end": F.col("__span.end"),
            "quote_text": F.col("__span.text"),
        }
    ).drop("__text", "__form", "__span")


def response_contract(replies: DataFrame, cols: Iterable[str] = ("extracted_llm", "val_llm")) -> DataFrame:
    """L2: per reply column: replies, unparsable replies, entries, and the
    entries breaking each rule (verdict, severity, M/D/YY date). One pass:
    each reply is parsed once, its entries are counted in their array, and
    one aggregate sums up all columns. An empty table gives no rows."""
    cols = list(cols)
    parsed = replies.select(*(c for k, name in enumerate(cols) for c in (F.col(name).isNotNull().alias(f"__has{k}"), parse_payload(name, ENTRY_SCHEMA).alias(f"__p{k}"))))
    breaks = {
        "bad_present": lambda e: ~F.coalesce(e["present"].isin(list(VERDICTS)), F.lit(False)),
        "bad_severity": lambda e: ~F.coalesce(e["severity_level"].isin(list(SEVERITIES)), F.lit(False)),
        "bad_time": lambda e: e["time"].isNotNull() & ~e["time"].rlike(MDYY_PATTERN),
    }
    counts = []
    for k in range(len(cols)):
        has, entries = F.col(f"__has{k}"), F.filter(f"__p{k}", lambda e: e.isNotNull())
        total = lambda n: F.coalesce(F.sum(F.coalesce(n, F.lit(0)).cast("long")), F.lit(0))
        own = {"replies": F.count_if(has), "unparsable": F.count_if(has & F.col(f"__p{k}").isNull()), "entries": total(F.size(entries))}
        own |= {name: total(F.size(F.filter(entries, wrong))) for name, wrong in breaks.items()}
        counts += [c.alias(f"{name}{k}") for name, c in own.items()]
    summed = parsed.agg(F.count(F.lit(1)).alias("__rows"), *counts).filter("__rows > 0")
    names = ("replies", "unparsable", "entries", *breaks)
    rows = F.array(*(F.struct(F.lit(c).alias("source"), *(F.col(f"{name}{k}").alias(name) for name in names)) for k, c in enumerate(cols)))
    return summed.select(F.inline(rows))


def positive_only(entries: DataFrame) -> DataFrame:
    """L4: entries whose normalized verdict is Yes."""
    return entries.filter(normalize_verdict("present") == "Yes")


def entry_dedup(entries: DataFrame, keys: Iterable[str] = ("note_id", "phenotype", "time")) -> DataFrame:
    """One entry per (note, phenotype, time): the earliest by position.
    ``min_by`` over a struct is a partial aggregate; no window sort."""
    keys = list(keys)
    rest = [c for c in entries.columns if c not in keys]
    best = entries.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col("pos")).alias("__b"))
    return best.select(*keys, "__b.*").select(*entries.columns)


def relative_time(text: str | Column) -> Column:
    """The first relative time phrase of a text, or null."""
    m = F.regexp_extract(_c(text), RELATIVE_TIME_PATTERN, 0)
    return F.when(m != "", m)
