"""The entry validator: grounding, verdict, support, severity, date and
duplicates of a note's entries in one pass.

A note's entries stay an array. Each is checked against the note by itself;
one fold over the checked entries, in their order, with a map of what was
kept, takes duplicates out. Nothing is exploded or grouped again, and a
note's text is read once for all its entries.

Rules, in this order; the first that removes an entry names the reason:

* ``not_positive``: only entries with a positive verdict are validated;
* ``quote_not_found``: the quote must occur in the note but for case,
  punctuation and white space; if it differs, it is replaced by the note's
  own words (``quote``);
* ``not_supported``: the quote must state the phenotype of the patient;
* the severity must be what the quote's words say, else it is replaced
  (``severity``);
* the date must stand in the sentences that hold the quote, else it becomes
  null (``date``); one written in another form is rewritten (``date_format``);
* ``duplicate``: an earlier kept entry has the same phenotype and date.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quotes import quote_span
from ..functions.segments import let, sentences, tile_sentences, tiles
from ..functions.text import match_form, normalize_verdict
from ..spec import ENTRY_FIELDS
from .assertions import has_event, scoped_events
from .extraction import date_mentions, normalize_date
from .rules import MENTION_EVENTS, intensity, severity_level

#: Words that state a phenotype, by a word of its name; another phenotype's
#: own name must stand in the quote.
SUPPORT: Mapping[str, Mapping[str, tuple[str, ...]]] = {"diarrhea": MENTION_EVENTS}
#: A phenotype with one of these words has a level of improvement.
IMPROVEMENT = r"(?i)improve"

_ENTRY = "struct<" + ",".join(f"{f}:string" for f in ENTRY_FIELDS) + ">"
_CHECKED = f"struct<entry:{_ENTRY},removed:string,fixed:array<string>>"
OUTCOME = "struct<pos:int,action:string,reasons:array<string>>"


def _stated(phenotype: Column, quote: Column) -> Column:
    out = F.contains(match_form(quote), match_form(phenotype))
    for word, events in SUPPORT.items():
        said = F.exists(sentences(quote), lambda s: has_event(scoped_events(s, events), list(events)))
        out = F.when(F.lower(phenotype).contains(word), said).otherwise(out)
    return F.coalesce(out, F.lit(False))


def _severity(phenotype: Column, quote: Column) -> Column:
    return F.when(phenotype.rlike(IMPROVEMENT), intensity(quote)).otherwise(severity_level(quote, phenotype))


def _entry(phenotype: Column, severity: Column, time: Column, quote: Column) -> Column:
    values = {"phenotype": phenotype, "present": F.lit("Yes"), "severity_level": severity, "time": time, "evidence_text": quote}
    return F.struct(*(values[f].cast("string").alias(f) for f in ENTRY_FIELDS)).cast(_ENTRY)


def _checked(e: Column, text: Column, form: Column, placed: Column) -> Column:
    """An entry as it should be, or why it goes; duplicates aside."""

    def result(entry: Column, removed: Column, fixed: Column) -> Column:
        return F.struct(entry.alias("entry"), removed.alias("removed"), fixed.alias("fixed")).cast(_CHECKED)

    def removed(why: str) -> Column:
        return result(e, F.lit(why), F.array().cast("array<string>"))

    def corrected(span: Column, level: Column, time: Column) -> Column:
        marks = {
            "quote": ~e["evidence_text"].eqNullSafe(span["text"]),
            "severity": ~e["severity_level"].eqNullSafe(level),
            "date": e["time"].isNotNull() & time.isNull(),
            "date_format": time.isNotNull() & (time != e["time"]),
        }
        fixed = F.filter(F.array(*(F.when(wrong, F.lit(k)) for k, wrong in marks.items())), lambda x: x.isNotNull())
        return result(_entry(e["phenotype"], level, time, span["text"]), F.lit(None).cast("string"), fixed)

    def found(span: Column) -> Column:
        # Only the tiles beside the quote are made sentences.
        meets = lambda s: (s["start"] < span["end"]) & (span["start"] < s["end"])
        beside = F.filter(tile_sentences(F.filter(placed, meets)), meets)
        near = F.flatten(F.transform(beside, lambda s: date_mentions(s["text"])))
        time = F.when(e["time"].isNotNull(), let(normalize_date(e["time"]), lambda date: F.when(F.array_contains(near, date), date)))
        whole = let(_severity(e["phenotype"], span["text"]), lambda level: let(time, lambda t: corrected(span, level, t)))
        return F.when(span.isNull(), removed("quote_not_found")).when(~_stated(e["phenotype"], span["text"]), removed("not_supported")).otherwise(whole)

    positive = F.coalesce(normalize_verdict(e["present"]) == "Yes", F.lit(False))
    return F.when(~positive, removed("not_positive")).otherwise(let(quote_span(e["evidence_text"], text, form), found))


def _without_duplicates(checked: Column) -> Column:
    """(entries kept in order, outcome of each) from the checked entries."""
    state = f"struct<seen:map<string,boolean>,kept:array<{_ENTRY}>,outcomes:array<{OUTCOME}>>"
    empty = F.struct(F.create_map().cast("map<string,boolean>").alias("seen"), F.array().cast(f"array<{_ENTRY}>").alias("kept"), F.array().cast(f"array<{OUTCOME}>").alias("outcomes")).cast(state)

    def step(s: Column, c: Column) -> Column:
        key = F.concat_ws("\x1f", F.lower(c["entry"]["phenotype"]), F.coalesce(c["entry"]["time"], F.lit("")))

        def outcome(action: Column, reasons: Column) -> Column:
            row = F.struct(F.size(s["outcomes"]).alias("pos"), action.alias("action"), reasons.alias("reasons")).cast(OUTCOME)
            return F.concat(s["outcomes"], F.array(row))

        def next_state(seen: Column, kept: Column, outcomes: Column) -> Column:
            return F.struct(seen.alias("seen"), kept.alias("kept"), outcomes.alias("outcomes")).cast(state)

        fixed = F.when(F.size(c["fixed"]) > 0, "fix").otherwise("keep")
        return (
            F.when(c["removed"].isNotNull(), next_state(s["seen"], s["kept"], outcome(F.lit("remove"), F.array(c["removed"]))))
            .when(F.map_contains_key(s["seen"], key), next_state(s["seen"], s["kept"], outcome(F.lit("remove"), F.array(F.lit("duplicate")))))
            .otherwise(next_state(F.map_concat(s["seen"], F.create_map(key, F.lit(True))), F.concat(s["kept"], F.array(c["entry"])), outcome(fixed, c["fixed"])))
        )

    return F.aggregate(checked, empty, step)


def validate_entries(replies: DataFrame, notes: DataFrame, entries_col: str = "entries") -> DataFrame:
    """``replies`` (note_id, entries) with ``validated``, the corrected array
    in the entries' order, and ``outcomes``: (pos, action keep / fix / remove,
    reasons) of every entry. A null array stays null; entries of a note that is
    missing or has no text are not found. Each cited note is read once."""
    cited = notes.join(replies.select("note_id"), "note_id", "left_semi")
    n = cited.select("note_id", F.coalesce("note_text", F.lit("")).alias("__text"))
    n = n.withColumns({"__form": match_form("__text"), "__tiles": tiles("__text")})
    # A note takes milliseconds, so partitions are not merged by their bytes.
    parts = int(notes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    j = replies.repartition(parts, "note_id").join(n.repartition(parts, "note_id"), "note_id", "left")
    # Without its note, an entry is checked against an empty text.
    j = j.withColumns({c: F.coalesce(c, F.lit("")) for c in ("__text", "__form")})
    checked = F.transform(entries_col, lambda e: _checked(e, F.col("__text"), F.col("__form"), F.col("__tiles")))
    j = j.withColumn("__done", _without_duplicates(checked))
    return j.withColumns({"validated": F.col("__done.kept"), "outcomes": F.col("__done.outcomes")}).drop("__text", "__form", "__tiles", "__done")
