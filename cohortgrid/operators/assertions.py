"""Scoped assertions: what a sentence says happened, and in which scope.

A sentence is cut into tokens, trigger phrases first. One fold over them
keeps the open scope (negated, planned, about someone else), which a
trigger opens and which ends after some words or at a terminator. An event
found on the way is noted with the scope it stands in and the date that
belongs to it: the next date, or one given before it in the same clause.

The trigger lists are word rules standing in for a model's judgment. They
are parameters; the defaults cover the extraction instructions' examples.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .extraction import DATE_MENTION_PATTERN, normalize_date

# ---------------------------------------------------------------------------
# Trigger phrases (matched in any case, as whole words).
# ---------------------------------------------------------------------------

NEGATED = (
    r"not", r"never", r"no", r"without", r"yet to", r"unable to", r"cannot", r"denie[sd]", r"neither", r"nor",
    r"(?:has|have|had|did|does|do|is|was|are|were|wo|ca|could|would|should)n['’]t", r"declined", r"refused", r"free of", r"negative for",
)
PLANNED = (
    r"will", r"plan(?:s|ned|ning)?(?: to| on)?", r"going to", r"consider(?:s|ed|ing)?", r"would like", r"want(?:s|ed)?(?: to)?", r"hop(?:es|ing) to",
    r"intend(?:s|ed|ing)?", r"await(?:s|ing)?", r"pending", r"once", r"if", r"may", r"might", r"scheduled", r"prior auth(?:orization)?",
    r"(?:hold|holding|held) off(?: on)?", r"on hold", r"postpon(?:e|ed|ing)", r"delay(?:ed|ing)?", r"defer(?:red|ring)?", r"wait(?:s|ing)? (?:on|to|for)",
    r"call if", r"watch for", r"risk of", r"monitor for",
)
SOMEONE_ELSE = (
    r"brothers?", r"sisters?", r"siblings?", r"cousins?", r"aunt", r"uncle", r"grand(?:mother|father|parents?)", r"friend(?:'s|’s)?",
    r"another (?:patient|child|girl|boy|family)", r"other (?:patients|children|girls|boys|families)", r"family history(?: of)?",
)
#: A scope ends here, and so does what a date can belong to.
BREAKS = (r"but", r"however", r"although", r"though", r"[;:]")
#: Only the scope ends here.
PAUSES = (r"since", r"after", r"because", r"while", r"despite", r"due to")

#: Words until an open scope ends by itself; a scope about someone else lasts
#: until a terminator.
SCOPE_WORDS = {"negated": 6, "planned": 8, "someone_else": 1000}

EVENT_TYPE = "struct<event:string,scope:string,date:string>"
_STATE = f"struct<scope:string,left:int,pending:string,last:{EVENT_TYPE},found:array<{EVENT_TYPE}>>"


def _words(patterns: Iterable[str]) -> str:
    return "|".join(patterns)


def _whole(body: str) -> str:
    return rf"(?<![\p{{L}}\p{{N}}])(?:{body})(?![\p{{L}}\p{{N}}])"


def scoped_events(sentence: Column, events: Mapping[str, Iterable[str]], dated: Iterable[str] = ()) -> Column:
    """Array of (event, scope, date) in the order of the sentence.

    ``events`` names what to look for by its trigger phrases; earlier names
    win where phrases overlap, and all win over the scope triggers. ``scope``
    is null for what is simply stated, else ``negated``, ``planned`` or
    ``someone_else``. Only events of ``dated`` take a date (M/d/yy); any event
    takes one that follows ``since``. A null sentence has no events.
    """
    scopes = {"planned": PLANNED, "negated": NEGATED, "someone_else": SOMEONE_ELSE}
    marks = {**{f"event:{k}": v for k, v in events.items()}, **{f"scope:{k}": v for k, v in scopes.items()}, "break": BREAKS, "pause": PAUSES}
    date = f"(?:{DATE_MENTION_PATTERN})"
    phrases = "|".join(_whole(_words(v)) if k != "break" else f"{_whole(_words(v[:-1]))}|{v[-1]}" for k, v in marks.items())
    token = rf"(?i)since {date}|{date}|{phrases}|[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}'’-]*"

    def kind(t: Column) -> Column:
        out = F.when(t.rlike(rf"(?i)\Asince {date}\z"), "since_date").when(t.rlike(rf"(?i)\A{date}\z"), "date")
        for name, patterns in marks.items():
            out = out.when(t.rlike(rf"(?i)\A(?:{_words(patterns)})\z"), name)
        return out.otherwise("word")

    def read(t: Column) -> Column:
        return F.struct(kind(t).alias("kind"), normalize_date(F.regexp_extract(t, rf"(?i){date}", 0)).alias("date"))

    null = F.lit(None).cast("string")
    no_event = F.lit(None).cast(EVENT_TYPE)
    takes = list(dated)

    def kept(s: Column) -> Column:
        return F.when(s["last"].isNull(), s["found"]).otherwise(F.concat(s["found"], F.array(s["last"])))

    def state(scope: Column, left: Column, pending: Column, last: Column, found: Column) -> Column:
        return F.struct(scope.alias("scope"), left.cast("int").alias("left"), pending.alias("pending"), last.alias("last"), found.alias("found")).cast(_STATE)

    def step(s: Column, t: Column) -> Column:
        k, scope = t["kind"], F.when(s["left"] > 0, s["scope"])
        name = F.regexp_extract(k, r"\A(?:event|scope):(.*)", 1)
        is_event, is_scope = k.startswith("event:"), k.startswith("scope:")
        datable = name.isin(takes) if takes else F.lit(False)
        event = F.struct(name.alias("event"), scope.alias("scope"), F.when(datable, s["pending"]).alias("date")).cast(EVENT_TYPE)
        open_ = s["last"].isNotNull() & s["last"]["date"].isNull()
        fits = open_ & ((k == "since_date") | (s["last"]["event"].isin(takes) if takes else F.lit(False)))
        dated_last = F.struct(s["last"]["event"].alias("event"), s["last"]["scope"].alias("scope"), t["date"].alias("date")).cast(EVENT_TYPE)
        is_date = k.isin("date", "since_date")
        after = s["left"] - 1
        words_left = F.lit(0)
        for of, n in SCOPE_WORDS.items():
            words_left = F.when(name == of, n).otherwise(words_left)
        return (
            F.when(is_event, state(scope, after, F.when(datable, null).otherwise(s["pending"]), event, kept(s)))
            .when(is_scope & (F.coalesce(scope, F.lit("")) == "someone_else"), state(scope, after, s["pending"], s["last"], s["found"]))
            .when(is_scope, state(name, words_left, s["pending"], s["last"], s["found"]))
            .when(is_date & fits, state(scope, after, s["pending"], dated_last, s["found"]))
            .when(is_date, state(scope, after, t["date"], s["last"], s["found"]))
            .when(k == "break", state(null, F.lit(0), null, no_event, kept(s)))
            .when(k == "pause", state(null, F.lit(0), s["pending"], s["last"], s["found"]))
            .otherwise(state(scope, after, s["pending"], s["last"], s["found"]))
        )

    tokens = F.transform(F.regexp_extract_all(F.coalesce(sentence, F.lit("")), F.lit(token), F.lit(0)), read)
    empty = state(null, F.lit(0), null, no_event, F.array().cast(f"array<{EVENT_TYPE}>"))
    return F.aggregate(tokens, empty, step, kept)


def has_event(events: Column, names: Iterable[str], scopes: Iterable[str] | None = None) -> Column:
    """An event of these names that is stated (no ``scopes``) or stands in
    one of ``scopes``."""
    names = list(names)
    inside = (lambda e: e["scope"].isNull()) if scopes is None else (lambda e: F.coalesce(e["scope"].isin(list(scopes)), F.lit(False)))
    return F.exists(events, lambda e: e["event"].isin(names) & inside(e))
