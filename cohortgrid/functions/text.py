"""Column functions over text: fenced JSON, verdict words, match forms.

All return ``Column`` built from Spark built-ins, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import JSON_FENCE, JSON_FENCE_BODY, NO_WORDS, YES_WORDS


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_llm_json(c: str | Column) -> Column:
    """Body of the first markdown json fence if there is one, then every
    whitespace run collapsed to one space (newlines included)."""
    c = _c(c)
    body = F.when(c.contains(JSON_FENCE), F.regexp_extract(c, JSON_FENCE_BODY, 1)).otherwise(c)
    return F.regexp_replace(body, r"\s+", " ")


def normalize_verdict(
    c: str | Column, yes: Iterable[str] = YES_WORDS, no: Iterable[str] = NO_WORDS
) -> Column:
    """Trim + lower, then Yes / No / null by word list."""
    w = F.lower(F.trim(_c(c)))
    return (
        F.when(w.isin(list(yes)), F.lit("Yes"))
        .when(w.isin(list(no)), F.lit("No"))
        .otherwise(F.lit(None).cast("string"))
    )


def contains_any(c: str | Column, keywords: Iterable[str]) -> Column:
    """lower-cased text contains any keyword (keywords given lower-case)."""
    low = F.lower(_c(c))
    return reduce(lambda a, b: a | b, [low.contains(k) for k in keywords])


def rlike_any(cols: Iterable[str | Column], pattern: str) -> Column:
    """a regex matches any of several columns."""
    return reduce(lambda a, b: a | b, [_c(c).rlike(pattern) for c in cols])


def match_form(c: str | Column) -> Column:
    """Case-, punctuation- and space-insensitive form used to ground quotes."""
    low = F.lower(_c(c))
    no_punct = F.regexp_replace(low, r"[^\p{L}\p{N}\s]", "")
    return F.trim(F.regexp_replace(no_punct, r"\s+", " "))

