"""Sentences of a text with their code-point offsets.

A text is tiled by one regular expression into pieces that end at a
boundary; joined, the pieces are the text again. A sentence is a piece
without its outer white space, if it holds a letter or a digit. A sentence
is therefore an exact substring, and its offsets follow from the lengths of
the pieces before it.

Boundaries are

* ``.``, ``!`` or ``?`` (with further ones and closing quotes or brackets)
  before white space, so decimals and dates such as ``3.5`` and ``2.15.24``
  hold together; not after titles and initials, not after the number of a
  list item, and not after abbreviations that a lower-case word or a number
  follows;
* a blank line;
* a line break, unless the next line goes on in lower case or with a number
  that marks no list item.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words before a full stop that ends no sentence.
TITLES = ("Dr", "Mr", "Mrs", "Ms", "Prof", "St", "vs", "e.g", "i.e", "approx", "Pt")
# ... that ends one only before a capital letter or other sign.
SHORT_FORMS = (
    "a.m", "p.m", "etc", "No", "b.i.d", "t.i.d", "q.d", "mg", "mL", "wk", "wks", "mo", "mos", "yr", "yrs",
    "Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sep", "Sept", "Oct", "Nov", "Dec",
)

SPACE = r" \t\n\r\f"


def _any(words: tuple[str, ...]) -> str:
    return "|".join(w.replace(".", r"\.") for w in words)


_TITLE = rf"(?<!(?<!\p{{L}})(?:{_any(TITLES)}|[A-Z])\.)"
_LIST_NUMBER = r"(?<!(?:\A|\n)[ \t\r\f]{0,8}\d{1,3}\.)"
_SHORT_FORM = rf"(?!(?<=(?<!\p{{L}})(?:{_any(SHORT_FORMS)})\.)[{SPACE}]++[\p{{Ll}}\d])"
_STOP = rf"""(?:\.{_TITLE}{_LIST_NUMBER}|[!?])[.!?]*+["')\]]*+{_SHORT_FORM}(?:[{SPACE}]++|\z)"""
_LINE = rf"\n(?:[ \t\r\f]*+\n|(?![{SPACE}]*+(?:\p{{Ll}}|\d(?!\d{{0,2}}[.)][{SPACE}]))))[{SPACE}]*+"
_BOUNDARY = rf"(?:{_STOP}|{_LINE})"
# Possessive loops, which the engine runs without recursion.
PIECE_PATTERN = rf"(?:[^.!?\n]++|(?!{_BOUNDARY})[.!?\n])*+(?:{_BOUNDARY}|\z)"

SPAN_TYPE = "array<struct<start:int,end:int,text:string>>"
_BLOCK = 64


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pieces(text: str | Column) -> Column:
    """The tiles of a text, in order."""
    return F.regexp_extract_all(_c(text), F.lit(PIECE_PATTERN), F.lit(0))


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def _has_word(c: Column) -> Column:
    return c.rlike(r"[\p{L}\p{N}]")


def sentences(text: str | Column) -> Column:
    """Array of the sentences of a text, in order; null for a null text."""
    return F.filter(F.transform(pieces(text), _stripped), _has_word)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _up_to(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _starts(lengths: Column) -> Column:
    """Running sums before each element of an array, in two levels: sums of
    whole blocks, and the lengths within the element's own block."""
    blocks = F.transform(_up_to(F.ceil(F.size(lengths) / _BLOCK).cast("int")), lambda b: _total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))

    def before(sums: Column) -> Column:
        return F.transform(_up_to(F.size(sums)), lambda b: _total(F.slice(sums, F.lit(1), b)))

    def each(base: Column) -> Column:
        return F.transform(_up_to(F.size(lengths)), lambda i: F.get(base, F.floor(i / _BLOCK).cast("int")) + _total(F.slice(lengths, i - i % _BLOCK + 1, i % _BLOCK)))

    return let(blocks, lambda sums: let(before(sums), each))


def tiles(text: str | Column) -> Column:
    """Array of (start, end, text) of the pieces of a text."""
    placed = lambda t, s: F.struct(s.alias("start"), (s + F.length(t)).alias("end"), t.alias("text"))
    return let(pieces(text), lambda p: F.zip_with(p, let(F.transform(p, F.length), _starts), placed)).cast(SPAN_TYPE)


def tile_sentences(placed: Column, wanted: Callable[[Column], Column] | None = None) -> Column:
    """The sentences of an array of ``tiles``."""
    lead = lambda t: F.length(F.regexp_extract(t["text"], rf"\A[{SPACE}]*", 0))
    rows = F.transform(placed, lambda t: F.struct((t["start"] + lead(t)).alias("start"), _stripped(t["text"]).alias("text")))
    found = F.filter(rows, (lambda r: _has_word(r["text"]) & wanted(r["text"])) if wanted else lambda r: _has_word(r["text"]))
    return F.transform(found, lambda r: F.struct(r["start"].alias("start"), (r["start"] + F.length(r["text"])).alias("end"), r["text"].alias("text")))


def sentence_spans(text: str | Column, wanted: Callable[[Column], Column] | None = None) -> Column:
    """Array of (start, end, text) of the sentences of a text that meet
    ``wanted`` (a condition on a sentence); offsets count code points, the
    end is exclusive. Null for a null text."""
    return tile_sentences(tiles(text), wanted).cast(SPAN_TYPE)
