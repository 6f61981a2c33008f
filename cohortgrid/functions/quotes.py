"""Where a quote stands in a text, in the text's own words.

Quote and text are compared in match form (lower case, punctuation dropped,
white space folded). In that form a text is its words with one space
between; the form's n-th word is what stands before the n-th gap of the
text, where a gap is a run without letters and digits from a white space on.
So a position in the form leads back to the text by counting gaps before it,
and then letters and digits within one word. The text is cut once, at the
word where the quote begins; its end is counted from there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .segments import let
from .text import match_form

SPAN_TYPE = "struct<start:int,end:int,text:string>"

# It begins with one sign and is never given back, so a text is scanned once.
_GAP = r"\s[^\p{L}\p{N}]*+"
_LEAD = r"\A[^\p{L}\p{N}]+"


def _held_sign(word: Column, n: Column) -> Column:
    """The index in ``word`` of its n-th letter or digit, both from 0."""
    signs = F.split(word, "")
    return let(signs, lambda s: F.get(F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.get(s, i).rlike(r"[\p{L}\p{N}]")), n))


def _word_start(text: Column, words: Column, signs: Column) -> Column:
    """The offset in ``text`` of its word number ``words`` (from 0), which
    has ``signs`` signs of the form before it. A split reads its input to the
    end whatever its limit, so the word is looked for in the text's head
    first, and in all of it if it begins behind that."""

    def within(head: Column) -> Column:
        parts = F.split(F.regexp_replace(head, _LEAD, ""), _GAP, words + 1)
        last = lambda p: F.when((F.size(p) > words) & (F.element_at(p, -1) != ""), F.length(head) - F.length(F.element_at(p, -1)))
        return let(parts, last)

    return F.coalesce(let(F.substring(text, F.lit(1), 2 * signs + 64), within), within(text))


def _skip(rest: Column, in_word: Column) -> Column:
    """The offset in ``rest`` of its first word's ``in_word``-th letter or
    digit (from 0)."""
    return F.when(in_word == 0, F.lit(0)).otherwise(_held_sign(F.regexp_extract(rest, r"\A\S*", 0), in_word))


def _place(form: Column, position: Column) -> Column:
    """(words, signs) before a position (from 0) of a form: whole words, and
    signs within the word that holds it."""

    def counted(before: Column) -> Column:
        words = F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit("")))
        return F.struct(words.alias("words"), F.length(F.substring_index(before, " ", -1)).alias("signs"))

    return let(F.substring(form, F.lit(1), position), counted)


def quote_span(quote: str | Column, text: str | Column, form: str | Column | None = None) -> Column:
    """(start, end, text) of the first place where ``text`` has the quote,
    in code points, the end exclusive; null where it has not. ``form``: the
    text's match form, if it is at hand."""
    text = F.col(text) if isinstance(text, str) else text
    form = match_form(text) if form is None else F.col(form) if isinstance(form, str) else form

    def tail(offset: Column) -> Column:
        return F.substring(text, offset + 1, F.length(text))

    def spanned(word: Column, first: Column, q: Column) -> Column:
        """The span from the offset of the quote's first word. There, the
        quote's own form follows ``first`` signs of that word."""
        at_end = first + F.length(q) - 1
        rest = tail(word)
        last = let(_place(F.concat(F.repeat(F.lit("x"), first), q), at_end), lambda p: let(_word_start(rest, p["words"], at_end), lambda w: word + w + _skip(tail(word + w), p["signs"])))
        ends = F.struct((word + _skip(rest, first)).alias("start"), (last + 1).alias("end"))
        return let(ends, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("text"))).cast(SPAN_TYPE)

    def place(f: Column, q: Column, at: Column) -> Column:
        found = let(_place(f, at - 1), lambda p: let(_word_start(text, p["words"], at - 1), lambda word: spanned(word, p["signs"], q)))
        return F.when((q != "") & (at > 0), found)

    return let(form, lambda f: let(match_form(quote), lambda q: let(F.instr(f, q), lambda at: place(f, q, at))))
