"""Sentences, passages and quotes with offsets."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from cohortgrid.functions.quotes import quote_span
from cohortgrid.functions.segments import pieces, sentence_spans, sentences
from cohortgrid.operators import extraction as ex

SENTENCES = [
    ("Dose of Daybue is 3.5 mg. Seen by Dr. Smith on 2.15.24 for daybue.", ["Dose of Daybue is 3.5 mg.", "Seen by Dr. Smith on 2.15.24 for daybue."]),
    ("...trofinetide stopped", ["...trofinetide stopped"]),
    ("Started Daybue 0.5 mL on 2/15/24.", ["Started Daybue 0.5 mL on 2/15/24."]),
    ("Seen at 5 p.m. today. Left at 6 p.m. She was fine.", ["Seen at 5 p.m. today.", "Left at 6 p.m.", "She was fine."]),
    ("Was it J. K. Lee? Yes! \"No.\" (Done.) Next", ["Was it J. K. Lee?", "Yes!", "\"No.\"", "(Done.)", "Next"]),
    ("1. Rest.\n2. Call Mr. X\n10) more", ["1. Rest.", "2. Call Mr. X", "10) more"]),
    ("Title\nGiven daily\nand at night\n3 times", ["Title", "Given daily\nand at night\n3 times"]),
    ("one\n\ntwo\n \t\nthree", ["one", "two", "three"]),
    ("Give 5 mg. twice, e.g. now. Ok", ["Give 5 mg. twice, e.g. now.", "Ok"]),
    ("Feb. 15 was fine. It was Feb. Then", ["Feb. 15 was fine.", "It was Feb.", "Then"]),
    ("wait... what?! No way..", ["wait...", "what?!", "No way.."]),
    ("é😀 x. 漢字. \t end\r\n", ["é😀 x.", "漢字.", "end"]),
    ("!!! ... --", []),
    ("", []),
    (" \n ", []),
    (None, None),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SENTENCES)], "i int, t string")


def test_sentences_by_hand(texts):
    got = {r.i: r.s for r in texts.select("i", sentences("t").alias("s")).collect()}
    assert [got[i] for i in range(len(SENTENCES))] == [s for _, s in SENTENCES]


def test_spans_are_substrings(spark, texts):
    r = random.Random(4)
    parts = ["Dr.", "a", "Bc", ".", "!", " ", "\n", "3.5", "12", ")", "p.m.", "😀", "É", "mg.", "\t", "e.g."]
    more = ["".join(r.choices(parts, k=r.randint(0, 300))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t, _ in SENTENCES] + [(t,) for t in more], "t string")
    for row in df.select("t", pieces("t").alias("p"), sentence_spans("t").alias("s"), sentences("t").alias("x")).collect():
        if row.t is None:
            assert row.s is None
            continue
        assert "".join(row.p) == row.t, "pieces tile the text"
        assert [row.t[s.start : s.end] for s in row.s] == [s.text for s in row.s] == row.x
        assert all(a.end <= b.start for a, b in zip(row.s, row.s[1:]))


def test_long_text_without_stops(spark):
    """One sentence of 200,000 words, and 30,000 short ones."""
    df = spark.createDataFrame([("word " * 200_000,), ("Ab cd. " * 30_000,)], "t string")
    got = df.select(sentence_spans("t").alias("s")).select(F.size("s").alias("n"), F.element_at("s", -1).alias("l")).collect()
    assert [(r.n, r.l.start, r.l.end) for r in got] == [(1, 0, 999_999), (30_000, 7 * 29_999, 7 * 29_999 + 6)]


def test_passages(spark):
    note = "Seen by Dr. Lee at 2.5 yrs. Started\tDaybue  3.5 mg.\nMood ok. Trofinetide?"
    df = spark.createDataFrame([(note,), ("Nothing.",), (None,)], "t string")
    got = [r.p for r in df.select(ex.passage_spans("t").alias("p")).collect()]
    assert [p.text for p in got[0]] == ["Started\tDaybue  3.5 mg.", "Trofinetide?"]
    assert all(note[p.start : p.end] == p.text for p in got[0])
    assert got[1] == [] and got[2] is None


def form(text):
    """(offset, sign) pairs of the match form, sign by sign."""
    out = []
    for i, c in enumerate(text):
        for low in c.lower():
            if unicodedata.category(low)[0] in "LN":
                out.append((i, low))
            elif low in " \t\n\x0b\f\r" and out and out[-1][1] != " ":
                out.append((i, " "))
    while out and out[-1][1] == " ":
        out.pop()
    return out


def by_hand(quote, text):
    q, t = form(quote), form(text)
    at = "".join(c for _, c in t).find("".join(c for _, c in q)) if q else -1
    return None if at < 0 else (t[at][0], t[at + len(q) - 1][0] + 1)


def test_quotes_against_brute_force(spark):
    r = random.Random(1)
    signs = list("abcXYZé漢😀 .,-!  \n\t'İ9")
    rows = []
    for _ in range(1500):
        text = "".join(r.choices(signs, k=r.randint(0, 60)))
        at = r.randrange(len(text) + 1)
        quote = text[at : at + r.randint(1, 20)] if r.random() < 0.8 else "".join(r.choices(signs, k=4))
        quote = quote.upper() if r.random() < 0.5 else quote
        rows.append((quote.replace(" ", " , ") if r.random() < 0.3 else quote, text))
    rows += [("loose stool, in diaper", "Mother: (LOOSE) stool --\n in diaper!"), (None, "x"), ("x", None), ("", "x"), ("..", "..")]
    got = spark.createDataFrame(rows, "q string, t string").select("q", "t", quote_span("q", "t").alias("s")).collect()
    for row in got:
        want = by_hand(row.q, row.t) if row.q is not None and row.t is not None else None
        assert (None if row.s is None else (row.s.start, row.s.end)) == want, (row.q, row.t)
        if row.s:
            assert row.t[row.s.start : row.s.end] == row.s.text
    assert sum(row.s is not None for row in got) > 900


def test_quotes_in_long_texts(spark):
    text = "aa-bb " * 100_000 + "The END, my friend" + "-" * 50_000 + "x" * 50_000 + "Q!"
    df = spark.createDataFrame([(text, "the end my"), (text, "Q"), (text, "bb aa")], "t string, q string")
    got = [r.s for r in df.select(quote_span("q", "t").alias("s")).collect()]
    assert (got[0].start, got[0].text) == (600_000, "The END, my")
    assert (got[1].start, got[1].end) == (len(text) - 2, len(text) - 1)
    assert (got[2].start, got[2].text) == (3, "bb aa")


def test_evidence_spans(spark):
    notes = spark.createDataFrame([("n1", "Mother: loose stool,\nin diaper."), ("n2", None), ("n9", "unused")], "note_id string, note_text string")
    entries = spark.createDataFrame(
        [("n1", "LOOSE STOOL IN DIAPER", 1), ("n1", "watery", 2), ("n2", "x", 3), ("n3", "x", 4), ("n1", None, 5)], "note_id string, evidence_text string, k int"
    )
    got = {r.k: (r.grounded, r.quote_start, r.quote_end, r.quote_text) for r in ex.evidence_spans(entries, notes).collect()}
    none = (False, None, None, None)
    assert got == {1: (True, 8, 30, "loose stool,\nin diaper"), 2: none, 3: none, 4: none, 5: none}


def test_quotes_behind_signs_beyond_the_first_plane(spark):
    """A letter of two code units ends a word as any other."""
    text = "a-b, \U00020000 \U00020001. " * 3 + "x " * 200 + "Loose-stool \U00020000, twice. " + "y " * 500
    cases = {"loosestool \U00020000 twice": "Loose-stool \U00020000, twice", "\U00020001 x x": "\U00020001. x x", "y y y": "y y y"}
    rows = spark.createDataFrame([(q, text) for q in cases], "q string, t string")
    for r in rows.select("q", quote_span("q", "t").alias("s")).collect():
        at = text.index(cases[r.q])
        assert (r.s.start, r.s.end, r.s.text) == (at, at + len(cases[r.q]), cases[r.q])
