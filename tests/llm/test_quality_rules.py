import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cohortgrid.llm.quality_rules import BASE_RULES, RULES, beta_priors, quality_rules
from llm.conftest import DOCUMENTS, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    measures = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))
    return *measures, len(w) < 20 or 100 * len(hit) > 30 * len(w)


def corpus():
    r = random.Random(2)
    rows = []
    for k in range(120):
        lines = [prose(r.randint(0, 30), r.randint(1, 12)) for _ in range(r.randint(1, 30))]
        rows.append((100 + k, "\n".join(lines) + r.choice(["", "\n", " \n\n", "\r\n"]), "en", r.choice("abc"), 0))
    rows.append((300, " ".join(["again"] * 40), "en", "a", 0))
    rows.append((301, "w " * 7 + "\n" + "w " * 7, "en", "a", 0))
    rows += [(400 + k, "## $$ | < > * & % " * 3 + prose(k, 30), "en", "spam", 0) for k in range(60)]
    rows += [(500 + k, prose(900 + k, 40), "en", "spam", 0) for k in range(5)]
    rows += [(600, "# * # * # * # * " + prose(700, 30), "en", "lone", 0)]
    return odd_rows() + rows


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DOCUMENTS + ", host string, salt string, n_words int")
    return quality_rules(df, F.col("source"), **options)


def test_base_measures(spark):
    got = run(spark, corpus()).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((r[0], *base(r[1])) for r in corpus()), key=str)


def by_hand(rows, max_rate):
    """Host verdicts from the moments, in plain Python."""
    hosts = {}
    for r in rows:
        text = r[1] or ""
        words, chars, symbols, dup, _, _ = base(text)
        lines = sum(bool(WORD.search(x)) for x in text.split("\n"))
        failed = {"symbols": 10 * symbols > words, "dup_lines": 100 * dup > 30 * lines, "word_length": words > 0 and (chars < 2 * words or chars > 15 * words)}
        c = hosts.setdefault(r[3], Counter())
        c["n"] += 1
        c.update(k for k, v in failed.items() if v)
    rejected = set()
    n = sum(c["n"] for c in hosts.values())
    for rule in ("symbols", "dup_lines", "word_length"):
        mean = sum(c[rule] for c in hosts.values()) / n
        chance = mean * (1 - mean)
        spread = sum(c["n"] * (c[rule] / c["n"] - mean) ** 2 for c in hosts.values())
        below = chance * (n - sum(c["n"] ** 2 for c in hosts.values()) / n - (len(hosts) - 1))
        excess = (spread - chance * (len(hosts) - 1)) / below if below else 0
        weight = max(min(1 / excess - 1, 1e6), 10) if excess > 0 else 1e6
        rejected |= {h for h, c in hosts.items() if (c[rule] + mean * weight) / (c["n"] + weight) >= max_rate}
    return rejected


def test_host_verdicts(spark):
    got = run(spark, corpus()).collect()
    bad = by_hand(corpus(), 0.5)
    assert "spam" in bad and "a" not in bad
    host = {r[0]: r[3] for r in corpus() if r[0] is not None}
    for r in got:
        if r.doc_id is not None:
            assert r.host_rejected == (host[r.doc_id] in bad)
        assert r.kept == (not r.base_failed and not r.host_rejected)
    # Clean documents of the bad host go, those of the good ones stay.
    assert not any(r.kept for r in got if r.doc_id and 500 <= r.doc_id < 505)
    assert any(r.kept for r in got)


def test_small_hosts_lean_on_the_corpus(spark):
    """One failing document says less than sixty."""
    got = {r.doc_id: r.host_rate for r in run(spark, corpus()).collect()}
    assert got[600] < got[400]


def test_equal_hosts_share_one_rate(spark):
    hosts = spark.createDataFrame([(f"h{k}", 100, 30) for k in range(10)], "host string, documents long, f_x long")
    prior = beta_priors(hosts, {"x": "true"}).first()
    assert abs(prior.m_x - 0.3) < 1e-12 and prior.s_x == 1e6


def test_empty_and_rules(spark, no_documents):
    assert quality_rules(no_documents, F.col("source")).count() == 0
    assert set(BASE_RULES) < set(RULES)
    one = run(spark, [(None, None, None, None, None)]).collect()
    assert len(one) == 1 and one[0].base_failed and not one[0].kept
    assert [r.kept for r in run(spark, [(1, prose(5, 30), "en", None, 0)]).collect()] == [True]
