import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from cohortgrid.llm import phrase_mining as pm
from llm.conftest import DOCUMENTS, odd_rows


def brute_force(rows, least, share=80, limit=2000):
    counts, sizes = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            for size in range(1, 5):
                counts[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        found = [p for p in f if len(p) > 1 and f[p] >= least]
        inside = Counter()
        for q in found:
            for size in range(2, len(q)):
                for i in range(len(q) - size + 1):
                    p = q[i : i + size]
                    inside[p] = max(inside[p], f[q])
        kept = []
        for p in found:
            if 100 * inside[p] < share * f[p]:
                score, _, l, r = min((2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -f[p], " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def corpus():
    r = random.Random(9)
    word = ["The", "of", "a", "É", "漢", "x-y", "data", "set", "New", "york"]
    rows = []
    for k in range(250):
        parts = []
        for _ in range(r.randint(1, 25)):
            parts += r.choices(word, k=r.randint(1, 5)) if r.random() < 0.6 else ["new", "York", "city", "Hall"][: r.randint(2, 4)]
            parts.append(r.choice([".", ",", "\n", "", "!", "\t", "\x0b"]))
        rows.append((100 + k, " ".join(parts), r.choice(["en", "en", "de", None, "und"]), "a", 0))
    rows += [(900 + k, "a a a a a a a, only here: one time\r\nonly  here\tone", "fr", "a", 0) for k in range(12)]
    return odd_rows() + rows


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCUMENTS + ", phrase string, part string").repartition(4)
    return sorted(tuple(r[c] for c in COLUMNS) for r in pm.phrase_mining(df, **options).collect())


def test_against_brute_force(spark):
    got = run(spark, corpus(), least=5)
    assert got == brute_force(corpus(), 5) and len(got) > 100
    assert len({lang for lang, *_ in got}) >= 3


def test_limits_and_small_slices(spark, monkeypatch):
    assert run(spark, corpus(), least=12, share=50, limit=7) == brute_force(corpus(), 12, 50, 7)


def test_full_filter_changes_nothing(spark, monkeypatch):
    """A filter that lets everything through only costs time."""
    monkeypatch.setattr(pm, "phrase_filter", lambda phrases, n_words: np.full(64, np.uint64(0xFFFFFFFFFFFFFFFF)))
    assert run(spark, corpus(), least=5) == brute_force(corpus(), 5)


def test_filter_holds_every_phrase(spark):
    rows = [("en", f"w{k} x{k % 7}") for k in range(3000)]
    cells = pm.phrase_filter(spark.createDataFrame(rows, "lang string, phrase string").repartition(5), 2)
    phrases = pa.array([f"w{k} x{k % 7}" for k in range(6000)])
    found = pm._all_set(cells, pm.phrase_hashes(pa.array(["en"] * 6000), phrases, 2))
    assert found[:3000].all() and found[3000:].mean() < 0.05


def test_every_prefix_hot(spark, monkeypatch):
    """Dealing stripes out over parts changes nothing."""
    monkeypatch.setattr(pm, "hot_prefixes", lambda phrases, n_words, total: pm.phrase_hashes(*(c.combine_chunks() for c in phrases.select("lang", "phrase").toArrow().columns), n_words))
    assert run(spark, corpus(), least=5) == brute_force(corpus(), 5)


def test_large_counts_are_exact(spark):
    """Counts whose products pass 64 bits."""
    a = 5 * 10**18
    phrases = spark.createDataFrame([("en", "x", 1, a), ("en", "y", 1, a + 7), ("en", "z", 1, a), ("en", "x y", 2, a - 1), ("en", "x y z", 3, a // 5 * 4 - 1), ("en", "y z", 2, a)], "lang string, phrase string, n_words int, f long")
    left = pm._not_subsumed(phrases, 80)
    assert {r.phrase for r in left.collect()} == {"x y", "y z", "x y z"}
    got = {r.phrase: r.score for r in pm._scored(left, phrases).collect()}
    assert got["x y"] == 2000000 * (a - 1) // (2 * a + 7) and got["y z"] == 2000000 * a // (2 * a + 7)


def test_empty(spark, no_documents):
    assert pm.phrase_mining(no_documents).count() == 0
    assert run(spark, [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " .\n", "en", "a", 0)], least=1) == []
