import random

import pytest

import cohortgrid.llm.ngram_join as nj
from cohortgrid.llm.components import connected_components
from llm.conftest import DOCUMENTS, odd_rows, prose


def brute_force(rows):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, text in rows:
        w = (text or "").translate(lower).replace("\x0b", " ").replace("\x0c", " ")
        w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                label[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least.setdefault(find(k), []).append(doc_id)
    name = {c: min((i for i in ids if i is not None), default=None) for c, ids in least.items()}
    return [(rows[k][0], len(sets[k]), name[find(k)]) for k in range(len(rows))], len(name)


def check(df, rows):
    want, groups = brute_force(rows)
    got = nj.ngram_jaccard_join(df).collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(want, key=str)
    assert sum(r["kept"] for r in got) == groups


def family_rows():
    """Families of near copies that drift, and a passage that all share."""
    r, rows, shared = random.Random(4), [], prose(77, 60)
    for family in range(6):
        words = prose(10 + family, 80).split()
        for _ in range(40):
            words = list(words)
            for _ in range(r.randint(0, 2)):
                words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1000, " ".join(words) + (" " + shared if family % 2 else "")))
    rows += [(2000 + k, prose(500 + k, 30) + " " + shared) for k in range(90)]
    r.shuffle(rows)
    return rows


def test_odd_rows(odd):
    check(odd, [(r[0], r[1]) for r in odd_rows()])


def test_empty_table(no_documents):
    assert nj.ngram_jaccard_join(no_documents).count() == 0


@pytest.mark.parametrize("block", [1024, 16])
def test_families(spark, monkeypatch, block):
    monkeypatch.setattr(nj, "BLOCK_DOCS", block)  # 16 splits the clusters, with leaders and questions across blocks
    rows = family_rows()
    check(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS).repartition(3), rows)


def link_counts(rows):
    sets = [set(zip(*(w[k:] for k in range(5)), strict=False)) for w in ((t or "").lower().split() for _, t in rows)]
    return [sum(a != b and 100 * len(x & y) >= 80 * len(x | y) for b, y in enumerate(sets)) for a, x in enumerate(sets)]


@pytest.mark.parametrize("block", [1024, 16])
def test_links_are_counted(spark, monkeypatch, block):
    """A chain and a clique differ in links; copies count with their rows."""
    monkeypatch.setattr(nj, "BLOCK_DOCS", block)
    rows = family_rows()
    rows = [(k, t) for k, (_, t) in enumerate(rows + rows[::9] + rows[::9])]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS).repartition(3)
    got = {r["doc_id"]: r["n_links"] for r in nj.ngram_jaccard_join(df).collect()}
    want = link_counts(rows)
    assert [got[k] for k in range(len(rows))] == want and len(set(want)) > 5


def test_common_counts():
    """By matrix products and by pairs, equal to set intersections."""
    import numpy as np

    r = np.random.default_rng(3)
    left, right = ([np.unique(r.integers(0, 60, 30) if k % 2 else r.integers(0, 5000, 80)).astype(np.uint64) for k in range(n)] for n in (90, 70))
    assert (nj.common_counts(left, right) == [[len(np.intersect1d(a, b)) for b in right] for a in left]).all()


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(5, 5), (None, 3)]
    label = {k: k for e in edges for k in e if None not in e and e[0] != e[1]}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if None not in (a, b) and a != b:
                low = min(label[a], label[b])
                changed |= label[a] != low or label[b] != low
                label[a] = label[b] = low
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {row["node"]: row["component"] for row in got} == label and len(got) == len(label)
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
