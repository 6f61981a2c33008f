import math
import random
import re

import numpy as np
import pytest

from cohortgrid.llm import lexical_search as ls
from llm.conftest import DOCUMENTS, odd_rows, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, k=20):
    held = [(r[0], terms(r[1])) for r in docs]
    held = [(i, t) for i, t in held if t]
    n, length, df = len(held), sum(len(t) for _, t in held), {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, t in held:
            m = 75 + 25 * len(t) * n // length
            score = 0
            for x in terms(text):
                tf = t.count(x)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(x, 0) + 1))) * (1000000000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=str)


def corpus():
    r = random.Random(5)
    rows = [(200 + k, " ".join([prose(40 + k % 17, 25), *r.choices(["Aa", "bb", "cc9", "é漢", "x_y"], k=k % 9)]), "en", "a", 0) for k in range(300)]
    rows += [(600 + k, prose(41, 25), "en", "a", 0) for k in range(150)]  # many copies: ties
    return odd_rows() + rows


def questions():
    return [(1, prose(41, 12)), (2, "the the aa BB cc9 é漢 nowhere"), (3, None), (4, "..."), (None, "words to share"), (5, prose(1, 60)), (5, "One two"), (6, "x y")]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in corpus()], DOCUMENTS + ", terms string, rank int").repartition(5)
    return docs, spark.createDataFrame([(*q, "x") for q in questions()], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("block_chars", [1 << 20, 60])
def test_ranking(tables, monkeypatch, block_chars):
    got = ls.lexical_search(*tables, block_chars=block_chars)
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()), key=str) == brute_force(corpus(), questions())


def test_few_results(tables):
    got = ls.lexical_search(*tables, k=3)
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()), key=str) == brute_force(corpus(), questions(), 3)


def test_empty(tables, no_documents):
    assert ls.lexical_search(no_documents, tables[1]).count() == 0
    assert ls.lexical_search(tables[0], tables[1].limit(0)).count() == 0


def random_tree(seed, n, leaf):
    r = np.random.default_rng(seed)
    vectors = [np.sort(r.choice(12, r.integers(1, 8), replace=False)) for _ in range(n // 2)]
    vectors += [vectors[0]] * (n - len(vectors))
    ptr = np.cumsum([0, *map(len, vectors)])
    rank = np.concatenate(vectors).astype(np.int64)
    tf, m = r.integers(1, 9, len(rank)), r.integers(75, 400, n)
    return ls.build_tree(ptr, rank, tf, m, np.arange(n), leaf), (ptr, rank, tf, m)


@pytest.mark.parametrize("leaf", [1, 4, 64])
def test_bounds_hold_and_search_agrees(leaf):
    tree, (ptr, rank, tf, m) = random_tree(3, 400, leaf)
    parts = ls.score_part(tf, np.repeat(m, np.diff(ptr)))
    weight = np.array([0, 5, 0, 90, 7, 0, 1200, 3, 0, 44, 0, 9])
    scores = np.add.reduceat(weight[rank] * parts, ptr[:-1])
    # Every node's bound covers the documents of its subtree.
    bound = np.array([(weight[tree.node_term[a:b]] * tree.node_part[a:b]).sum() for a, b in zip(tree.node_ptr, tree.node_ptr[1:])])
    order = np.argsort(tree.doc_id)
    node = np.repeat(np.arange(len(bound)), np.diff(tree.held))[order]
    for doc in range(400):
        at = node[doc]
        while at > 0:
            assert bound[at] >= scores[doc]
            at = np.searchsorted(tree.child, at, "right") - 1
    best = ls.Best(10)
    opened = ls.search(tree, weight, best)
    expected = sorted((-s, i) for i, s in enumerate(scores) if s > 0)[:10]
    assert list(zip(-best.score, best.id)) == expected
    assert opened <= len(bound)


def test_branches_are_left_out():
    """One document holds the rare term: the other branches stay closed."""
    n = 2000
    ptr = np.arange(n + 1) * 2
    rank = np.stack([np.arange(n) % 50, 50 + np.arange(n) % 40], 1).ravel()
    rank[1] = 95
    tree = ls.build_tree(ptr, rank.astype(np.int64), np.ones(2 * n, np.int64), np.full(n, 100), np.arange(n), 4)
    weight = np.zeros(96, np.int64)
    weight[95], weight[:50] = 9000, 1
    best = ls.Best(1)
    opened = ls.search(tree, weight, best)
    assert list(best.id) == [0] and opened < 10 < len(tree.child)


def test_terms():
    text = "AB-c_d é漢字 x\u0085y 12 \x00 ÀB{z}"
    assert [t.decode() for t in ls.terms_of(text)] == terms(text)
