import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortgrid.llm import quality_classifier, toxicity
from cohortgrid.llm.logistic import fit, fit_values, predict, sigmoid
from llm.conftest import DOCUMENTS, odd_rows, prose

LABELS = "doc_id long, quality int, toxic int"


def corpus():
    """Junk of three kinds; insults by two word stems of one's own."""
    r, docs, labels = random.Random(8), [], []
    for k in range(900):
        words = prose(1000 + k, r.randint(30, 80)).split()
        junk, toxic = k % 5 == 0, k % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["zorb", "quax"]) + r.choice(["a", "en", "ish"]))
        if junk:
            words = [[w.upper() + "!!", w + "%%%", w + " |"][k // 5 % 3] for w in words]
        docs.append((k, " ".join(words), "en", f"s{k % 7}", len(words)))
        labels.append((k, int(not junk), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, DOCUMENTS), spark.createDataFrame(labels, LABELS), labels


def test_logistic_regression_finds_its_coefficients():
    r = np.random.default_rng(0)
    x = r.standard_normal((4000, 3))
    y = (r.random(4000) < sigmoid(x @ [2, -1, 0] + 0.5)).astype(float)
    assert np.abs(fit(x, y) - [2, -1, 0, 0.5]).max() < 0.2
    assert (fit(np.zeros((0, 2)), np.zeros(0), prior=np.array([1.0, 2, 3])) == [1, 2, 3]).all()
    assert predict(np.array([1.0, 2]), np.array([[3.0]])) == [5]


def test_fit_of_values_equals_the_dense_fit():
    r = np.random.default_rng(1)
    at = np.c_[r.integers(0, 4, 900), 4 + r.integers(0, 30, 900)]
    dense = np.zeros((900, 34))
    dense[np.arange(900)[:, None], at] = 1
    y = (r.random(900) < sigmoid(at[:, 0] - 1.5 + (at[:, 1] % 3))).astype(float)
    assert np.abs(fit_values(at, y, 34) - fit(dense, y)).max() < 1e-3
    assert (fit_values(np.zeros((0, 2), np.int64), np.zeros(0), 0) == [0]).all()


def test_many_sources_keep_apart():
    """A weight for each value, however many there are."""
    values = quality_classifier.metadata_values([[f"site{k}" for k in range(5000)] * 4])
    label = np.array([k % 2 for k in range(5000)] * 4)
    model = quality_classifier.ValueModel.fitted(values, label)
    assert ((model.logits(values) > 0) == label).all()
    assert model.logits(quality_classifier.metadata_values([["unseen"]]))[0] == model.weights[-1]


def feature_rows(n):
    """Rows whose sureness grows with their number."""
    r = np.random.default_rng(3)
    return [(k, [float(k)] + [0.0] * (len(quality_classifier.TEXT_FEATURES) - 1), [int(r.integers(0, 50)), k % 9]) for k in range(n)]


def brute_force_surest(rows, model, given, sure, per_round):
    """The whole pool in memory."""
    key, text, meta = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    out = {}
    for other, logits in zip((1, 0), model.views(text, meta), strict=True):
        for value, p in ((1, sigmoid(logits)), (0, 1 - sigmoid(logits))):
            able = [(-c, k) for c, k in zip(p.tolist(), key.tolist(), strict=True) if c >= sure and k not in given[other]]
            out[other, value] = [k for _, k in sorted(able)[:per_round]]
    return {k: v for k, v in out.items() if v}


def test_surest_rows_of_a_pool_beyond_20000(spark):
    """The deciding rows are the last of 30,000; ties go by key."""
    rows = feature_rows(30_000)
    n = len(quality_classifier.TEXT_FEATURES)
    text = np.r_[0.001, np.zeros(n - 1), -12.0]
    values = quality_classifier.ValueModel(np.arange(50), np.r_[np.linspace(-4, 4, 50), 0.0, 0.0])
    model = quality_classifier.Model(np.zeros(n), np.ones(n), text, values, np.zeros(3), 0.5)
    pool = spark.createDataFrame(rows, "key long, text array<double>, meta array<long>").repartition(6)
    for given in ([np.zeros(0, np.int64)] * 2, [np.arange(29_900, 29_990), np.arange(29_950, 30_000)]):
        for per_round in (7, 400):
            got = quality_classifier.surest_rows(pool, model, given, 0.95, per_round)
            assert {(o, v): k.tolist() for o, k, _, _, v in got} == brute_force_surest(rows, model, [set(g.tolist()) for g in given], 0.95, per_round)
            assert all(t[:, 0].tolist() == [float(k) for k in keys] for _, keys, t, _, _ in got)
    assert 29_999 in quality_classifier.surest_rows(pool, model, [np.zeros(0, np.int64)] * 2, 0.95, 7)[0][1]


def test_training_equals_brute_force(spark, tables):
    """The model of the distributed rounds is that of a pool in memory."""
    docs, labels, _ = tables
    some = labels.filter("doc_id < 300")
    got = quality_classifier.train(docs, some, rounds=3, sure=0.8, per_round=40)
    real, seen = quality_classifier.surest_rows, []

    def in_memory(pool, model, given, sure, per_round):
        rows = [(r.key, r.text, r.meta) for r in pool.collect()]
        by_key = {r[0]: r for r in rows}
        found = brute_force_surest(rows, model, [set(g.tolist()) for g in given], sure, per_round)
        seen.append(sum(map(len, found.values())))
        return [(o, np.array(ks), np.array([by_key[k][1] for k in ks]), np.array([by_key[k][2] for k in ks]), v) for (o, v), ks in found.items()]

    quality_classifier.surest_rows = in_memory
    try:
        want = quality_classifier.train(docs, some, rounds=3, sure=0.8, per_round=40)
    finally:
        quality_classifier.surest_rows = real
    assert len(seen) == 3 and min(seen) > 0
    assert np.allclose(got.text, want.text) and np.allclose(got.meta.weights, want.meta.weights) and np.allclose(got.joint, want.joint)


def test_quality_on_rows_without_labels(tables):
    docs, labels, truth = tables
    model = quality_classifier.train(docs, labels.filter("doc_id % 2 = 0"))
    got = {r["doc_id"]: r["accepted"] for r in quality_classifier.score(docs, model).collect()}
    held = [(got[k], q) for k, q, _ in truth if k % 2]
    assert sum(a == bool(q) for a, q in held) / len(held) > 0.95
    assert all(got[k] for k, q, _ in truth if q)  # clean documents stay


def test_quality_of_odd_rows(spark, odd, no_documents, tables):
    docs, labels, _ = tables
    model = quality_classifier.train(docs, labels)
    keep = ("doc_id", "text", "id", "row", "ids")
    rows = quality_classifier.score(odd, model, keep_cols=keep).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in rows), key=str) == sorted(((r[0], r[1]) for r in odd_rows()), key=str)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert quality_classifier.score(no_documents, model).count() == 0
    none = spark.createDataFrame([], LABELS)
    for table in (docs, no_documents, odd):
        unlabelled = quality_classifier.train(table, none)
        assert all(r["accepted"] for r in quality_classifier.score(odd, unlabelled).collect())


def test_training_reads_one_row_of_each_id(spark, tables, monkeypatch):
    docs, labels, _ = tables
    many = spark.range(400).selectExpr("4L as doc_id", "concat('zorba ', id, ' text') as text", "'en' as lang", "'s' as source", "id as n_chars")
    for module, name in ((quality_classifier, "co_train"), (toxicity, "fit")):
        seen, real = [], getattr(module, name)
        monkeypatch.setattr(module, name, lambda x, *a, seen=seen, real=real, **b: seen.append(len(x)) or real(x, *a, **b))
        args = (lambda id_: F.lit(True),) if module is toxicity else ()
        module.train(docs.union(many), labels, *args)
        assert seen == [900]


def test_grammar_marks_targets_negation_and_reports():
    lexicon = toxicity.Lexicon({"idiot": 1.0})

    def events(text):
        x = lexicon.features([text])[0]
        return {e for e, v in zip(toxicity.EVENTS, x, strict=False) if v > 0}

    assert events("what an Idiot.") == {(1, 0, 0, 0)}
    assert events("you are idiots") == {(1, 1, 0, 0)}
    assert events("an idiot like you.") == {(1, 1, 0, 0)}
    assert events("an idiot. Like you.") == {(1, 0, 0, 0)}
    assert events("he is not an idiot") == {(1, 1, 1, 0)}
    assert events("they said idiot; an idiot") == {(1, 1, 0, 1), (1, 0, 0, 0)}
    assert events("I will kill you") == {(2, 1, 0, 0)}
    assert events("a clean text about you") == set()
    assert lexicon.features(["", "x"]).sum() == 0


def test_grammar_reads_hits_inside_a_piece():
    lexicon = toxicity.Lexicon({"idiot": 1.0, "stupid": 1.0})
    for text, event in (("you-idiot", (1, 1, 0, 0)), ("not/stupid", (1, 0, 1, 0)), ('said:"kill', (2, 0, 0, 1))):
        x = lexicon.features([text])[0]
        assert {e for e, v in zip(toxicity.EVENTS, x, strict=False) if v > 0} == {event}


def brute_force_score(text, stems, coefficients):
    """Clause by clause: every hit with all words that could reach it."""
    groups = {"threat": toxicity.THREATS, "target": toxicity.TARGETS, "negation": toxicity.NEGATIONS, "report": toxicity.REPORTS}
    clauses = [[]]
    for piece in (text or "").lower().replace("\n", " | ").split():
        found = re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)?", piece)
        marks = []
        for word in (w.replace("’", "'") for w in found):
            weights = [w for stem, w in stems.items() if word.startswith(stem)]
            kind = "insult" if weights else next((k for k, ws in groups.items() if word in ws), None)
            if kind:
                marks.append((kind, max(weights, default=1.0)))
        ends = not found or re.search(r"[.,;:!?|)\]]\W*$", piece)
        clauses[-1] += marks or ([] if ends else [("other", 0.0)])
        if ends:
            clauses.append([])
    totals, largest = dict.fromkeys(toxicity.EVENTS, 0.0), 0.0
    for clause in clauses:
        kinds, weight = [k for k, _ in clause], 0.0
        for i, (kind, w) in enumerate(clause):
            if kind in ("insult", "threat"):
                near = kinds[max(0, i - toxicity.SCOPE) : i]
                targeted, negated, reported = "target" in near or "target" in kinds[i + 1 :], "negation" in near, "report" in kinds[:i]
                totals[1 if kind == "insult" else 2, int(targeted), int(negated), int(reported)] += w
                weight += w * (0.5 if negated else 1) * (0.5 if reported else 1)
        largest = max(largest, weight)
    z = coefficients[-1] + coefficients[-2] * np.log1p(largest) + sum(c * np.log1p(v) for c, v in zip(coefficients, totals.values()))
    return 1 / (1 + np.exp(-z))


def test_toxicity_equals_brute_force(spark, tables):
    docs, labels, _ = tables
    model = toxicity.train(docs, labels, lambda id_: id_ % 3 != 1)
    r = random.Random(12)
    some = [*toxicity.INSULTS[:4], *toxicity.THREATS[:3], *toxicity.TARGETS[:5], *toxicity.NEGATIONS[:6], *toxicity.REPORTS[:3], "zorba", "quaxish", "and", "the", "é", "12", "--", "isn’t"]
    texts = [" ".join(r.choice(some) + r.choice(["", "", "", ".", ",", "!)", "\n", "/" + r.choice(some)]) for _ in range(r.randint(0, 40))) for _ in range(400)]
    rows = [(k, t, "en", "a", 0) for k, t in enumerate(texts)] + odd_rows() + corpus()[0][:200]
    got = toxicity.score(spark.createDataFrame(rows, DOCUMENTS), model).collect()
    want = [brute_force_score(r[1], model.lexicon.stems, model.coefficients) for r in rows]
    assert len(got) == len(rows) and np.allclose([g["score"] for g in got], want)
    assert [g["predicted"] for g in got] == [int(w >= 0.7) for w in want]


def test_toxicity_on_held_out_rows(tables):
    docs, labels, truth = tables
    model = toxicity.train(docs, labels, lambda id_: id_ % 3 != 1)
    assert {"zorb", "quax"} <= set(model.lexicon.stems)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [(got[k]["predicted"], t) for k, _, t in truth if k % 3 == 1]
    assert sum(p == t for p, t in held) / len(held) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_of_odd_rows(spark, odd, no_documents):
    model = toxicity.train(odd, spark.createDataFrame([], LABELS), lambda id_: F.lit(True))
    rows = toxicity.score(odd, model).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in odd_rows()) and not any(r["predicted"] for r in rows)
    assert toxicity.score(no_documents, model).count() == 0
