import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from cohortgrid.llm.source_mix import inverted, mix_sources, poisson_cdfs, repetition_rates, source_sizes
from llm.conftest import CLASHING, DOCUMENTS, odd_rows, prose


def poisson(u, rate):
    k, term = 0, math.exp(-rate)
    total = term
    while total <= u and rate > 0:
        k += 1
        term *= rate / k
        total += term
    return k


def brute_force(rows, weights, seed=0):
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1] or "")
    listed = [s for s in size if s in weights and size[s] > 0]
    all_size, all_weight = sum(size[s] for s in listed), sum(weights[s] for s in listed)
    out = Counter()
    for r in rows:
        rate = weights[r[3]] / all_weight * all_size / size[r[3]] if r[3] in listed and all_weight else 1.0
        digest = hashlib.md5((r[1] or "").encode()).hexdigest()
        name = digest if r[0] is None else f"{r[0]}:{digest}"
        u = int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:13], 16) / (1 << 52)
        for copy in range(1, poisson(u, rate) + 1):
            out[(r[0], r[1], r[3], copy)] += 1
    return out


def test_copies_of_odd_rows(spark, odd, no_documents):
    weights = {"a": 1.0, "b": 30.0, "c": 0.0, "absent": 9.0}
    targets = spark.createDataFrame(list(weights.items()), "source string, weight double")
    got = mix_sources(odd, targets)
    assert got.columns == [c for c in odd.columns if c != "mix_copy"] + ["mix_copy"] and set(CLASHING) <= set(got.columns)
    assert Counter((r["doc_id"], r["text"], r["source"], r["mix_copy"]) for r in got.collect()) == brute_force(odd_rows(), weights)
    assert mix_sources(no_documents, targets).count() == 0
    assert mix_sources(odd, targets.limit(0)).count() == sum(brute_force(odd_rows(), {}).values())


def test_mixed_sizes_follow_the_weights(spark):
    rows = [(k, prose(k % 50, 20), "en", "big" if k % 5 else "small", 0) for k in range(3000)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    targets = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    rates = {r["source"]: r["rate"] for r in repetition_rates(source_sizes(df), targets).collect()}
    got = mix_sources(df, targets).collect()
    size = Counter()
    for r in got:
        size[r["source"]] += len(r["text"])
    assert abs(size["small"] / sum(size.values()) - 0.75) < 0.03
    assert rates["small"] > 3 and rates["big"] < 0.5
    ids = [r["doc_id"] for r in got]
    assert sum(a < b for a, b in zip(ids, ids[1:])) / len(ids) < 0.6  # no longer in order


def test_rows_of_one_id_draw_apart(spark):
    """Different texts, a third of them under one id: the sum holds."""
    rows = [(5 if k % 3 == 0 else k, f"text {k}", "en", "ab"[k % 2], 0) for k in range(3000)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    targets = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double")
    for seed in range(3):
        assert abs(mix_sources(df, targets, seed=seed).count() / 3000 - 1) < 0.05


def test_large_rates_in_linear_time(spark):
    import time

    def seconds(rate):
        start = time.perf_counter()
        table = poisson_cdfs(spark.createDataFrame([("a", float(rate))], "source string, rate double"))
        rows = table.select(*(inverted("cdf", "marks", F.lit(u)).alias(f"k{i}") for i, u in enumerate((0.001, 0.5, 0.975, 1 - 2**-50)))).collect()
        return time.perf_counter() - start, list(rows[0])

    assert seconds(3)[1][:2] == [0, poisson(0.5, 3)]
    _, low = seconds(4_000)
    took, high = seconds(64_000)
    assert took < 8
    for rate, (least, middle, upper, most) in ((4_000, low), (64_000, high)):
        assert abs(least - rate + 3.09 * rate**0.5) < 3 and abs(middle - rate) < 2 and abs(upper - rate - 1.96 * rate**0.5) < 3 and most < rate + 10 * rate**0.5


def test_search_by_blocks(spark):
    for rate in (0.0, 0.3, 1.0, 25.0, 700.0):
        table = poisson_cdfs(spark.createDataFrame([("a", rate)], "source string, rate double"))
        us = [k / 97 for k in range(97)]
        got = table.select(*(inverted("cdf", "marks", F.lit(u)).alias(f"k{i}") for i, u in enumerate(us))).first()
        assert list(got) == [poisson(u, rate) if rate else 0 + (u >= 1.0) for u in us]
