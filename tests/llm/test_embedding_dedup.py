import numpy as np
import pytest

import cohortgrid.llm.embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, id long, vector string, gid string"


def table():
    r = np.random.default_rng(3)
    centers, rows = r.standard_normal((12, 16)), []
    for k in range(260):
        v = centers[k % 12] + r.standard_normal(16) * (0.05 + 0.3 * (k % 3))
        rows.append((1000 - k, v.astype(np.float32).tolist()))
    rows += [(5000 + k, rows[0][1]) for k in range(30)]  # a hot vector
    rows += [(7, None), (8, []), (9, [0.0] * 16), (10, [float("nan")] * 16), (11, [1.0, None]), (12, [float("inf")] + [1.0] * 15)]
    rows += [(13, [3.0, 4.0]), (14, [6.0, 8.0]), (15, [1e38, 1e38]), (None, [3.0, 4.1]), (None, None), (16, [5.0]), (16, [5.0]), (17, [-5.0])]
    return rows


def brute_force(rows, cosine=0.9):
    ok = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float) / np.abs(v).max()) / np.abs(v).max() if ok(v) else None for _, v in rows]
    label, links = list(range(len(rows))), [0] * len(rows)
    for _ in range(len(rows)):
        before = list(label)
        links = [0] * len(rows)
        for a in range(len(rows)):
            for b in range(a):
                if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                    links[a] += 1
                    links[b] += 1
                    label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    name = {c: min((rows[k][0] for k in range(len(rows)) if label[k] == c and rows[k][0] is not None), default=None) for c in set(label)}
    return sorted(((rows[k][0], links[k], name[label[k]], rows[k][0] == name[label[k]]) for k in range(len(rows))), key=str)


@pytest.mark.parametrize("block", [1024, 8])
def test_links_and_components(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "BLOCK_ROWS", block)
    df = spark.createDataFrame([(i, v, None, 1, "x", "y") for i, v in table()], SCHEMA)
    assert sorted((tuple(r) for r in ed.embedding_dedup(df, recall=0.999999).collect()), key=str) == brute_force(table())


def test_empty_table(spark):
    assert ed.embedding_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_planned_recall():
    for rows in (10, 10**5, 10**9):
        bits, tables = ed.plan_tables(rows, 0.9, 0.999)
        meet = (1 - np.arccos(0.9) / np.pi) ** bits
        assert 1 - (1 - meet) ** tables >= 0.999
