import hashlib
import re
import zlib

import corpus_pipeline as cp
import pytest
from llm.test_ngram_join import brute_force as families

from cohortgrid.llm.queries import oracle_sql, queries
from llm.conftest import DOCUMENTS, odd_rows

SMALL = "/root/testdata/sf0.001"


def fold(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_stage_keeps_one_row_of_each_text(spark, odd):
    got = cp.exact_copies(spark, odd, SMALL).collect()
    assert sorted(fold(r["text"]) for r in got) == sorted({fold(r[1]) for r in odd_rows()})


def test_the_row_that_stays_does_not_hang_on_the_order(spark):
    rows = [(1, "one text for all", lang, source, n) for lang in ("en", "de", None) for source in ("a", None) for n in (1, 2, None)]
    kept = {tuple(cp.exact_copies(spark, spark.createDataFrame(rows[k:] + rows[:k], DOCUMENTS).repartition(3), SMALL).first()) for k in (0, 5, 11)}
    assert len(kept) == 1


def test_near_stage_keeps_one_row_of_each_family(spark, odd):
    kept = [(r["doc_id"], r["text"]) for r in cp.near_copies(spark, odd, SMALL).collect()]
    _, groups = families([(r[0], r[1]) for r in odd_rows()])
    # Rows that agree in id and text are one row of the stage, also the two without id or words.
    assert len(kept) == groups
    assert len({k for k in kept if k[0] is not None}) == len([k for k in kept if k[0] is not None])


def test_near_stage_tells_texts_of_one_checksum_apart(spark):
    seen, pair = {}, None
    for k in range(400_000):
        text = hashlib.md5(str(k).encode()).hexdigest()
        if (other := seen.setdefault(zlib.crc32(text.encode()), text)) != text:
            pair = (other, text)
            break
    for doc_id in (None, 7):
        docs = spark.createDataFrame([(doc_id, t, "en", "a", 1) for t in pair], DOCUMENTS)
        assert {r["text"] for r in cp.near_copies(spark, docs, SMALL).collect()} == set(pair)


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stages_on_empty_and_odd_tables(spark, odd, no_documents, name):
    stage = dict(cp.STAGES)[name]
    assert stage(spark, no_documents, SMALL).count() == 0
    out = stage(spark, odd, SMALL)
    rows = out.count()
    if name == "mix":  # small sources repeat often: their rows grow, not the corpus' size
        assert {r["doc_id"] for r in out.collect()} <= {r[0] for r in odd_rows()}
    else:
        assert rows == len(odd_rows()) if name == "tokens" else rows <= len(odd_rows())
    if name != cp.STAGES[-1][0]:
        assert out.columns == cp.COLUMNS


def test_run_follows_the_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in cp.STAGES:
        rows = stage(spark, docs, SMALL).collect()
        docs = spark.createDataFrame(rows, stage(spark, docs, SMALL).schema) if rows else docs.limit(0)
    want = sorted((r["doc_id"], r["n_tokens"], tuple(r["ids"])) for r in rows)
    got = sorted((r["doc_id"], r["n_tokens"], tuple(r["ids"])) for r in cp.run(spark, SMALL).collect())
    assert got == want and got


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_queries_equal_their_sql(spark, key):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    df = queries()[key](spark, SMALL)
    want = con.sql(oracle_sql()[key])
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted((tuple(r[k] for k in at) for r in want.fetchall()), key=str)


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries()) == list(range(1, 14))
