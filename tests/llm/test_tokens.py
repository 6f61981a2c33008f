import random
import shutil
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark import TaskContext, cloudpickle
from tokenizers import Tokenizer

from cohortgrid.llm.pfor import Segment, encode_segment, pack, unpack
from cohortgrid.llm.recent import Recent
from cohortgrid.llm.token_counts import Counter, token_counts
from cohortgrid.llm.token_files import Encoder, KnownPieces, read_token_files, read_tokens, write_token_files
from llm.conftest import odd_rows

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "\x0b", "\x1c", " ", " ", "\x85", "é", "é", "İ", "K", "'s", "'ll", "’s", "1", "23", "½", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "...", "!?", "«", "a.", "<", "漢字", "😀", "‍", "aaaa", "----", "Σ", "ς", "<|", " '", "\u0085 ", "\r\n"]


def fuzz():
    r = random.Random(5)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 30))) for _ in range(1500)] + ["", "   ", " a", "a ", "a" * 5000, "ab" * 3000, "-" * 777, " " * 300 + "x"]


def test_counts_equal_the_library():
    texts = fuzz()
    want = [len(e.ids) for e in Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert Counter(BYTES)(texts) == want


def test_ids_equal_the_library():
    texts = fuzz()
    want = [e.ids for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in Encoder(WORDS)([t.encode() for t in texts])] == want


@pytest.mark.parametrize("width", range(1, 33))
def test_packing_round_trip(width):
    values = np.random.default_rng(width).integers(0, 1 << width, (3, 256), dtype=np.uint64).astype(np.uint32)
    packed = pack(values, width)
    assert packed.shape == (3, width * 32) and (unpack(packed, width) == values).all()


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_segment_round_trip(n):
    tokens = (np.random.default_rng(n).zipf(1.3, n) % (1 << 32)).astype(np.uint32)
    tokens[: n // 3] = 7
    s = Segment(encode_segment([None, 5], np.array([n // 2, n - n // 2]), tokens, 11))
    assert (s.tokens() == tokens).all() and s.start == 11 and s.lengths.sum() == n and s.no_id.tolist() == [True, False]
    assert (s.tokens(n // 3, n // 2) == tokens[n // 3 : n // 2]).all()


def test_token_files(spark, odd, no_documents, tmp_path):
    write_token_files(odd, WORDS, f"{tmp_path}/t")
    library = Tokenizer.from_file(WORDS)
    spread = {r["text"]: r["h"] for r in odd.selectExpr("coalesce(text, '') as text", "xxhash64(coalesce(text, '')) as h").collect()}
    rows = sorted(((r[0], r[1] or "") for r in odd_rows()), key=lambda r: (r[0] is not None, r[0] or 0, spread[r[1]]))
    want, start = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in read_token_files(spark, f"{tmp_path}/t").collect()), key=lambda r: r[1])
    assert got == want
    assert sorted(len(r["tokens"]) for r in read_tokens(spark, f"{tmp_path}/t").collect()) == sorted(w[2] for w in want)
    write_token_files(no_documents, WORDS, f"{tmp_path}/none")
    assert read_token_files(spark, f"{tmp_path}/none").count() == 0


def test_small_table_of_pieces_starts_over():
    encoder, texts = Encoder(WORDS), fuzz()
    encoder.known = KnownPieces(40)
    library = Tokenizer.from_file(WORDS)
    for lo in range(0, 300, 7):
        some = texts[lo : lo + 7]
        want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder([t.encode() for t in some])] == want


def test_hot_id_is_split(spark, tmp_path):
    """A third of all rows under one id, and as many without one."""
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"word{k} and {k * k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_token_files(df, WORDS, f"{tmp_path}/hot")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = spark.read.parquet(f"{tmp_path}/hot").groupBy("shard").agg({"n_tokens": "sum"}).collect()
    assert len(shards) == 8 and max(r[1] for r in shards) < 2 * sum(r[1] for r in shards) / 8
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in read_token_files(spark, f"{tmp_path}/hot").collect())
    assert all(a[0] + a[1] == b[0] for a, b in zip(got, got[1:])) and got[0][0] == 0
    ids = [-1 if r[2] is None else r[2] for r in got]
    assert ids == sorted(ids) and ids.count(7) == 1000


def test_token_counts(odd, no_documents):
    library = Tokenizer.from_file(BYTES)
    texts = [(r[0], r[1] or "") for r in odd_rows()]
    want = sorted(((i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 512) for i, t in texts), key=str)
    assert sorted((tuple(r) for r in token_counts(odd, BYTES).collect()), key=str) == want
    assert token_counts(no_documents, BYTES).count() == 0


def test_recent_results_move_back():
    table = Recent(2)
    for k in range(10):
        for key in table.missing([k, 0]):
            table.young[key] = key
        assert {k, 0} <= table.young.keys() and len(table.young) + len(table.old) <= 8


def test_slices_are_small_and_slots_stay():
    """The arrays of a slice are many times its bytes, and several workers
    share an executor's memory."""
    from cohortgrid.llm import token_files

    assert token_files.SLICE <= 1 << 20
    table, r = KnownPieces(), np.random.default_rng(3)
    keys, checks = r.integers(0, 1 << 63, 9000, dtype=np.uint64), r.integers(0, 1 << 63, 9000, dtype=np.uint64)
    slots = np.concatenate([table.add(keys[k : k + 900], checks[k : k + 900], [[i, i] for i in range(k, k + 900)]) for k in range(0, 9000, 900)])
    found, known = table.find(keys, checks)
    assert known.all() and (found == slots).all() and (table.pool[table.entries[1][found]] == np.arange(9000)).all()
    assert not table.find(keys, checks + np.uint64(1))[1].any()


def test_known_pieces_are_bounded_by_their_ids():
    """Long pieces, each met once: few of them, but many ids."""
    encoder, r = Encoder(WORDS), random.Random(7)
    encoder.known = KnownPieces(most_ids=20_000)
    library = Tokenizer.from_file(WORDS)
    for _ in range(40):
        texts = ["often " + "".join(r.choice("abcdefghijklmnop0123456789") for _ in range(3000)) for _ in range(3)]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder([t.encode() for t in texts])] == want
    assert encoder.known.used < 40_000 and len(encoder.known.pool) < 80_000


def test_pieces_found_again_outlast_the_others():
    table, r = KnownPieces(1000), np.random.default_rng(4)
    often = r.integers(0, 1 << 63, 50, dtype=np.uint64)
    table.add(often, often + np.uint64(1), [[k] * (k % 4) for k in range(50)])
    for _ in range(30):
        rare = r.integers(0, 1 << 63, 300, dtype=np.uint64)
        assert table.find(often, often + np.uint64(1))[1].all()
        table.make_room(300)
        slots = table.add(rare, rare, [[9]] * 300)
        assert len(table.keys) <= 1000 and (table.pool[table.entries[1][slots]] == 9).all()
    slot, known = table.find(often, often + np.uint64(1))
    starts, sizes = table.entries[1][slot], table.entries[2][slot]
    assert known.all() and [table.pool[a : a + n].tolist() for a, n in zip(starts, sizes)] == [[k] * (k % 4) for k in range(50)]


def test_a_worker_gets_small_batches(spark, tmp_path, monkeypatch):
    """Rows of 20 KB: 2 MB at once, not ten thousand rows."""
    from cohortgrid.llm import token_files

    def sizes(path, end_id):
        def run(batches):
            for b in batches:
                yield pa.record_batch([pa.array([0], pa.int32()), pa.array([0], pa.int32()), pa.array([b.nbytes], pa.int64()), pa.array([b""], pa.binary())], ["shard", "seq", "n_tokens", "payload"])

        return run

    monkeypatch.setattr(token_files, "_segments", sizes)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    write_token_files(spark.range(600).selectExpr("id as doc_id", "repeat('abcde ', 3500) as text"), WORDS, f"{tmp_path}/t")
    got = spark.read.parquet(f"{tmp_path}/t").agg({"n_tokens": "max"}).first()[0]
    assert got < 4 << 20 and spark.conf.get(key) == before


def test_tasks_of_a_worker_share_the_encoder(tmp_path, monkeypatch):
    """Each task unpickles its function anew; the encoders of earlier tasks
    used to stay in memory beside the new one."""
    from cohortgrid.llm import token_files

    built, init = [], Encoder.__init__
    monkeypatch.setattr(Encoder, "__init__", lambda self, path: built.append(path) or init(self, path))
    monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: SimpleNamespace(partitionId=lambda: 3)))
    path = shutil.copy(WORDS, f"{tmp_path}/words.json")
    sent = cloudpickle.dumps(token_files._segments(path, 2))
    batch = pa.record_batch([pa.array([5, 6]), pa.array(["one two", None])], ["id", "text"])
    for _ in range(3):
        (row,) = cloudpickle.loads(sent)(iter([batch]))
        assert row.to_pylist()[0]["shard"] == 3 and Segment(row.to_pylist()[0]["payload"]).ids.tolist() == [5, 6]
    assert built == [path]
