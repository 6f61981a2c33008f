import hashlib
import re

import cohortgrid.llm.exact_dedup as ed
from llm.conftest import odd_rows


def brute_force(rows):
    fold = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(fold(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        first = known[0] if known else None
        seen = False
        for i in ids:
            kept, seen = (i == first and not seen), seen or i == first
            out.append((i, first, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_odd_rows_and_forced_recursion(odd):
    want = order(brute_force([(r[0], r[1]) for r in odd_rows()]))
    assert order(ed.exact_dedup(odd).collect()) == want
    # Buckets of 1 byte are split as far as their texts differ; a table of 1 byte folds no copies.
    assert order(ed.exact_dedup(odd, bucket_bytes=1, table_bytes=1).collect()) == want


def test_empty_table(no_documents):
    assert ed.exact_dedup(no_documents).count() == 0


def test_equal_digests_of_other_contents_stay_apart():
    table = ed.ContentTable()
    same = b"d" * 32
    assert [table.owner(same, c, k) for k, c in enumerate([b"a", b"b", b"a"])] == [0, 1, 0]
    for k in range(5000):
        table.owner(hashlib.sha256(str(k).encode()).digest(), str(k).encode(), 10 + k)
    assert table.owner(hashlib.sha256(b"77").digest(), b"77", 9999) == 87
