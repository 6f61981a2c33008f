"""The request ledger and late-materialised notes."""

import datetime as dt

from cohortgrid.operators import notes as nt
from cohortgrid.operators import requests as rq

NOTES = "note_id string, note_text string"
ANSWERS = "note_id string, stage string, request_id string, response string"
STAGES = {"summarizer": "Sum up.", "extractor": "Extract.", "validator": "Validate."}


def ids(spark, notes, answers=(), headers=STAGES):
    n, a = spark.createDataFrame(notes, NOTES), spark.createDataFrame(list(answers), ANSWERS)
    return {(r.note_id, r.stage): r.request_id for r in rq.request_ledger(n, a, headers).collect()}


def still_open(spark, notes, answers, headers=STAGES):
    n, a = spark.createDataFrame(notes, NOTES), spark.createDataFrame(list(answers), ANSWERS)
    return sorted((r.note_id, r.stage) for r in rq.requests(n, a, headers).collect())


def test_ids_change_with_what_is_asked(spark):
    one = ids(spark, [("a", "text"), ("b", "text"), ("c", None)])
    assert set(one) == {(n, s) for n in "ab" for s in ("summarizer", "extractor")}, "a validator waits for an extraction"
    assert one == ids(spark, [("a", "text"), ("b", "text")])
    changed = ids(spark, [("a", "text."), ("b", "text")])
    assert changed["a", "extractor"] != one["a", "extractor"] and changed["b", "extractor"] == one["b", "extractor"]
    told = ids(spark, [("a", "text")], headers={**STAGES, "extractor": "Extract all."})
    assert told["a", "extractor"] != one["a", "extractor"] and told["a", "summarizer"] == one["a", "summarizer"]
    first = ids(spark, [("a", "text")], [("a", "extractor", "x", "[1]")])
    second = ids(spark, [("a", "text")], [("a", "extractor", "x", "[2]")])
    assert first["a", "validator"] != second["a", "validator"]


def test_changed_notes_are_asked_again(spark):
    notes = [("a", "Daybue text"), ("b", "other")]
    known = ids(spark, notes)
    answers = [(n, s, i, "{}") for (n, s), i in known.items()]
    assert still_open(spark, notes, answers) == [("a", "validator"), ("b", "validator")]
    known = ids(spark, notes, answers)
    answers = [(n, s, i, "{}") for (n, s), i in known.items()]
    assert still_open(spark, notes, answers) == []
    assert still_open(spark, [("a", "Daybue text!"), ("b", "other")], answers) == [("a", "extractor"), ("a", "summarizer"), ("a", "validator")]
    assert still_open(spark, notes, answers, {**STAGES, "summarizer": "Sum up well."}) == [("a", "summarizer"), ("b", "summarizer")]
    assert still_open(spark, notes, [(*a[:3], None) if a[1] == "summarizer" else a for a in answers]) == [("a", "summarizer"), ("b", "summarizer")]


def test_texts_of_requests(spark):
    n = spark.createDataFrame([("a", "Mood ok. Started Daybue. End.")], NOTES)
    a = spark.createDataFrame([("a", "extractor", "[1]")], "note_id string, stage string, response string")
    got = {r.stage: r.request_text for r in rq.requests(n, a, {**STAGES, "extractor": "Extract."}).collect()}
    assert got == {"summarizer": "Sum up.\n\nMood ok. Started Daybue. End.", "validator": "Validate.\n\nORIGINAL_NOTE:\nMood ok. Started Daybue. End.\n\nEXTRACTION:\n[1]"}


def test_dedup_of_files_and_of_other_rows(spark, tmp_path):
    rows = [("p", "t1", 1), ("p", "t1", 1), ("p", "t2", 1), ("p", None, 1), ("p", None, 1), (None, "t1", 1), (None, "t1", 1)] + [("q", "hot", 2)] * 500
    df = spark.createDataFrame(rows, "pid string, note_text string, k int")
    df.repartition(7).write.parquet(f"{tmp_path}/d")
    files = spark.read.parquet(f"{tmp_path}/d")
    assert nt.with_position(df) is None and nt.with_position(files) is not None
    want = sorted(set(rows), key=str)
    for source in (df, files, files.select("note_text", "pid", "k").filter("k > 0")):
        out = nt.dedup_rows(source)
        assert out.columns == source.columns
        assert sorted((tuple(r[c] for c in df.columns) for r in out.collect()), key=str) == want


def test_baseline_notes_of_files(spark, tmp_path):
    day = dt.date(2023, 6, 1)
    rows = [(f"p{k % 3}", f"n{k // 2}", f"text {k // 2}", day - dt.timedelta(days=20 * (k // 2)), ["Letter", "Procedures"][k // 2 % 2]) for k in range(80)]
    notes = spark.createDataFrame(rows, "patient_id string, note_id string, note_text string, contact_date date, note_type_ip string")
    notes.repartition(4).write.parquet(f"{tmp_path}/n")
    enrollment = spark.createDataFrame([("m0", "2023-06-01"), ("m1", "2023-01-01"), ("m1", "2023-02-01"), ("m2", "bad")], "mrn string, enrollment_start_date string")
    mapping = spark.createDataFrame([(f"p{k}", f"m{k}") for k in range(3)], "patient_id string, mrn string")
    a = nt.baseline_notes(notes, enrollment, mapping, 365, max_chars=100)
    b = nt.baseline_notes(spark.read.parquet(f"{tmp_path}/n"), enrollment, mapping, 365, max_chars=100)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() > 5
