import datetime as dt

from pyspark.sql import functions as F

from cohortgrid.functions.text import clean_llm_json, normalize_verdict
from cohortgrid.operators import verdicts as vd
from cohortgrid.spec import ENROLLMENT_SCHEMA, ENTRY_SCHEMA


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0]["r"]


def test_fence_cases(spark):
    assert one(spark, clean_llm_json("s"), "```json\n[1,\n 2]\n```") == "[1, 2]"
    assert one(spark, clean_llm_json("s"), "x ```json {\"a\":1} ``` y ```json {\"b\":2} ```") == '{"a":1}'
    # fence without a closing fence: empty body, parses to null
    assert one(spark, clean_llm_json("s"), "```json [1]") == ""
    assert one(spark, vd.parse_payload("s", ENTRY_SCHEMA), "```json [1]") is None


def test_payload_shapes(spark):
    p = lambda v: one(spark, vd.parse_payload("s", ENTRY_SCHEMA), v)
    assert p("[]") == []
    assert p("no json here") is None
    obj = p('{"phenotype": "Diarrhea", "severity_level": 3}')
    assert len(obj) == 1 and obj[0]["severity_level"] == "3"
    e = one(spark, vd.parse_payload("s", ENROLLMENT_SCHEMA), '{"confirmed_start": "true", "confidence": "high"}')
    assert e["confirmed_start"] is None and e["confidence"] == "high"


def test_pick_entry_empty_and_match(spark):
    arr = vd.parse_payload("s", ENTRY_SCHEMA)
    assert one(spark, vd.pick_entry(arr), "[]") is None
    v = '[{"phenotype": "Chronic/Recurrent Diarrhea", "present": "Yes"}]'
    assert one(spark, vd.pick_entry(arr), v) is None
    assert one(spark, vd.pick_entry(arr, "diarrhea", "contains"), v)["present"] == "Yes"


def test_normalize_words(spark):
    df = spark.createDataFrame([(w,) for w in [" YES ", "present", "1", "N/A", "none", "absent", "unclear", None]], "s string")
    got = [r["r"] for r in df.select(normalize_verdict("s").alias("r")).collect()]
    assert got == ["Yes", "Yes", "Yes", "No", "No", "No", None, None]


def test_merge_table(spark):
    df = spark.createDataFrame(
        [
            ("Yes", None, "3", None),
            ("Yes", "Yes", "3", "N/A"),
            ("No", "Yes", None, None),
            (None, None, None, None),
            ("No", None, "1", None),
            (None, "No", None, "2"),
        ],
        "extractor_present string, validator_present string, extractor_severity string, validator_severity string",
    )
    got = [(r["diarrhea_present"], r["severity_level"]) for r in vd.merge_verdicts(df).collect()]
    assert got == [("No", "3"), ("Yes", "N/A"), ("Yes", None), (None, None), ("No", "1"), ("No", None)]


def test_model_dates(spark):
    df = spark.createDataFrame([("null",), ("12/5/2023",), ("2/30/24",), ("2/15/24",), ("",), (None,)], "extractor_time string")
    out = vd.observation_date(df)
    assert [r["note_time"] for r in out.collect()] == [dt.date(2024, 2, 15)]


def test_enrollment_gate(spark):
    d = dt.date
    df = spark.createDataFrame(
        [
            ("a", True, "confirmed_start", d(2024, 1, 5), False, None),
            ("a", True, "confirmed_start", d(2023, 12, 1), True, d(2024, 6, 1)),
            ("b", True, "deceased_or_ineligible", d(2024, 1, 1), False, None),
            ("c", None, None, None, None, None),
            ("d", False, None, d(2024, 1, 1), False, None),
        ],
        "mrn string, enroll_confirmed_start boolean, enroll_status string, enroll_start_date_parsed date, "
        "enroll_confirmed_end boolean, enroll_end_date_parsed date",
    )
    r = vd.enrollment_rollup(df)
    gate = {x["mrn"]: (x["enrollment_start_date"], x["enrollment_end_date"]) for x in vd.enrollment_gate(r).collect()}
    assert gate == {"a": (d(2023, 12, 1), d(2024, 6, 1))}
    audit = vd.enrollment_audit(r).collect()[0]
    assert (audit["total"], audit["enrolled"], audit["dropped"]) == (4, 1, 3)


def test_explode_entries(spark):
    from cohortgrid.operators.verdicts import explode_entries
    from cohortgrid.spec import ENTRY_SCHEMA

    one, two = '[{"phenotype": "A"}]', '```json\n[{"phenotype": "B", "time": "1/2/24"}, {"phenotype": "C"}]\n```'
    df = spark.createDataFrame([("n", two, one), ("m", None, two), ("x", "no json", None), ("y", "[]", '{"phenotype": "D"}')], "note_id string, a string, b string")
    got = sorted((r.note_id, r.pos, r.phenotype, r.time) for r in explode_entries(df, ("a", "b"), ENTRY_SCHEMA).collect())
    assert got == [("m", 0, "B", "1/2/24"), ("m", 1, "C", None), ("n", 0, "B", "1/2/24"), ("n", 1, "C", None), ("n", 2, "A", None), ("y", 0, "D", None)]


def test_audits_are_sorted(spark):
    from cohortgrid.operators.matrix import bucket_audit
    from cohortgrid.operators.verdicts import merge_audit

    rows = [(a, b, a) for a in ("Yes", "No", None) for b in ("Yes", None, "No")] * 2
    got = [tuple(r) for r in merge_audit(spark.createDataFrame(rows, "extractor_present string, validator_present string, diarrhea_present string")).collect()]
    assert got == sorted(got, key=lambda r: tuple((x is not None, x) for x in r)) and {r[3] for r in got} == {2}
    df = spark.createDataFrame([(f"{k}_months", s) for k in (12, -6, 6, 0) for s in ("Yes", "No")], "time_bucket_label string, diarrhea_status string")
    assert [tuple(r)[:2] for r in bucket_audit(df).collect()] == [(f"{k}_months", s) for k in (-6, 0, 6, 12) for s in ("No", "Yes")]


def test_contract_counts(spark):
    from cohortgrid.operators.extraction import response_contract

    good = '[{"present": "Yes", "severity_level": "1", "time": "1/2/24"}]'
    bad = '[{"present": "yes", "severity_level": "5", "time": "1/2/2024"}, {"present": null, "severity_level": "N/A", "time": null}]'
    df = spark.createDataFrame([(good, bad), ("no", None), (None, "[]")], "a string, b string")
    got = {r.source: tuple(r)[1:] for r in response_contract(df, ("a", "b")).collect()}
    assert got == {"a": (2, 1, 1, 0, 0, 0), "b": (2, 0, 2, 2, 1, 1)}
    assert response_contract(df.limit(0), ("a", "b")).count() == 0
