import os
import tempfile

from cohortgrid.plans import registry as rg
from cohortgrid.plans.stages import write_study
from conftest import SF_SMALL


def test_write_study(spark):
    out = tempfile.mkdtemp(prefix="cg-study-")
    paths = write_study(rg.inputs(spark, SF_SMALL), out, rg.PATTERN, rg.MENTION, rg.BASELINE)
    assert sorted(paths) == sorted(os.listdir(out))
    m6 = spark.read.parquet(paths["stage6_matrix"])
    assert {"mrn", "variable", "note_author", "correct_enrollment_date", "-12_months", "36_months"} <= set(m6.columns)
    summary = m6.filter("mrn = 'SUMMARY'").select("variable").collect()
    assert sorted(r["variable"] for r in summary) == ["diarrhea", "epic_med", "refill"]
    m2 = spark.read.parquet(paths["stage2_matrix"])
    assert m2.filter("mrn = 'SUMMARY'").count() == 1
    patients = [{r["mrn"] for r in spark.read.parquet(paths[f"stage{k}_matrix"]).select("mrn").collect()} for k in (2, 4, 5, 6)]
    assert patients[0] == patients[1] == patients[2] == patients[3] and len(patients[0]) > 1


def test_rollup_before_date_filter_option(spark):
    from pyspark.sql import functions as F

    from cohortgrid.plans.stages import reply_observations

    i = rg.inputs(spark, SF_SMALL)
    strict = reply_observations(i.llm_outputs)
    loose = reply_observations(i.llm_outputs, rollup_before_date_filter=True)
    # the option can only add patients (start dates from undated replies)
    s = {r["mrn"] for r in strict.select("mrn").distinct().collect()}
    lo = {r["mrn"] for r in loose.select("mrn").distinct().collect()}
    assert s <= lo
    assert loose.filter(F.col("note_time").isNull()).count() == 0


def test_from_wide_round_trip(spark):
    from cohortgrid.operators import matrix as mx
    from cohortgrid.plans import stages

    i = rg.inputs(spark, SF_SMALL)
    m = stages.stage2_long(i)
    shown = mx.present_matrix(mx.to_wide(m))
    back = mx.from_wide(shown)
    assert back.spec.buckets == m.spec.buckets
    a = sorted(map(tuple, back.cells.filter("cell is not null").select("mrn", "time_bucket", "cell").collect()))
    b = sorted(map(tuple, m.cells.filter("cell is not null").select("mrn", "time_bucket", "cell").collect()))
    assert a == b
