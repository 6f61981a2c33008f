"""Plan checks: no Python evaluation anywhere; filters reach the scans."""

import re

import pytest

from cohortgrid.operators import verdicts as vd
from cohortgrid.plans import registry as rg
from cohortgrid.plans.oracle import oracle_sql
from cohortgrid.plans.registry import queries
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(queries()))
def test_no_python_in_plan(spark, key):
    plan = _plan(queries()[key](spark, SF_SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF", plan)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def test_scans_read_only_what_a_query_needs(spark):
    plan = _plan(queries()["date_envelope"](spark, SF_SMALL))
    assert re.search(r"ReadSchema: struct<c_custkey:bigint>", plan) and "c_name" not in plan
    plan = _plan(queries()["cohort_resolve"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*Not\(EqualTo\(c_mktsegment,AUTOMOBILE\)\)", plan)


def test_replies_are_parsed_once(spark):
    replies = rg.inputs(spark, SF_SMALL).llm_outputs
    parsed = _plan(vd.merge_verdicts(vd.parse_llm_outputs(replies)))
    assert parsed.count("from_json") == 3, "one for each reply column"
    for key in ("observation_date_strict", "enrollment_rollup", "positive_only", "entry_dedup"):
        assert "from_json" not in _plan(queries()[key](spark, SF_SMALL)), key
    assert _plan(queries()["bucket_pre_baseline"](spark, SF_SMALL)).count("from_json") == 1


def test_observations_are_hash_aggregated(spark):
    plan = _plan(queries()["bucket_rollup"](spark, SF_SMALL))
    below = plan[plan.rindex("SortAggregate") :] if "SortAggregate" in plan else plan
    assert "HashAggregate" in below, "only the counted rows are sorted"
    assert not re.search(r"SortAggregate\([^)]*note_id", plan)


@pytest.mark.parametrize("key", ["first_mention_anchor", "enrollment_rollup", "bucket_rollup", "provider_attribution", "entry_dedup"])
def test_per_patient_aggregates_combine_map_side(spark, key):
    """Hot patients: every per-key aggregate runs a partial aggregate before
    its shuffle, so one key's rows are combined before they move."""
    plan = _plan(queries()[key](spark, SF_SMALL))
    assert re.search(r"(Hash|Sort|ObjectHash)Aggregate\(keys?=\[[^\]]*\], functions=\[partial_", plan)
    assert "Window" not in plan


def test_no_cross_or_nested_loop_joins(spark):
    for key, fn in queries().items():
        plan = _plan(fn(spark, SF_SMALL))
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan), key


@pytest.mark.parametrize("key", ["dedup_rows", "mention_notes", "baseline_notes"])
def test_texts_are_not_shuffled(spark, key):
    """Late materialisation: chosen and repeated rows are found by narrow
    columns, and the scan of the texts meets broadcasts only."""
    df = queries()[key](spark, SF_SMALL)
    df.collect()
    lines = _plan(df).split("\n")
    for line, child in zip(lines, lines[1:]):
        if re.search(r"Exchange \w+partitioning", line):
            assert not re.search(r"\btext#|note_text", line + child), line + child
    assert not any("SortAggregate" in line or "SortMergeJoin" in line for line in lines)


def test_requests_shuffle_ids_before_texts(spark):
    from cohortgrid.operators import requests as rq
    from cohortgrid.sources import fixtures as fx
    from cohortgrid.sources.tables import Tables

    notes = fx.clinical_notes(Tables(spark, SF_SMALL))
    given = fx.note_responses(notes)
    ledger = rq.open_requests(rq.request_ledger(notes, given), given)
    assert ledger.columns == ["note_id", "stage", "request_id"] or set(ledger.columns) == {"note_id", "stage", "request_id"}
    for node in re.findall(r"Exchange[^\n]*", _plan(ledger)):
        assert "note_text" not in node
