import datetime as dt
import random

import pytest

from cohortgrid.operators.intervals import LEVELS, interval_join, median_length

DAY = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def table(seed, n, name):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        start = r.choice([None, *[r.randint(-400, 3000) for _ in range(30)]])
        length = r.choice([0, 1, 5, 30, 30, 90, 400, 20_000, -3, None])
        rows.append((r.choice(["hot", "hot", "a", "b", None]), i, day(start), None if start is None or length is None else day(start + length)))
    return rows, f"k string, {name} int, {name}_start date, {name}_end date"


def brute_force(left, right):
    out = []
    for ka, a, s, e in left:
        for kb, b, x, y in right:
            good = lambda s, e: s is not None and (e is None or e >= s)
            if ka is not None and ka == kb and good(s, e) and good(x, y) and (y is None or s <= y) and (e is None or x <= e):
                ends = [v for v in (e, y) if v is not None]
                out.append((ka, a, b, max(s, x), min(ends) if ends else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [None, 1, 7, 100_000])
def test_against_brute_force(spark, width):
    (left, a), (right, b) = table(1, 300, "a"), table(2, 250, "b")
    right += right[:5]
    got = interval_join(spark.createDataFrame(left, a), spark.createDataFrame(right, b), ["k"], ("a_start", "a_end"), ("b_start", "b_end"), width)
    assert got.columns == ["k", "a", "a_start", "a_end", "b", "b_start", "b_end", "overlap_start", "overlap_end"]
    assert sorted(((r.k, r.a, r.b, r.overlap_start, r.overlap_end) for r in got.collect()), key=str) == brute_force(left, right)


def test_median_length(spark):
    df = spark.createDataFrame([(day(0), day(n)) for n in (1, 10, 10, 20, 30)] + [(day(5), None), (day(5), day(1))], "s date, e date")
    assert median_length((df, "s", "e")) == 10
    assert median_length((df.limit(0), "s", "e")) == 1


def test_hot_key_is_dealt_out(spark):
    """A key with all rows: no bin holds more than a few of them."""
    from cohortgrid.operators import intervals

    df = spark.range(20_000).selectExpr("'hot' as k", "date_add(date'2020-01-01', cast(id % 4000 as int)) as s", "date_add(date'2020-01-01', cast(id % 4000 + id % 20 as int)) as e")
    binned = intervals._binned(df, df.s, df.e, 10)
    sizes = binned.filter(f"__own = __level and __level < {LEVELS}").groupBy("__level", "__bin").count().agg({"count": "max"}).first()[0]
    assert sizes < 20_000 / 50
    assert binned.count() <= 20_000 * (2 * LEVELS + 1)


def test_plan_is_an_equi_join(spark):
    df = spark.createDataFrame([("a", day(1), day(2))], "k string, s date, e date")
    plan = interval_join(df, df.toDF("k", "x", "y"), ["k"], ("s", "e"), ("x", "y"), 5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_only_levels_of_the_other_side_are_listed(spark):
    """Short intervals against short ones stand in bins of their own level
    only; a long one on the other side adds its level."""
    from pyspark.sql import functions as F

    from cohortgrid.operators import intervals as iv

    days = [(f"2024-01-{k:02d}", f"2024-01-{k + 1:02d}") for k in range(1, 29)]
    cast = lambda rows, s, e: spark.createDataFrame([("p", *r) for r in rows], f"k string, {s} string, {e} string")

    def counts(df, others):
        side = (df, F.col("s").cast("date"), F.col("e").cast("date"), 2)
        return {r["__level"] for r in iv._binned(*side, others).collect()}, iv._own_levels(*side)

    short = cast(days, "s", "e")
    assert counts(short, {0}) == ({0}, {0}) and counts(short, {iv.LEVELS}) == ({0, iv.LEVELS}, {0})
    mixed = cast([*days, ("2020-01-01", "2024-01-03"), ("2024-01-05", None)], "t", "u")
    pairs = iv.interval_join(short, mixed, ["k"], ("s", "e"), ("t", "u"), width=2)
    want = sum(1 for a in days for b in [*days, ("2020-01-01", "2024-01-03"), ("2024-01-05", None)] if (b[1] is None or a[0] <= b[1]) and b[0] <= a[1])
    assert pairs.count() == want
    assert "Broadcast" not in pairs._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("dense", [0, 40, 10_000])
def test_dense_keys_against_brute_force(spark, dense):
    """No, some and all keys joined whole: 40 lies between the rows of ``hot``
    and those of the other keys."""
    (left, a), (right, b) = table(3, 150, "a"), table(4, 160, "b")
    sizes = {k: max(sum(r[0] == k for r in side) for side in (left, right)) for k in "a b hot".split()}
    assert max(sizes["a"], sizes["b"]) <= 40 < sizes["hot"]
    sides = spark.createDataFrame(left, a), spark.createDataFrame(right, b)
    got = interval_join(*sides, ["k"], ("a_start", "a_end"), ("b_start", "b_end"), dense=dense)
    assert sorted(((r.k, r.a, r.b, r.overlap_start, r.overlap_end) for r in got.collect()), key=str) == brute_force(left, right)
    assert got.columns == ["k", "a", "a_start", "a_end", "b", "b_start", "b_end", "overlap_start", "overlap_end"]
    assert ("__bin" in got._jdf.queryExecution().optimizedPlan().toString()) == (dense < 10_000)


def test_overlaps_of_all_administration_days(spark, tmp_path):
    """Every day of the month opens a span, the last one an open span, a null
    day none; pairs counted by hand, and the SQL's rows are the same."""
    import duckdb

    from cohortgrid.plans.oracle import oracle_sql
    from cohortgrid.plans.registry import queries

    tables = {
        "part": ([(1, "p", "b", "t")], "p_partkey long, p_name string, p_brand string, p_type string"),
        "orders": ([(1, 7, "O", "2020-01-01"), (2, 7, "P", "2020-01-10")], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string"),
        "lineitem": (
            [(1, 1, 3.0, "2020-01-02"), (1, 1, 1.0, "2020-01-07"), (2, 1, 5.0, "2020-01-20"), (2, 1, 2.0, None)],
            "l_orderkey long, l_partkey long, l_quantity double, l_shipdate string",
        ),
    }
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        days = {c: df[c].cast("timestamp") for c in df.columns if c.endswith("date")}
        (df.withColumns(days) if days else df).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    got = queries()["interval_overlaps"](spark, str(tmp_path))
    found = [tuple(str(v) for v in r) for r in got.select("mrn", "pairs", "days", "open_pairs", "first_overlap").collect()]
    assert found == [("7", "7", "54", "1", "2020-01-02")]
    sql = con.execute(f"select mrn, pairs, days, open_pairs, first_overlap from ({oracle_sql()['interval_overlaps']})").fetchall()
    assert [tuple(map(str, r)) for r in sql] == found
