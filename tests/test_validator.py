from cohortgrid.operators.validator import validate_entries

NOTE = (
    "Seen by Dr. Lee on 1/2/24. Loose stool in diaper on February 15, 2024, per mother.\n"
    "No diarrhea last week. Her sister had diarrhea.\n"
    "Hand use much better. Watery stool\ton clothes, twice."
)
ENTRY = "array<struct<phenotype:string,present:string,severity_level:string,time:string,evidence_text:string>>"


def entry(quote, time=None, severity="N/A", present="Yes", phenotype="Diarrhea"):
    return (phenotype, present, severity, time, quote)


CASES = [
    (entry("Loose stool in diaper on February 15, 2024", "2/15/24", "1"), "keep", []),
    (entry("loose stool in diaper on february 15 2024", "2/15/24", "1"), "remove", ["duplicate"]),
    (entry("watery stool on clothes", "2/15/24", "1"), "fix", ["quote", "severity", "date"]),
    (entry("Watery stool\ton clothes, twice", None, "3"), "remove", ["duplicate"]),
    (entry("No diarrhea last week."), "remove", ["not_supported"]),
    (entry("Her sister had diarrhea."), "remove", ["not_supported"]),
    (entry("explosive diarrhea"), "remove", ["quote_not_found"]),
    (entry(None), "remove", ["quote_not_found"]),
    (entry("Loose stool in diaper", present="No"), "remove", ["not_positive"]),
    (entry("Loose stool in diaper", present=None), "remove", ["not_positive"]),
    (entry("Loose stool in diaper", "Feb 15, 2024", "1", " yes ", "Loose Stool"), "fix", ["severity", "date_format"]),
    (entry("Hand use much better", "1/2/24", "low", phenotype="Hand use"), "fix", ["severity", "date"]),
    (entry("Hand use much better", None, "low", phenotype="Improved hand use"), "remove", ["not_supported"]),
    (entry("Hand use much better", "soon", "N/A", phenotype="hand use"), "remove", ["duplicate"]),
]


def run(spark, replies, notes):
    r = spark.createDataFrame(replies, f"note_id string, entries {ENTRY}")
    n = spark.createDataFrame(notes, "note_id string, note_text string")
    return {x.note_id: x for x in validate_entries(r, n).collect()}


def test_outcomes(spark):
    got = run(spark, [("n", [c[0] for c in CASES])], [("n", NOTE), ("m", "unused")])["n"]
    assert [(o.pos, o.action, o.reasons) for o in got.outcomes] == [(i, a, r) for i, (_, a, r) in enumerate(CASES)]
    assert [tuple(e) for e in got.validated] == [
        ("Diarrhea", "Yes", "1", "2/15/24", "Loose stool in diaper on February 15, 2024"),
        ("Diarrhea", "Yes", "3", None, "Watery stool\ton clothes"),
        ("Loose Stool", "Yes", "N/A", "2/15/24", "Loose stool in diaper"),
        ("Hand use", "Yes", "N/A", None, "Hand use much better"),
    ]
    assert all(e.evidence_text in NOTE for e in got.validated)


def test_missing_notes_and_entries(spark):
    got = run(spark, [("a", [entry("x")]), ("b", [entry("x")]), ("c", []), ("d", None), ("a2", [entry("Diarrhea", "1/1/24", "2")])], [("a", None), ("c", NOTE), ("d", NOTE), ("a2", "Diarrhea 1/1/24.")])
    assert [o.reasons for o in got["a"].outcomes] == [o.reasons for o in got["b"].outcomes] == [["quote_not_found"]]
    assert got["c"].validated == [] and got["c"].outcomes == []
    assert got["d"].validated is None and got["d"].outcomes is None
    assert [tuple(e) for e in got["a2"].validated] == [("Diarrhea", "Yes", "N/A", "1/1/24", "Diarrhea")]


def test_improvement_level(spark):
    note = "Improved hand use, dramatically so."
    got = run(spark, [("n", [entry("improved hand use, dramatically", None, "low", phenotype="Improved hand use")])], [("n", note)])["n"]
    assert [tuple(e) for e in got.validated] == [("Improved hand use", "Yes", "high", None, "Improved hand use, dramatically")]


def test_nothing_is_exploded(spark):
    r = spark.createDataFrame([("n", [entry("x")])], f"note_id string, entries {ENTRY}")
    n = spark.createDataFrame([("n", "x")], "note_id string, note_text string")
    plan = validate_entries(r, n)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Aggregate(" not in plan.replace("HashAggregate(keys=[note_id", "")


def test_partitions_are_not_merged_by_bytes(spark):
    """A note takes milliseconds, so a few tasks must not hold all of them."""
    notes = spark.createDataFrame([(str(k), NOTE) for k in range(64)], "note_id string, note_text string").coalesce(1)
    replies = spark.createDataFrame([(str(k), [entry("Loose stool")]) for k in range(64)], f"note_id string, entries {ENTRY}").coalesce(1)
    done = validate_entries(replies, notes).select("note_id", "outcomes")
    assert done.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert done.count() == 64
