from pyspark.sql import functions as F

from cohortgrid.operators import extraction as ex
from cohortgrid.operators import rules as ru


def col(spark, expr, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r["r"] for r in df.select(expr.alias("r")).collect()]


def test_passage(spark):
    got = col(spark, ex.passage("s"), ["Seen today. Started Daybue last week! Mood ok.", "Nothing here.", None])
    assert got == ["Started Daybue last week!", "No Daybue-related information found", None]


def test_severity_and_intensity(spark):
    texts = ["loose stool in diaper", "watery stool in diaper", "watery stool on clothes", "watery stool outside clothes", "fine"]
    assert col(spark, ru.severity_level("s"), texts) == ["1", "2", "3", "4", "N/A"]
    assert col(spark, ru.intensity("s"), ["much better now", "improved", "slight change", "same"]) == ["high", "moderate", "low", "N/A"]


def test_status(spark):
    cases = [
        ("Started Daybue on 3/1/24. Daybue was discontinued in June 2024.", "confirmed_start", True, "3/1/24", True, "6/1/24", "high"),
        ("Will start Daybue next month.", "planned_only", False, None, False, None, "low"),
        ("She is planning on starting Daybue next month.", "planned_only", False, None, False, None, "low"),
        ("Insurance denied trofinetide.", "denied", False, None, False, None, "low"),
        ("Daybue was mentioned. Patient denied pain.", "ambiguous", False, None, False, None, "low"),
        ("Keppra dose increased. Daybue was mentioned.", "ambiguous", False, None, False, None, "low"),
        ("Tolerating Daybue well.", "confirmed_start", True, None, False, None, "medium"),
        ("No drug named.", "no_mention", False, None, False, None, "low"),
        ("Patient passed away.", "deceased_or_ineligible", False, None, False, None, "high"),
        (None, "no_mention", False, None, False, None, "low"),
    ]
    df = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "k int, note_text string")
    cols = ["enrollment_status", "confirmed_start", "confirmed_start_date", "confirmed_end", "confirmed_end_date", "confidence"]
    got = [tuple(r[c] for c in cols) for r in ru.enrollment_record(df).orderBy("k").collect()]
    assert got == [c[1:] for c in cases]


def test_rules_look_at_one_sentence(spark):
    texts = ["Watery eyes. Diaper changed.", "Watery stool in diaper. Clothes clean."]
    assert col(spark, ru.severity_level("s"), texts) == ["N/A", "2"]


def test_dates(spark):
    assert col(spark, ex.normalize_date("s"), ["Feb 2024", "February 15, 2024", "12/5/2023", "2/15/24", "soon"]) == [
        "2/1/24", "2/15/24", "12/5/23", "2/15/24", None
    ]
    df = spark.createDataFrame([("Seen February 15, 2024 and 12/5/2023.",)], "t string")
    r = df.select(ex.grounded_date(F.lit("2/15/24"), "t").alias("a"), ex.grounded_date(F.lit("1/1/24"), "t").alias("b")).collect()[0]
    assert (r["a"], r["b"]) == ("2/15/24", None)


def test_quote_grounding_and_relative_time(spark):
    df = spark.createDataFrame([("Mother: loose stool, in diaper!", "LOOSE STOOL IN DIAPER", "watery")], "t string, q string, x string")
    r = df.select(ex.grounded_quote("q", "t").alias("a"), ex.grounded_quote("x", "t").alias("b")).collect()[0]
    assert (r["a"], r["b"]) == (True, False)
    assert col(spark, ex.relative_time("s"), ["diarrhea for the past 3 months", "none"]) == ["for the past 3 months", None]


def test_chronicity(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [
            ("p1", "Chronic diarrhea noted.", dt.date(2023, 1, 1)),
            ("p2", "Diarrhea today.", dt.date(2023, 1, 1)),
            ("p2", "Diarrhea again.", dt.date(2023, 2, 1)),
            ("p3", "Had one episode of diarrhea.", dt.date(2023, 1, 1)),
            ("p4", "Diarrhea today.", dt.date(2023, 1, 1)),
            ("p5", "Chronic diarrhea. Call if you develop fever.", dt.date(2023, 1, 1)),
            ("p6", "Diarrhea today. Ongoing therapy.", dt.date(2023, 1, 1)),
        ],
        "patient_id string, note_text string, contact_date date",
    )
    got = {r["patient_id"]: r["qualifies"] for r in ru.chronicity(df).collect()}
    assert got == {"p1": True, "p2": True, "p3": False, "p4": False, "p5": True, "p6": False}
