"""Hand-written sentences, not those of the fixtures, with what they say."""

import pytest

from cohortgrid.operators import rules as ru
from cohortgrid.operators.verdicts import enrollment_gate

S, P, E, D, A, N, G = "confirmed_start", "planned_only", "confirmed_end", "denied", "ambiguous", "no_mention", "deceased_or_ineligible"

# text, status, start, start date, end, end date
NOTES = [
    ("She began trofinetide on March 4, 2024.", S, True, "3/4/24", False, None),
    ("On 3/4/24 we started Daybue.", S, True, "3/4/24", False, None),
    ("Patient has not yet started Daybue.", P, False, None, False, None),
    ("She has never started trofinetide.", P, False, None, False, None),
    ("Hasn't started Daybue because of cost.", P, False, None, False, None),
    ("Parents want to hold off on Daybue until spring.", P, False, None, False, None),
    ("We are holding off on starting trofinetide.", P, False, None, False, None),
    ("Daybue start postponed.", P, False, None, False, None),
    ("Planning to start Daybue after the visit.", P, False, None, False, None),
    ("Will be starting Daybue 4/1/24.", P, False, None, False, None),
    ("Considering starting trofinetide next year.", P, False, None, False, None),
    ("Once approved, she may begin Daybue.", P, False, None, False, None),
    ("Discussed Daybue with the family.", P, False, None, False, None),
    ("Prior authorization for Daybue was submitted.", P, False, None, False, None),
    ("Awaiting Daybue shipment.", P, False, None, False, None),
    ("Currently on Daybue 40 mL b.i.d. and doing well.", S, True, None, False, None),
    ("She is taking her trofinetide with food.", S, True, None, False, None),
    ("Tolerating Daybue.", S, True, None, False, None),
    ("Daybue dose increased to 50 mL.", S, True, None, False, None),
    ("We continue to titrate Daybue slowly.", S, True, None, False, None),
    ("Continues Daybue since 5/6/24.", S, True, "5/6/24", False, None),
    ("More alert since starting Daybue in Feb 2024.", S, True, "2/1/24", False, None),
    ("Not sleeping well since starting Daybue.", S, True, None, False, None),
    ("Has not stopped Daybue.", S, True, None, False, None),
    ("Discussed risks, then started Daybue on 7/8/24.", S, True, "7/8/24", False, None),
    ("Daybue was discontinued on 6/1/24.", E, False, None, True, "6/1/24"),
    ("No longer on trofinetide.", E, False, None, True, None),
    ("Family stopped Daybue due to vomiting in June 2024.", E, False, None, True, "6/1/24"),
    ("She was weaned off Daybue.", E, False, None, True, None),
    ("Started Daybue 2/1/24; stopped 5/1/24.", S, True, "2/1/24", True, "5/1/24"),
    ("Started Daybue in May 2024 but quit it on 6/2/24.", S, True, "5/1/24", True, "6/2/24"),
    ("On 1/2/24 started Daybue, however on 3/4/24 discontinued.", S, True, "1/2/24", True, "3/4/24"),
    ("Daybue will be stopped if diarrhea persists.", P, False, None, False, None),
    ("Insurance rejected Daybue.", D, False, None, False, None),
    ("Daybue not covered by her plan.", D, False, None, False, None),
    ("Insurance denied Daybue. Appeal won, she started Daybue 9/9/24.", S, True, "9/9/24", False, None),
    ("Daybue request denied. Plan to appeal.", D, False, None, False, None),
    ("Mother denies side effects while on Daybue.", S, True, None, False, None),
    ("Her brother started Daybue.", A, False, None, False, None),
    ("Another patient on Daybue was in clinic.", A, False, None, False, None),
    ("Family history: cousin takes trofinetide.", A, False, None, False, None),
    ("Daybue 3.5 mg on the list of questions.", A, False, None, False, None),
    ("Asked about Daybue by Dr. Lee.", A, False, None, False, None),
    ("Keppra was started. Daybue was mentioned.", A, False, None, False, None),
    ("Keppra was started on 1/1/24.", N, False, None, False, None),
    ("No drug at all.", N, False, None, False, None),
    ("", N, False, None, False, None),
    (None, N, False, None, False, None),
    ("The patient died on 5/5/24. She was on Daybue.", G, True, None, False, None),
    ("Transitioned to hospice.", G, False, None, False, None),
    ("Grandmother passed away.", N, False, None, False, None),
    ("No prolonged hospitalization so far.", N, False, None, False, None),
    ("Started Daybue 0.5 mL on 2/15/24. Seen by Dr. Smith.", S, True, "2/15/24", False, None),
    ("1. Start Daybue\n2. Labs", P, False, None, False, None),
    ("Seen 12/5/2023, tolerating trofinetide.", S, True, None, False, None),
]

MENTIONS = [
    ("Diarrhea today.", True),
    ("No diarrhea.", False),
    ("Denies loose stools or fever.", False),
    ("Without any diarrhea since Monday, but loose stool today.", True),
    ("Call if diarrhea starts.", False),
    ("Risk of diarrhea was discussed.", False),
    ("Her sister has chronic diarrhea.", False),
    ("Had a single episode of diarrhea.", False),
    ("Vomiting, not diarrhea; however watery stool overnight.", True),
    ("Diarrheal illness persists.", True),
    ("Not eating. Diarrhea again.", True),
    ("May develop diarrhea", False),
]


@pytest.fixture(scope="module")
def records(spark):
    df = spark.createDataFrame([(i, n[0]) for i, n in enumerate(NOTES)], "i int, note_text string")
    return {r.i: r for r in ru.enrollment_record(df).collect()}


@pytest.mark.parametrize("i", range(len(NOTES)))
def test_note(records, i):
    r = records[i]
    assert (r.enrollment_status, r.confirmed_start, r.confirmed_start_date, r.confirmed_end, r.confirmed_end_date) == NOTES[i][1:], NOTES[i][0]
    if r.evidence_text is not None:
        assert r.evidence_text in NOTES[i][0], "evidence is verbatim"
    assert (r.evidence_text is None) == (r.enrollment_status == N)


def test_mentions(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(MENTIONS)], "i int, t string")
    got = {r.i: bool(r.m) for r in df.select("i", ru.mentions(df.t).alias("m")).collect()}
    assert got == {i: said for i, (_, said) in enumerate(MENTIONS)}


def test_records_feed_the_gate(spark):
    rows = [
        ("a", "Started Daybue on 3/4/24."),
        ("a", "Started Daybue on 2/1/24. Discontinued Daybue 9/1/24."),
        ("b", "Has not started Daybue."),
        ("c", "Started Daybue on 1/1/24."),
        ("c", "The patient died."),
        ("d", "On Daybue."),
        ("e", None),
    ]
    rollup = ru.enrollment_from_notes(spark.createDataFrame(rows, "patient_id string, note_text string"))
    got = {r.mrn: r.enrolled for r in rollup.collect()}
    assert got == {"a": True, "b": False, "c": False, "d": True, "e": False}
    gate = [(r.mrn, str(r.enrollment_start_date), str(r.enrollment_end_date)) for r in enrollment_gate(rollup).collect()]
    assert gate == [("a", "2024-02-01", "2024-09-01")]


def test_episodes(spark):
    import datetime as dt

    day = dt.date(2024, 1, 1)
    at = {"p": [0, 0, 10, 40, 71, 72, 200], "q": [5], "r": [None]}
    rows = [(k, None if d is None else day + dt.timedelta(days=d)) for k, ds in at.items() for d in ds]
    got = ru.mention_episodes(spark.createDataFrame(rows, "patient_id string, mention_date date")).collect()
    by = {(r.patient_id, (r.mention_date - day).days): (r.episode, r.episode_dates, r.episodes, r.mention_dates) for r in got}
    assert by == {("p", 0): (1, 3, 3, 6), ("p", 10): (1, 3, 3, 6), ("p", 40): (1, 3, 3, 6), ("p", 71): (2, 2, 3, 6), ("p", 72): (2, 2, 3, 6), ("p", 200): (3, 1, 3, 6), ("q", 5): (1, 1, 1, 1)}


def test_chronic_entries(spark):
    import datetime as dt

    rows = [
        ("p1", "n1", "Chronic diarrhea for the past 3 months.", dt.date(2023, 1, 1)),
        ("p2", "n2", "Diarrhea today. Mood ok.", dt.date(2023, 1, 1)),
        ("p2", "n3", "Loose stool in diaper on 3/1/23.", dt.date(2023, 6, 1)),
        ("p3", "n4", "Diarrhea.", dt.date(2023, 1, 1)),
        ("p3", "n5", "Diarrhea again.", dt.date(2023, 1, 9)),
        ("p4", "n6", "Diarrhea once. No fever.", dt.date(2023, 1, 1)),
        ("p5", "n7", "No diarrhea.", None),
        ("p6", "n8", "Diarrhea.", None),
    ]
    got = ru.chronic_entries(spark.createDataFrame(rows, "patient_id string, note_id string, note_text string, contact_date date")).collect()
    by = {r.note_id: (r.evidence_text, r.time, r.time_description, r.severity_level, r.episode, r.chronicity_indicator) for r in got}
    assert by == {
        "n1": ("Chronic diarrhea for the past 3 months.", None, "for the past 3 months", "N/A", 1, "chronic"),
        "n2": ("Diarrhea today.", None, None, "N/A", 1, "recurrent"),
        "n3": ("Loose stool in diaper on 3/1/23.", "3/1/23", None, "1", 2, "recurrent"),
        "n4": ("Diarrhea.", None, None, "N/A", 1, "persistent"),
        "n5": ("Diarrhea again.", None, None, "N/A", 1, "persistent"),
        "n6": ("Diarrhea once.", None, None, "N/A", 1, None),
        "n8": ("Diarrhea.", None, None, "N/A", None, None),
    }


def test_hot_patient_keeps_days_only(spark):
    """A third of all notes under one patient: the window holds days."""
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 500 as string)) as patient_id", "date_add(date'2020-01-01', cast(id % 400 as int)) as mention_date")
    got = ru.mention_episodes(df).filter("patient_id = 'hot'")
    assert got.count() == 400 and got.select("episode").distinct().count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.rindex("HashAggregate")
