"""Fixture views: the driver's star-schema tables shaped as the study inputs.

Each function maps read-only tables to one input of the study (patient list,
id mapping, notes, model replies, medication tables, providers). All are
lazy projections / joins of whole tables, so their size grows with the
data. The DuckDB oracle defines the same views independently in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Tables

# Fixed values of the fixtures (shared with the SQL oracle as plain text).
FENCE_OPEN = "```json\n"
FENCE_CLOSE = "\n```"
NOTE_EPOCH = "2022-06-01"
ENROLLMENT_EPOCH = "2023-06-01"
PAYLOAD_YEARS_AHEAD_MONTHS = 300  # two-digit years: keep dates in 2000-2068
FIXTURE_KEYWORDS = ("license", "copyright")
FIXTURE_PATTERN = r"(?i)(widget|giz\s*mo)"
FIXTURE_MAX_CHARS = 4000

# Hand-written clinical sentences put in front of / behind document text so
# that the word rules have something to find (fixed values).
CLINICAL_PHRASES = (
    "Started Daybue on 2/15/24 and tolerating it well.",
    "Mother reports loose stool in diaper since starting trofinetide.",
    "Watery stool in diaper for the past 3 months, much better this week.",
    "Daybue was stopped due to diarrhea on February 15, 2024.",
    "Will start Daybue next month; prior authorization submitted.",
    "Insurance denied trofinetide.",
    "Chronic diarrhea with watery stool on clothes, workup for malabsorption.",
    "Patient passed away in Feb 2024.",
    "Had one episode of diarrhea after eating, resolved same day.",
    "Call if you develop diarrhea.",
    "Slight improvement in hand use on trofinetide, seen 12/5/2023.",
    "Recurrent diarrhea with watery stool outside clothes, dramatically worse.",
    "Patient has not started Daybue.",
    "Family decided to hold off on Daybue.",
    "Started Daybue 0.5 mL on 2/15/24.",
    "Dose of Daybue is 3.5 mg. Seen by Dr. Smith on 2.15.24 for daybue.",
    "Her cousin started Daybue in Mar 2023.",
    "Patient started Daybue on 3/1/24 but discontinued it in June 2024.",
    "Insurance denied Daybue at first. She has been taking trofinetide since 5/6/24.",
    "Denies diarrhea. No loose stool since starting trofinetide.",
    "Sister had chronic diarrhea.",
    "1. Continue Daybue 20 mL b.i.d. as tolerated.\n2. Call if watery stool on clothes recurs.",
    "Diarrhea today, watery stool in diaper at 5 p.m. after lunch.",
    "Persistent loose stool in diaper for several weeks despite loperamide.",
)


def _s(c: Column) -> Column:
    return c.cast("string")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    """values[index] for an integer column (CASE chain, no lookup join)."""
    out = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        out = out.when(index == i, F.lit(v))
    return out


def patients(t: Tables) -> DataFrame:
    """Patient list: customers outside one market segment."""
    c = t.customer
    return c.filter(F.col("c_mktsegment") != "AUTOMOBILE").select(_s(F.col("c_custkey")).alias("MRN")).distinct()


def mapping(t: Tables) -> DataFrame:
    """patient_id -> mrn; customers in debit get a second patient id."""
    c = t.customer
    first = c.select(
        _s(F.col("c_custkey") + 1000000).alias("patient_id"), _s(F.col("c_custkey")).alias("mrn")
    )
    second = c.filter(F.col("c_acctbal") < 0).select(
        _s(F.col("c_custkey") + 2000000).alias("patient_id"), _s(F.col("c_custkey")).alias("mrn")
    )
    return first.unionByName(second)


def notes(t: Tables) -> DataFrame:
    """Clinical notes: every document, ten consecutive ids per patient."""
    d = t.documents
    doc = F.col("doc_id")
    return d.select(
        _s(F.floor(doc / 10) + 1000000).alias("patient_id"),
        _s(doc).alias("note_id"),
        F.when(doc % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("note_text"),
        F.date_add(F.lit(NOTE_EPOCH).cast("date"), ((doc * 37) % 900).cast("int")).alias("contact_date"),
        _pick(doc % 5, ("Progress Notes", "Telephone Encounter", "H&P", "Letter", "Procedures")).alias(
            "note_type_ip"
        ),
    )


def clinical_notes(t: Tables) -> DataFrame:
    """Notes with clinical sentences around the full document text, each on
    lines of their own."""
    n = notes(t)
    doc = F.col("note_id").cast("long")
    return n.select(
        "patient_id",
        "note_id",
        F.concat_ws(
            "\n",
            _pick(doc % len(CLINICAL_PHRASES), CLINICAL_PHRASES),
            F.col("note_text"),
            _pick(F.floor(doc / len(CLINICAL_PHRASES)) % len(CLINICAL_PHRASES), CLINICAL_PHRASES),
        ).alias("note_text"),
        "contact_date",
        "note_type_ip",
    )


def note_responses(notes: DataFrame) -> DataFrame:
    """Model responses by the notes' own ids: two notes in three have an
    extraction, one in four a validation, one in five an enrollment reply
    (some of them null)."""
    doc = F.split_part("note_id", F.lit("_"), F.lit(1)).cast("long")
    reply = F.concat(F.lit('[{"phenotype": "Diarrhea", "evidence_text": "'), F.col("note_id"), F.lit('"}]'))
    given = {"extractor": doc % 3 > 0, "validator": doc % 4 == 0, "enrollment": doc % 5 == 0}
    rows = F.array(*[F.struct(F.lit(k).alias("stage"), F.when(v & (doc % 7 > 0), reply).alias("response")) for k, v in given.items()])
    return notes.select("note_id", F.inline(rows))


def enrollment(t: Tables) -> DataFrame:
    """Enrollment start dates (yyyy-MM-dd text) on the notes' time axis."""
    c = t.customer
    return c.select(
        _s(F.col("c_custkey")).alias("mrn"),
        _s(F.date_add(F.lit(ENROLLMENT_EPOCH).cast("date"), (F.col("c_custkey") % 200).cast("int"))).alias(
            "enrollment_start_date"
        ),
    )


def _first_order(o: DataFrame) -> DataFrame:
    """Per customer the first order date (partial aggregate, no window)."""
    return o.groupBy("o_custkey").agg(F.min(F.col("o_orderdate").cast("date")).alias("first_order"))


def observations(t: Tables) -> DataFrame:
    """Parsed observations: orders as notes, order status as the verdict,
    priority as the severity, first order + 12 months as time zero."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    f = _first_order(o)
    j = o.join(f, "o_custkey")
    return j.select(
        _s(F.col("o_orderkey")).alias("note_id"),
        _s(F.col("o_custkey")).alias("mrn"),
        F.col("o_orderdate").cast("date").alias("note_time"),
        F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "No").alias(
            "diarrhea_present"
        ),
        _severity().alias("severity_level"),
        F.add_months(F.col("first_order"), 12).alias("enrollment_start_date"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit(None).cast("date"))
        .otherwise(F.add_months(F.col("first_order"), 60))
        .alias("enrollment_end_date"),
    )


def _severity() -> Column:
    p = F.col("o_orderpriority")
    return F.when(p.startswith("5"), F.lit("N/A")).otherwise(F.substring(p, 1, 1))


def _mdyy(d: Column) -> Column:
    return F.date_format(d, "M/d/yy")


def llm_outputs(t: Tables) -> DataFrame:
    """Raw model replies per note: fenced or bare JSON, malformed text, empty
    arrays, nulls, bad dates and odd verdict words."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    j = o.join(_first_order(o), "o_custkey")
    k = F.col("o_orderkey")
    d = F.add_months(F.col("o_orderdate").cast("date"), PAYLOAD_YEARS_AHEAD_MONTHS)
    md0 = _mdyy(F.add_months(F.col("first_order"), PAYLOAD_YEARS_AHEAD_MONTHS))
    status = F.col("o_orderstatus")
    pr = F.when(status == "F", " YES ").when(status == "O", "absent").otherwise("unclear")
    sev = _severity()
    tm = (
        F.when(k % 17 == 0, F.lit("null"))
        .when(k % 17 == 1, F.lit('"null"'))
        .when(k % 17 == 2, F.lit('"12/5/2023"'))
        .otherwise(F.concat(F.lit('"'), _mdyy(d), F.lit('"')))
    )
    e = F.concat(
        F.lit('{"confirmed_start": '),
        F.when(k % 4 == 0, "false").otherwise("true"),
        F.lit(', "confirmed_start_date": "'),
        md0,
        F.lit('", "confirmed_end": '),
        F.when(k % 9 == 0, "true").otherwise("false"),
        F.lit(', "confirmed_end_date": null, "enrollment_status_this_note": "'),
        F.when(F.col("o_custkey") % 23 == 0, "deceased_or_ineligible").otherwise("confirmed_start"),
        F.lit('", "confidence": "high", "evidence_text": "q"}'),
    )
    x = F.concat(
        F.lit('[{"phenotype": "Diarrhea",\n "present": "'),
        pr,
        F.lit('", "severity_level": "'),
        sev,
        F.lit('", "time": '),
        tm,
        F.lit(', "evidence_text": "q"}]'),
    )
    v = F.concat(
        F.lit('[{"phenotype": "Diarrhea", "present": "'),
        F.when(k % 7 == 2, "No").otherwise("Yes"),
        F.lit('", "severity_level": "'),
        F.when(k % 5 == 0, F.lit("N/A")).otherwise(sev),
        F.lit('", "time": null, "evidence_text": "q"}]'),
    )

    def fenced(c: Column) -> Column:
        return F.concat(F.lit(FENCE_OPEN), c, F.lit(FENCE_CLOSE))

    return j.select(
        _s(k).alias("note_id"),
        _s(F.col("o_custkey")).alias("mrn"),
        d.alias("contact_date"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 3 == 0, fenced(e)).otherwise(e).alias("enrollment"),
        F.when(k % 13 == 0, F.lit("no json here")).when(k % 2 == 0, fenced(x)).otherwise(x).alias("extracted_llm"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 7 == 1, F.lit("[]")).otherwise(v).alias("val_llm"),
    )


def prior_outputs(t: Tables) -> DataFrame:
    """Prior-event replies keyed by patient_id; dated by the order date."""
    o = t.orders
    k = F.col("o_orderkey")
    js = F.concat(
        F.lit('[{"phenotype": "'),
        F.when(k % 3 == 0, "Diarrhea").otherwise("Chronic/Recurrent Diarrhea"),
        F.lit('", "present": "'),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No"),
        F.lit('", "chronicity_indicator": null, "severity_level": "'),
        _severity(),
        F.lit('", "time": null, "time_description": null, "evidence_text": null}]'),
    )
    return o.select(
        _s(F.col("o_custkey") + 1000000).alias("patient_id"),
        _s(k).alias("note_id"),
        F.col("o_orderdate").cast("date").alias("contact_date"),
        F.when(k % 8 == 0, F.lit(None).cast("string")).otherwise(js).alias("prior_phenotypes"),
    )


def drug_names(t: Tables) -> DataFrame:
    """The drug dimension: the parts' names, types and brands."""
    return t.part.select(F.col("p_name").alias("simple_generic"), F.col("p_type").alias("display_name"), F.col("p_brand").alias("description"))


def administered_meds(t: Tables) -> DataFrame:
    """Administered medications: line items, part names as drugs."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey")
    p = t.part.select("p_partkey", "p_name", "p_type", "p_brand")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        _s(F.col("o_custkey")).alias("mrn"),
        F.col("p_name").alias("simple_generic"),
        F.col("p_type").alias("display_name"),
        F.col("p_brand").alias("description"),
        F.col("l_shipdate").alias("taken_time"),
    )


def order_meds(t: Tables) -> DataFrame:
    """Medication orders: each line of an order; null starts, open ends,
    refills null / '0' / 'x' / '2'."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    p = t.part.select("p_partkey", "p_name", "p_type", "p_brand")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    k = F.col("o_orderkey")
    od = F.col("o_orderdate").cast("date")
    return j.select(
        _s(F.col("o_custkey")).alias("mrn"),
        F.col("p_name").alias("simple_generic"),
        F.col("p_type").alias("display_name"),
        F.col("p_brand").alias("description"),
        F.when(k % 31 == 0, F.lit(None).cast("date")).otherwise(od).alias("order_start_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("date"))
        .otherwise(F.date_add(od, F.col("l_quantity").cast("int") * 10))
        .alias("order_end_date"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 1, F.lit("0"))
        .when(k % 4 == 2, F.lit("x"))
        .otherwise(F.lit("2"))
        .alias("refills"),
    )


def providers(t: Tables) -> DataFrame:
    """Note providers: supplier names of order lines; customers of one
    segment have none, undiscounted lines have a null name."""
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_discount")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select("c_custkey")
    s = t.supplier.select("s_suppkey", "s_name")
    j = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(s, li.l_suppkey == s.s_suppkey)
    )
    return j.select(
        F.col("o_custkey").alias("MRN"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("string")).otherwise(F.col("s_name")).alias("Provider"),
    )
