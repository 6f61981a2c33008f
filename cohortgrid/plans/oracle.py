"""DuckDB oracle: for every registered query an independent SQL text.

The SQL restates the reference semantics directly (window functions,
brute-force bucket windows with range predicates, wide CASE pivots, the
documented column shift), not the Spark rewrites, so agreement is a real
check. Fixture views are written again in SQL. Spark-specific behaviour
that SQL must mimic: ``months_between`` rounding, ``from_json`` turning an
object into a one-element array and malformed text into null, and
``M/d/yy`` parsing.
"""

from __future__ import annotations

import re

from ..sources import fixtures as fx

BUCKETS_STAGE2 = list(range(-6, 37, 6))
BUCKETS_FULL = list(range(-12, 37, 6))
KEYWORDS = fx.FIXTURE_KEYWORDS
PATTERN = fx.FIXTURE_PATTERN
MAX_CHARS = fx.FIXTURE_MAX_CHARS

# ---------------------------------------------------------------------------
# SQL fragment helpers
# ---------------------------------------------------------------------------


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def mb(a: str, b: str) -> str:
    """Spark months_between(a, b) for DATEs."""
    return (
        f"round(case when day({a}) = day({b}) or ({a} = last_day({a}) and {b} = last_day({b})) "
        f"then (year({a}) - year({b})) * 12 + month({a}) - month({b}) "
        f"else (year({a}) - year({b})) * 12 + month({a}) - month({b}) + (day({a}) - day({b})) / 31.0 end, 8)"
    )


def bucket(a: str, b: str, w: int = 6) -> str:
    return f"cast(floor({mb(a, b)} / {w}) * {w} as integer)"


def add_months(d: str, k: str) -> str:
    return f"cast({d} + to_months({k}) as date)"


def clean(x: str) -> str:
    body = f"case when contains({x}, '```json') then regexp_extract({x}, '```json\\s*([\\s\\S]*?)\\s*```', 1) else {x} end"
    return f"regexp_replace({body}, '\\s+', ' ', 'g')"


ENTRY = ("phenotype", "present", "severity_level", "time", "evidence_text")
PRIOR = ("phenotype", "present", "chronicity_indicator", "severity_level", "time", "time_description", "evidence_text")


def _struct_json(fields) -> str:
    return "{" + ", ".join(f'"{f}": "VARCHAR"' for f in fields) + "}"


def arr(c: str, fields=ENTRY) -> str:
    """Spark from_json(c, array<struct>): array -> list, object -> [object],
    anything unparsable -> null."""
    st = _struct_json(fields)
    return (
        f"case when json_valid({c}) then case json_type({c}) "
        f"when 'ARRAY' then from_json({c}, '[{st}]') "
        f"when 'OBJECT' then [from_json({c}, '{st}')] end end"
    )


def norm(x: str) -> str:
    return (
        f"case when lower(trim({x})) in ('yes', 'true', 'present', 'positive', '1') then 'Yes' "
        f"when lower(trim({x})) in ('no', 'false', 'absent', 'negative', '0', 'none', 'n/a') then 'No' end"
    )


def mdyy(x: str) -> str:
    return f"cast(try_strptime({x}, '%m/%d/%y') as date)"


def cell(status: str, sev: str, missing: str = "null") -> str:
    no = f"when {status} = 'No' then 'No' " if missing == "null" else ""
    return (
        f"case when {status} = 'Yes' and {sev} is not null and {sev} <> 'N/A' then 'Yes (Lvl ' || {sev} || ')' "
        f"when {status} = 'Yes' then 'Yes' {no}else {missing} end"
    )


def kw_any(x: str, kws=KEYWORDS) -> str:
    return "(" + " or ".join(f"contains(lower({x}), {q(k)})" for k in kws) + ")"


def rx_any(cols, pat) -> str:
    return "(" + " or ".join(f"regexp_matches({c}, {q(pat)})" for c in cols) + ")"


def col(k: int) -> str:
    return f'"{k}_months"'


def pick(idx: str, values) -> str:
    return "case " + " ".join(f"when {idx} = {i} then {q(v)}" for i, v in enumerate(values)) + " end"


def chunk(src: str, n: int = MAX_CHARS) -> str:
    """Stage-1 chunking of a CTE with note_id/note_text, other columns kept
    in place (a select list is produced by the caller)."""
    return (
        f"select *, case when note_text is null or length(note_text) <= {n} then 0 "
        f"else cast(ceil(length(note_text) / {n}) as integer) end as __n from {src}"
    )


def chunk_select(src: str, cols: list[str], n: int = MAX_CHARS) -> str:
    out = []
    for c in cols:
        if c == "note_id":
            out.append(
                "case when __n = 0 then cast(note_id as varchar) else cast(note_id as varchar) || '_chunked_' || cast(__i as varchar) end as note_id"
            )
        elif c == "note_text":
            out.append(f"case when __n = 0 then note_text else substring(note_text, (__i - 1) * {n} + 1, {n}) end as note_text")
        else:
            out.append(c)
    return (
        f"select {', '.join(out)} from (select *, unnest(case when __n = 0 then [0] else range(1, __n + 1) end) as __i "
        f"from ({chunk(src, n)}))"
    )


# ---------------------------------------------------------------------------
# Fixture views
# ---------------------------------------------------------------------------

NOTE_TYPES5 = ("Progress Notes", "Telephone Encounter", "H&P", "Letter", "Procedures")

V = {}
V["v_patients"] = "select distinct cast(c_custkey as varchar) as MRN from customer where c_mktsegment <> 'AUTOMOBILE'"
V["v_mapping"] = (
    "select cast(c_custkey + 1000000 as varchar) as patient_id, cast(c_custkey as varchar) as mrn from customer "
    "union all select cast(c_custkey + 2000000 as varchar), cast(c_custkey as varchar) from customer where c_acctbal < 0"
)
V["v_notes"] = (
    "select cast(doc_id // 10 + 1000000 as varchar) as patient_id, cast(doc_id as varchar) as note_id, "
    "case when doc_id % 97 = 0 then null else text end as note_text, "
    f"cast(DATE '{fx.NOTE_EPOCH}' + cast((doc_id * 37) % 900 as integer) as date) as contact_date, "
    f"{pick('doc_id % 5', NOTE_TYPES5)} as note_type_ip from documents"
)
_P = fx.CLINICAL_PHRASES
V["v_clinical"] = (
    "select patient_id, note_id, concat_ws(chr(10), "
    f"{pick('cast(note_id as bigint) % ' + str(len(_P)), _P)}, note_text, "
    f"{pick('(cast(note_id as bigint) // ' + str(len(_P)) + ') % ' + str(len(_P)), _P)}) as note_text, "
    "contact_date, note_type_ip from v_notes"
)
V["v_enrollment"] = (
    f"select cast(c_custkey as varchar) as mrn, cast(cast(DATE '{fx.ENROLLMENT_EPOCH}' + cast(c_custkey % 200 as integer) as date) as varchar) "
    "as enrollment_start_date from customer"
)
V["first_order"] = "select o_custkey, min(cast(o_orderdate as date)) as first_order from orders group by o_custkey"
SEV = "case when o_orderpriority like '5%' then 'N/A' else substr(o_orderpriority, 1, 1) end"
V["v_obs"] = (
    "select cast(o_orderkey as varchar) as note_id, cast(o.o_custkey as varchar) as mrn, cast(o_orderdate as date) as note_time, "
    "case o_orderstatus when 'F' then 'Yes' when 'O' then 'No' end as diarrhea_present, "
    f"{SEV} as severity_level, "
    "cast(f.first_order + interval 12 month as date) as enrollment_start_date, "
    "case when o.o_custkey % 2 = 0 then null else cast(f.first_order + interval 60 month as date) end as enrollment_end_date "
    "from orders o join first_order f on o.o_custkey = f.o_custkey"
)


def _md(d: str) -> str:
    return f"cast(month({d}) as varchar) || '/' || cast(day({d}) as varchar) || '/' || substr(cast(year({d}) as varchar), 3, 2)"


V["v_llm"] = (
    "select cast(o_orderkey as varchar) as note_id, cast(o_custkey as varchar) as mrn, d as contact_date, "
    "case when k % 11 = 0 then null when k % 3 = 0 then fence || e || close_fence else e end as enrollment, "
    "case when k % 13 = 0 then 'no json here' when k % 2 = 0 then fence || x || close_fence else x end as extracted_llm, "
    "case when k % 7 = 0 then null when k % 7 = 1 then '[]' else v end as val_llm "
    "from (select *, '```json' || chr(10) as fence, chr(10) || '```' as close_fence, "
    "'{\"confirmed_start\": ' || case when k % 4 = 0 then 'false' else 'true' end || ', \"confirmed_start_date\": \"' || md0 || "
    "'\", \"confirmed_end\": ' || case when k % 9 = 0 then 'true' else 'false' end || ', \"confirmed_end_date\": null, "
    "\"enrollment_status_this_note\": \"' || case when o_custkey % 23 = 0 then 'deceased_or_ineligible' else 'confirmed_start' end || "
    "'\", \"confidence\": \"high\", \"evidence_text\": \"q\"}' as e, "
    "'[{\"phenotype\": \"Diarrhea\",' || chr(10) || ' \"present\": \"' || pr || '\", \"severity_level\": \"' || sev || '\", \"time\": ' || tm || ', \"evidence_text\": \"q\"}]' as x, "
    "'[{\"phenotype\": \"Diarrhea\", \"present\": \"' || case when k % 7 = 2 then 'No' else 'Yes' end || '\", \"severity_level\": \"' || "
    "case when k % 5 = 0 then 'N/A' else sev end || '\", \"time\": null, \"evidence_text\": \"q\"}]' as v "
    "from (select o_orderkey, o.o_custkey, o_orderkey as k, cast(cast(o_orderdate as date) + interval 300 month as date) as d, "
    f"{_md('cast(f.first_order + interval 300 month as date)')} as md0, "
    "case o_orderstatus when 'F' then ' YES ' when 'O' then 'absent' else 'unclear' end as pr, "
    f"{SEV} as sev, "
    "case when o_orderkey % 17 = 0 then 'null' when o_orderkey % 17 = 1 then '\"null\"' when o_orderkey % 17 = 2 then '\"12/5/2023\"' "
    f"else '\"' || {_md('cast(cast(o_orderdate as date) + interval 300 month as date)')} || '\"' end as tm "
    "from orders o join first_order f on o.o_custkey = f.o_custkey) a) b"
)
V["v_prior"] = (
    "select cast(o_custkey + 1000000 as varchar) as patient_id, cast(o_orderkey as varchar) as note_id, cast(o_orderdate as date) as contact_date, "
    "case when o_orderkey % 8 = 0 then null else '[{\"phenotype\": \"' || case when o_orderkey % 3 = 0 then 'Diarrhea' else 'Chronic/Recurrent Diarrhea' end || "
    "'\", \"present\": \"' || case o_orderstatus when 'F' then 'Yes' else 'No' end || '\", \"chronicity_indicator\": null, \"severity_level\": \"' || "
    f"{SEV} || '\", \"time\": null, \"time_description\": null, \"evidence_text\": null}}]' end as prior_phenotypes from orders"
)
V["v_admin"] = (
    "select cast(o_custkey as varchar) as mrn, p_name as simple_generic, p_type as display_name, p_brand as description, l_shipdate as taken_time "
    "from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey"
)
V["v_order_meds"] = (
    "select cast(o_custkey as varchar) as mrn, p_name as simple_generic, p_type as display_name, p_brand as description, "
    "case when o_orderkey % 31 = 0 then null else cast(o_orderdate as date) end as order_start_date, "
    "case when o_orderstatus = 'P' then null else cast(o_orderdate as date) + cast(l_quantity as integer) * 10 end as order_end_date, "
    "case o_orderkey % 4 when 0 then null when 1 then '0' when 2 then 'x' else '2' end as refills "
    "from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey"
)
V["v_providers"] = (
    "select o_custkey as MRN, case when l_discount = 0 then null else s_name end as Provider "
    "from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey "
    "join supplier on l_suppkey = s_suppkey where c_mktsegment <> 'BUILDING'"
)

# ---------------------------------------------------------------------------
# Derived CTEs (reference semantics)
# ---------------------------------------------------------------------------

D = {}
# stage 1
D["ids"] = (
    "select distinct m.patient_id, m.mrn from (select distinct cast(MRN as varchar) as mrn from v_patients) p "
    "join (select distinct cast(patient_id as varchar) as patient_id, cast(mrn as varchar) as mrn from v_mapping) m on p.mrn = m.mrn"
)
D["mf"] = (
    "select n.patient_id, n.note_id, n.note_text, n.contact_date, n.note_type_ip, ids.mrn, 1 as medication_mentioned "
    f"from v_notes n join ids on n.patient_id = ids.patient_id where n.contact_date >= DATE '2022-09-01' and {kw_any('n.note_text')}"
)
D["fm"] = (
    "select *, case when medication_mentioned = 1 then contact_date end as first_medication_mention_date, "
    "first_value(case when medication_mentioned = 1 then contact_date end ignore nulls) over "
    "(partition by mrn order by contact_date rows between unbounded preceding and unbounded following) as medication_start_date from mf"
)
D["lb"] = f"select * from fm where medication_start_date is null or {mb('contact_date', 'medication_start_date')} >= -6"
D["dd"] = "select distinct * from lb"
# stage 2 replies
D["lp"] = (
    f"select note_id, mrn, contact_date, {clean('enrollment')} as enr_c, {clean('extracted_llm')} as ext_c, {clean('val_llm')} as val_c from v_llm"
)
D["lq"] = (
    "select note_id, mrn, contact_date, case when json_valid(enr_c) and json_type(enr_c) = 'OBJECT' then enr_c end as enr_o, "
    f"{arr('ext_c')} as ext_a, {arr('val_c')} as val_a from lp"
)
D["lf"] = (
    "select note_id, mrn, contact_date, ext_a, val_a, "
    "case when json_type(enr_o, '$.confirmed_start') = 'BOOLEAN' then cast(json_extract(enr_o, '$.confirmed_start') as boolean) end as enroll_confirmed_start, "
    "json_extract_string(enr_o, '$.confirmed_start_date') as enroll_confirmed_start_date, "
    "case when json_type(enr_o, '$.confirmed_end') = 'BOOLEAN' then cast(json_extract(enr_o, '$.confirmed_end') as boolean) end as enroll_confirmed_end, "
    "json_extract_string(enr_o, '$.confirmed_end_date') as enroll_confirmed_end_date, "
    "json_extract_string(enr_o, '$.enrollment_status_this_note') as enroll_status, "
    "json_extract_string(enr_o, '$.confidence') as enroll_confidence, "
    "list_filter(ext_a, lambda x: x.phenotype = 'Diarrhea')[1] as ext_e, list_filter(val_a, lambda x: x.phenotype = 'Diarrhea')[1] as val_e from lq"
)
D["lv"] = (
    f"select *, {mdyy('enroll_confirmed_start_date')} as enroll_start_date_parsed, {mdyy('enroll_confirmed_end_date')} as enroll_end_date_parsed, "
    f"{norm('ext_e.present')} as extractor_present, ext_e.severity_level as extractor_severity, ext_e.time as extractor_time, "
    f"{norm('val_e.present')} as validator_present, val_e.severity_level as validator_severity from lf"
)
D["lm"] = (
    "select *, case when validator_present = 'Yes' then 'Yes' when validator_present = 'No' then 'No' "
    "when extractor_present is not null then 'No' end as diarrhea_present, "
    "case when validator_present = 'Yes' then coalesce(validator_severity, extractor_severity) else extractor_severity end as severity_level from lv"
)
D["ld"] = (
    f"select *, case when extractor_time is not null and trim(extractor_time) <> '' then {mdyy('extractor_time')} end as note_time from lm"
)
D["ldd"] = "select * from ld where note_time is not null"
D["er"] = (
    "select mrn, cast(max(cast(enroll_confirmed_start as integer)) as boolean) as any_confirmed_start, "
    "cast(max(case when enroll_status in ('deceased_or_ineligible') then 1 else 0 end) as boolean) as any_ineligible, "
    "min(case when enroll_confirmed_start = true then enroll_start_date_parsed end) as enrollment_start_date, "
    "max(case when enroll_confirmed_end = true then enroll_end_date_parsed end) as enrollment_end_date from ldd group by mrn"
)
D["er2"] = "select *, any_confirmed_start and not any_ineligible as enrolled from er"
D["eg"] = "select mrn, enrollment_start_date, enrollment_end_date from er2 where enrolled = true and enrollment_start_date is not null"
D["lobs"] = (
    "select ldd.note_id, ldd.mrn, ldd.note_time, ldd.diarrhea_present, ldd.severity_level, eg.enrollment_start_date, eg.enrollment_end_date "
    "from ldd join eg on ldd.mrn = eg.mrn"
)


def _stage2(src: str, p: str) -> dict[str, str]:
    """Stage 2 back half over an observation CTE; names prefixed by ``p``."""
    return {
        f"{p}w": f"select * from {src} where note_time is not null and note_time >= enrollment_start_date "
        "and (enrollment_end_date is null or note_time <= enrollment_end_date)",
        f"{p}b": f"select * from (select *, {bucket('note_time', 'enrollment_start_date')} as time_bucket from {p}w) where time_bucket >= -6 and time_bucket <= 36",
        f"{p}a": "select mrn, time_bucket, count(*) as note_count, "
        "cast(sum(case when diarrhea_present = 'Yes' then 1 else 0 end) as bigint) as positive_count, "
        "cast(sum(case when diarrhea_present = 'No' then 1 else 0 end) as bigint) as negative_count, "
        "cast(sum(case when diarrhea_present is null then 1 else 0 end) as bigint) as null_count, "
        "max(case when diarrhea_present = 'Yes' then severity_level end) as severity, "
        f"min(enrollment_start_date) as enrollment_start_date, min(enrollment_end_date) as enrollment_end_date from {p}b group by mrn, time_bucket",
        f"{p}s": "select *, case when positive_count > 0 then 'Yes' when negative_count > 0 then 'No' end as diarrhea_status, "
        f"cast(time_bucket as varchar) || '_months' as time_bucket_label from {p}a",
        f"{p}f": f"select *, {cell('diarrhea_status', 'severity')} as diarrhea_status_formatted from {p}s",
        f"{p}wide": "select mrn, cast(min(enrollment_start_date) as varchar) as enrollment_start_date, "
        "cast(min(enrollment_end_date) as varchar) as enrollment_end_date, "
        + ", ".join(f"max(case when time_bucket = {k} then diarrhea_status_formatted end) as {col(k)}" for k in BUCKETS_STAGE2)
        + f" from {p}f group by mrn",
    }


D.update(_stage2("v_obs", "ox"))
D.update(_stage2("lobs", "lx"))


def summary_sql(src: str, buckets, lead_cols: list[str], by: str | None = None) -> str:
    cells = ", ".join(
        f"cast(count(case when starts_with({col(k)}, 'Yes') then 1 end) as varchar) || '/' || cast(count({col(k)}) as varchar) as {col(k)}" for k in buckets
    )
    lead = []
    for c in lead_cols:
        if c == "mrn":
            lead.append("'SUMMARY' as mrn")
        elif c == by:
            lead.append(by)
        else:
            lead.append(f"cast(null as varchar) as {c}")
    g = f" group by {by}" if by else ""
    return f"select {', '.join(lead)}, {cells} from {src}{g}"


# stage 4
D["pp"] = f"select patient_id, note_id, contact_date, {clean('prior_phenotypes')} as c from v_prior"
D["pe"] = f"select *, list_filter({arr('c', PRIOR)}, lambda x: lower(x.phenotype) like '%diarrhea%')[1] as e from pp"
D["pf"] = (
    "select patient_id, note_id, coalesce(e.present, 'No') as diarrhea_present, e.severity_level as severity_level, "
    f"coalesce(case when e.time is not null and e.time <> '' then {mdyy('e.time')} end, contact_date) as note_time from pe"
)
D["opat"] = "select mrn, cast(enrollment_start_date as date) as enrollment_start_date, cast(enrollment_end_date as date) as enrollment_end_date from oxwide"
D["pj"] = (
    "select pf.*, m.mrn, p.enrollment_start_date from pf "
    "join (select distinct mrn, patient_id from v_mapping) m on pf.patient_id = m.patient_id "
    "join opat p on m.mrn = p.mrn"
)
D["pb"] = f"select *, {mb('note_time', 'enrollment_start_date')} as m from pj where note_time is not null and note_time < enrollment_start_date"
D["pl"] = (
    "select *, case when m >= -6 and m < 0 then -6 when m >= -12 and m < -6 then -12 end as time_bucket from pb"
)
D["pr"] = (
    "select mrn, time_bucket, max(diarrhea_present) as diarrhea_status, max(severity_level) as severity, "
    "cast(time_bucket as varchar) || '_months' as time_bucket_label from pl where time_bucket is not null group by mrn, time_bucket"
)
D["prf"] = f"select *, {cell('diarrhea_status', 'severity', q('No'))} as diarrhea_status_formatted from pr"
D["xwide"] = (
    "select o.mrn, o.enrollment_start_date, o.enrollment_end_date, "
    + ", ".join(f"pv.{col(k)}" for k in (-12, -6))
    + ", "
    + ", ".join(f"o.{col(k)}" for k in BUCKETS_FULL if k >= 0)
    + " from oxwide o left join (select mrn, "
    + ", ".join(f"max(case when time_bucket = {k} then diarrhea_status_formatted end) as {col(k)}" for k in (-12, -6))
    + " from prf group by mrn) pv on o.mrn = pv.mrn"
)
# stage 5
D["pat"] = "select mrn, cast(enrollment_start_date as date) as s from xwide"
D["bk"] = f"select unnest({BUCKETS_FULL}) as k"
D["pbw"] = f"select pat.mrn, k, {add_months('s', 'k')} as bs, {add_months('s', 'k + 6')} as be from pat cross join bk"
NAMES = ("simple_generic", "display_name", "description")
D["adm"] = (
    f"select cast(mrn as varchar) as mrn, cast(taken_time as date) as event_date from v_admin "
    f"where cast(mrn as varchar) in (select mrn from pat) and {rx_any(NAMES, PATTERN)}"
)
D["ordm"] = (
    "select cast(mrn as varchar) as mrn, cast(order_start_date as date) as os, cast(order_end_date as date) as oe, "
    "coalesce(try_cast(refills as integer) > 0, false) as has_refill from v_order_meds "
    f"where cast(mrn as varchar) in (select mrn from pat) and {rx_any(NAMES, PATTERN)}"
)
D["ah"] = "select distinct w.mrn, w.k from pbw w join adm a on w.mrn = a.mrn where a.event_date >= w.bs and a.event_date < w.be"
D["oh"] = (
    "select w.mrn, w.k, bool_or(o.has_refill) as any_refill from pbw w join ordm o on w.mrn = o.mrn "
    "where o.os < w.be and (o.oe is null or o.oe >= w.bs) group by w.mrn, w.k"
)
D["flags"] = (
    "select w.mrn, w.k, case when ah.k is not null or oh.k is not null then 'Yes' else 'No' end as epic_med, "
    "case when coalesce(oh.any_refill, false) then 'Yes' else 'No' end as refill "
    "from pbw w left join ah on w.mrn = ah.mrn and w.k = ah.k left join oh on w.mrn = oh.mrn and w.k = oh.k"
)
D["prov"] = (
    "select pat.mrn, coalesce(a.names, 'No Provider Record') as note_author from pat left join "
    "(select mrn, string_agg(distinct provider_name, ', ' order by provider_name) as names from "
    "(select cast(MRN as varchar) as mrn, Provider as provider_name from v_providers where Provider is not null) "
    "where mrn in (select mrn from pat) group by mrn) a on pat.mrn = a.mrn"
)


def _flag_wide(var: str) -> str:
    return (
        f"select mrn, '{var}' as variable, "
        + ", ".join(f"max(case when k = {k} then {var} end) as {col(k)}" for k in BUCKETS_FULL)
        + " from flags group by mrn"
    )


D["fw"] = _flag_wide("epic_med") + " union all " + _flag_wide("refill")
TC = ", ".join(col(k) for k in BUCKETS_FULL)
D["par"] = (
    f"select x.mrn, x.enrollment_start_date, x.enrollment_end_date, 'diarrhea' as variable, p.note_author, {', '.join('x.' + col(k) for k in BUCKETS_FULL)} "
    "from xwide x join prov p on x.mrn = p.mrn union all "
    f"select x.mrn, x.enrollment_start_date, x.enrollment_end_date, f.variable, p.note_author, {', '.join('f.' + col(k) for k in BUCKETS_FULL)} "
    "from fw f join xwide x on f.mrn = x.mrn join prov p on x.mrn = p.mrn"
)
# stage 6
D["shf"] = (
    f"select mrn, case when starts_with({col(-12)}, 'Yes') then 12 when starts_with({col(-6)}, 'Yes') then 6 else 0 end as bucket_shift "
    "from par where variable = 'refill'"
)


def _shifted(k: int) -> str:
    if k > 30:
        return f"case when s.bucket_shift > 0 then null else p.{col(k)} end as {col(k)}"
    parts = [f"when coalesce(s.bucket_shift, 0) = 0 then p.{col(k)}"]
    for sh in (6, 12):
        src = f"p.{col(k - sh)}" if (k - sh) in BUCKETS_FULL else "null"
        parts.append(f"when s.bucket_shift = {sh} then {src}")
    return "case " + " ".join(parts) + f" end as {col(k)}"


D["cor"] = (
    "select p.mrn, case when coalesce(s.bucket_shift, 0) > 0 then cast("
    + add_months("cast(p.enrollment_start_date as date)", "-s.bucket_shift")
    + " as varchar) else p.enrollment_start_date end as enrollment_start_date, p.enrollment_end_date, p.variable, p.note_author, "
    "case when coalesce(s.bucket_shift, 0) > 0 then cast("
    + add_months("cast(p.enrollment_start_date as date)", "-s.bucket_shift")
    + " as varchar) else p.enrollment_start_date end as correct_enrollment_date, "
    + ", ".join(_shifted(k) for k in BUCKETS_FULL)
    + " from par p left join shf s on p.mrn = s.mrn"
)
# the same chain from the replies' matrix instead of the observations'
CHAIN = "opat pj pb pl pr prf xwide pat pbw adm ordm ah oh flags prov fw par shf cor".split()
for _n in CHAIN:
    _sql = re.sub(r"\b(from|join) (" + "|".join(CHAIN) + r")\b", r"\1 r_\2", D[_n]).replace("from oxwide", "from lxwide")
    D[f"r_{_n}"] = re.sub(r"\b(from|join) r_(pf|pat|ah|oh)\b", r"\1 r_\2 \2", _sql)
# instruction rules
D["ents"] = (
    "select note_id, unnest(range(0, len(ext_a))) as pos, unnest(ext_a) as e from lq "
    "union all select note_id, coalesce(len(ext_a), 0) + unnest(range(0, len(val_a))), unnest(val_a) from lq"
)
D["entf"] = "select note_id, cast(pos as integer) as pos, e.phenotype as phenotype, e.present as present, e.severity_level as severity_level, e.time as time from ents"


def _mf(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}\\s]', '', 'g'), '\\s+', ' ', 'g'))"


def _normdate(x: str) -> str:
    fmts = ("%m/%d/%y", "%m/%d/%Y", "%B %d, %Y", "%b %d, %Y", "%B %Y", "%b %Y")
    return "strftime(coalesce(" + ", ".join(f"try_strptime({x}, '{f}')" for f in fmts) + "), '%-m/%-d/%y')"


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------


def _with(names: list[str], body: str) -> str:
    """WITH clause of the named views/CTEs (dependency order kept)."""
    order = list(V) + list(D)
    need = set()

    def deps(n: str):
        if n in need:
            return
        need.add(n)
        text = V.get(n) or D.get(n)
        for m in order:
            if m != n and _mentions(text, m):
                deps(m)

    for n in names:
        deps(n)
    for m in order:
        if _mentions(body, m):
            deps(m)
    parts = [f"{n} as ({V.get(n) or D.get(n)})" for n in order if n in need]
    return "with " + ",\n".join(parts) + "\n" + body


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b(from|join)\s+{re.escape(name)}\b", text) is not None


CHUNK_COLS = ["patient_id", "note_id", "note_text", "contact_date", "note_type_ip"]
STAGE1_COLS = CHUNK_COLS + ["mrn", "medication_mentioned", "first_medication_mention_date", "medication_start_date"]
S2_LEAD = ["mrn", "enrollment_start_date", "enrollment_end_date"]
S5_LEAD = S2_LEAD + ["variable", "note_author"]
S6_LEAD = S5_LEAD + ["correct_enrollment_date"]
S2_COLS = ", ".join(col(k) for k in BUCKETS_STAGE2)


def _dates_txt(cols: list[str], date_cols: set[str]) -> str:
    return ", ".join(f"cast({c} as varchar) as {c}" if c in date_cols else c for c in cols)


SQL: dict[str, str] = {}
SQL["cohort_resolve"] = _with(["ids"], "select patient_id, mrn from ids")
SQL["mention_filter"] = _with(["mf"], "select patient_id, note_id, note_text, cast(contact_date as varchar) as contact_date, note_type_ip, mrn, medication_mentioned from mf")
SQL["first_mention_anchor"] = _with(["fm"], f"select {_dates_txt(STAGE1_COLS, {'contact_date', 'first_medication_mention_date', 'medication_start_date'})} from fm")
SQL["anchor_lookback"] = _with(
    ["ids"],
    "select patient_id, note_id, mrn, cast(contact_date as varchar) as contact_date, medication_mentioned, "
    "cast(first_medication_mention_date as varchar) as first_medication_mention_date, cast(medication_start_date as varchar) as medication_start_date from ("
    "select *, first_value(first_medication_mention_date ignore nulls) over (partition by mrn order by contact_date "
    "rows between unbounded preceding and unbounded following) as medication_start_date from ("
    "select *, case when medication_mentioned = 1 then contact_date end as first_medication_mention_date from ("
    f"select n.*, ids.mrn, case when {kw_any('n.note_text')} then 1 else 0 end as medication_mentioned "
    "from v_notes n join ids on n.patient_id = ids.patient_id where n.contact_date >= DATE '2022-09-01'))) "
    f"where medication_start_date is null or {mb('contact_date', 'medication_start_date')} >= -6",
)
SQL["dedup_rows"] = _with(["v_notes"], "select distinct note_text, note_type_ip from v_notes")
SQL["chunk_text"] = _with(
    ["v_notes"], f"select {_dates_txt(CHUNK_COLS, {'contact_date'})} from ({chunk_select('v_notes', CHUNK_COLS)})"
)
SQL["mention_notes"] = _with(
    ["dd"],
    f"select {_dates_txt(STAGE1_COLS, {'contact_date', 'first_medication_mention_date', 'medication_start_date'})} from ({chunk_select('dd', STAGE1_COLS)})",
)
D["ben"] = (
    "select distinct cast(mrn as varchar) as mrn, cast(try_strptime(enrollment_start_date, '%Y-%m-%d') as date) as s from v_enrollment"
)
D["bpw"] = (
    "select distinct m.patient_id, b.mrn, b.s, b.s - 365 as lb from ben b "
    "join (select distinct cast(patient_id as varchar) as patient_id, cast(mrn as varchar) as mrn from v_mapping) m on b.mrn = m.mrn"
)
D["bnj"] = (
    "select distinct n.patient_id, n.note_id, n.note_text, n.contact_date, n.note_type_ip from v_notes n join bpw w on n.patient_id = w.patient_id "
    "where n.note_type_ip in ('Progress Notes', 'Telephone Encounter', 'H&P', 'Letter') and n.contact_date >= w.lb and n.contact_date <= w.s"
)
SQL["baseline_notes"] = _with(["bnj"], f"select {_dates_txt(CHUNK_COLS, {'contact_date'})} from ({chunk_select('bnj', CHUNK_COLS)})")
SQL["date_envelope"] = _with(["bpw"], "select cast(min(lb) as varchar) as global_min, cast(max(s) as varchar) as global_max from bpw")

SQL["fenced_json_clean"] = _with(
    ["v_llm"],
    f"select note_id, {clean('enrollment')} as enrollment_cleaned, {clean('extracted_llm')} as extractor_cleaned, {clean('val_llm')} as validator_cleaned from v_llm",
)
SQL["payload_parse"] = _with(
    ["lv"],
    "select note_id, enroll_confirmed_start, enroll_confirmed_start_date, enroll_confirmed_end, enroll_confirmed_end_date, enroll_status, "
    "enroll_confidence, cast(enroll_start_date_parsed as varchar) as enroll_start_date_parsed, cast(enroll_end_date_parsed as varchar) as enroll_end_date_parsed, "
    "ext_a is not null as extractor_parsed, coalesce(cast(len(ext_a) as integer), 0) as extractor_entries, "
    "val_a is not null as validator_parsed, coalesce(cast(len(val_a) as integer), 0) as validator_entries from lv",
)
SQL["pick_entry"] = _with(
    ["lf"],
    "select note_id, ext_e.phenotype as extractor_phenotype, ext_e.present as extractor_present_raw, ext_e.severity_level as extractor_severity, "
    "ext_e.time as extractor_time, val_e.present as validator_present_raw, val_e.severity_level as validator_severity from lf",
)
SQL["normalize_verdict"] = _with(["lv"], "select note_id, ext_e.present as extractor_present_raw, extractor_present, validator_present from lv")
SQL["verdict_merge"] = _with(["lm"], "select note_id, mrn, extractor_present, validator_present, diarrhea_present, severity_level from lm")
SQL["verdict_merge_audit"] = _with(
    ["lm"], "select extractor_present, validator_present, diarrhea_present, count(*) as n from lm group by extractor_present, validator_present, diarrhea_present"
)
SQL["observation_date_strict"] = _with(["ldd"], "select note_id, mrn, cast(note_time as varchar) as note_time from ldd")
SQL["observation_date_fallback"] = _with(
    ["lm"],
    f"select note_id, mrn, cast(coalesce(case when extractor_time is not null and trim(extractor_time) <> '' then {mdyy('extractor_time')} end, "
    "cast(contact_date as date)) as varchar) as note_time from lm",
)
SQL["enrollment_rollup"] = _with(
    ["er2"],
    "select mrn, any_confirmed_start, any_ineligible, cast(enrollment_start_date as varchar) as enrollment_start_date, "
    "cast(enrollment_end_date as varchar) as enrollment_end_date, enrolled from er2",
)
SQL["enrollment_gate"] = _with(
    ["eg"], "select mrn, cast(enrollment_start_date as varchar) as enrollment_start_date, cast(enrollment_end_date as varchar) as enrollment_end_date from eg"
)
SQL["enrollment_audit"] = _with(
    ["er2"], "select count(*) as total, count(case when enrolled then 1 end) as enrolled, count(*) - count(case when enrolled then 1 end) as dropped from er2"
)
SQL["treatment_window"] = _with(["oxw"], "select note_id, mrn, cast(note_time as varchar) as note_time from oxw")
SQL["bucket_elapsed"] = _with(
    ["v_obs"],
    f"select note_id, mrn, time_bucket, cast(time_bucket as varchar) || '_months' as time_bucket_label from "
    f"(select *, {bucket('note_time', 'enrollment_start_date')} as time_bucket from v_obs) where time_bucket >= -12 and time_bucket <= 36",
)
SQL["bucket_rollup"] = _with(
    ["oxf"],
    "select mrn, cast(enrollment_start_date as varchar) as enrollment_start_date, cast(enrollment_end_date as varchar) as enrollment_end_date, "
    "time_bucket, note_count, positive_count, negative_count, null_count, severity, time_bucket_label, diarrhea_status, diarrhea_status_formatted from oxf",
)
SQL["status_format"] = _with(
    ["oxs"],
    f"select mrn, time_bucket_label, {cell('diarrhea_status', 'severity')} as cell, {cell('diarrhea_status', 'severity', q('No'))} as cell_missing_no from oxs",
)
SQL["bucket_audit"] = _with(["oxs"], "select time_bucket_label, diarrhea_status, count(*) as n from oxs group by time_bucket_label, diarrhea_status")
SQL["symptom_matrix"] = _with(["oxwide"], f"select mrn, enrollment_start_date, enrollment_end_date, {S2_COLS} from oxwide")
SQL["llm_symptom_matrix"] = _with(["lxwide"], f"select mrn, enrollment_start_date, enrollment_end_date, {S2_COLS} from lxwide")
SQL["matrix_summary"] = _with(["oxwide"], summary_sql("oxwide", BUCKETS_STAGE2, S2_LEAD))
SQL["matrix_with_summary"] = _with(
    ["oxwide"], f"select mrn, enrollment_start_date, enrollment_end_date, {S2_COLS} from oxwide union all " + summary_sql("oxwide", BUCKETS_STAGE2, S2_LEAD)
)
SQL["positive_rate"] = _with(
    ["oxwide"],
    "select time_bucket_label, positive, assessed, coalesce(round(positive * 100.0 / nullif(assessed, 0), 1), 0.0) as pct_positive from ("
    + " union all ".join(
        f"select '{k}_months' as time_bucket_label, count(case when starts_with({col(k)}, 'Yes') then 1 end) as positive, count({col(k)}) as assessed from oxwide"
        for k in BUCKETS_STAGE2
    )
    + ")",
)
SQL["bucket_pre_baseline"] = _with(
    ["pl"],
    "select note_id, mrn, time_bucket, cast(time_bucket as varchar) || '_months' as time_bucket_label, diarrhea_present, severity_level from pl where time_bucket is not null",
)
SQL["prior_rollup"] = _with(["prf"], "select mrn, time_bucket, diarrhea_status, severity, time_bucket_label, diarrhea_status_formatted from prf")
SQL["matrix_extended"] = _with(["xwide"], f"select * from xwide union all " + summary_sql("xwide", BUCKETS_FULL, S2_LEAD))
SQL["provider_attribution"] = _with(["prov"], "select mrn, note_author from prov")
SQL["medication_match"] = _with(
    ["pat"],
    "select cast(mrn as varchar) as mrn, simple_generic, display_name, description, cast(cast(taken_time as date) as varchar) as taken_time from v_admin "
    f"where cast(mrn as varchar) in (select mrn from pat) and {rx_any(NAMES, PATTERN)}",
)
SQL["bucket_windows"] = _with(
    ["pbw"], "select mrn, k as time_bucket, cast(k as varchar) || '_months' as time_bucket_label, cast(bs as varchar) as bucket_start, cast(be as varchar) as bucket_end from pbw"
)
SQL["point_coverage"] = _with(["ah"], "select mrn, k as time_bucket from ah")
SQL["interval_coverage"] = _with(["oh"], "select mrn, k as time_bucket from oh")
SQL["refill_coverage"] = _with(["oh"], "select mrn, k as time_bucket from oh where any_refill")
SQL["coverage_flags"] = _with(
    ["flags"], "select mrn, 'epic_med' as variable, k as time_bucket, epic_med as cell from flags union all select mrn, 'refill', k, refill from flags"
)
SQL["coverage_matrix"] = _with(["fw"], f"select mrn, variable, {TC} from fw")
SQL["parallel_rows"] = _with(["par"], f"select * from par union all " + summary_sql("par", BUCKETS_FULL, S5_LEAD, by="variable"))
SQL["shift_detect"] = _with(["shf"], "select mrn, bucket_shift from shf")
SQL["matrix_shift"] = _with(["cor"], f"select {', '.join(S5_LEAD)}, {TC} from cor")
SQL["start_date_correction"] = _with(["cor"], "select distinct mrn, enrollment_start_date, correct_enrollment_date from cor")
SQL["corrected_matrix"] = _with(["cor"], f"select * from cor union all " + summary_sql("cor", BUCKETS_FULL, S6_LEAD, by="variable"))
SQL["study_final_matrix"] = _with(["r_cor"], "select * from r_cor union all " + summary_sql("r_cor", BUCKETS_FULL, S6_LEAD, by="variable"))
SQL["shift_audit"] = _with(["shf"], "select count(case when bucket_shift > 0 then 1 end) as shifted, count(*) as total from shf")

SQL["response_contract"] = _with(
    ["v_llm"],
    "select r.source, r.replies, r.unparsable, coalesce(e.entries, 0) as entries, coalesce(e.bad_present, 0) as bad_present, "
    "coalesce(e.bad_severity, 0) as bad_severity, coalesce(e.bad_time, 0) as bad_time from "
    f"(select source, count(raw) as replies, count(case when raw is not null and a is null then 1 end) as unparsable from "
    f"(select source, raw, {arr(clean('raw'))} as a from (select 'extracted_llm' as source, extracted_llm as raw from v_llm "
    "union all select 'val_llm', val_llm from v_llm)) group by source) r left join "
    "(select source, count(*) as entries, count(case when not coalesce(e.present in ('Yes', 'No'), false) then 1 end) as bad_present, "
    "count(case when not coalesce(e.severity_level in ('1', '2', '3', '4', 'N/A'), false) then 1 end) as bad_severity, "
    "count(case when e.time is not null and not regexp_matches(e.time, '^\\d{1,2}/\\d{1,2}/\\d{2}$') then 1 end) as bad_time from "
    f"(select source, unnest({arr(clean('raw'))}) as e from (select 'extracted_llm' as source, extracted_llm as raw from v_llm "
    "union all select 'val_llm', val_llm from v_llm)) group by source) e on r.source = e.source",
)
SQL["positive_only"] = _with(["entf"], f"select * from entf where {norm('present')} = 'Yes'")
SQL["entry_dedup"] = _with(
    ["entf"],
    "select e.* from entf e join (select note_id, phenotype, time, min(pos) as pos from entf group by all) m "
    "on e.note_id = m.note_id and e.pos = m.pos",
)
STAGES = {
    "summarizer": "Return only the passages of this note about the study drug, verbatim.",
    "extractor": "Return the phenotype findings of these passages as a JSON array.",
    "validator": "Validate the extracted findings against this note; return a JSON array.",
    "enrollment": "Return what this note states about starting or stopping the study drug as JSON.",
    "prior_events": "Return the chronic or recurrent phenotype findings of this note as a JSON array.",
}
D["chunks"] = f"select note_id, note_text, cast(split_part(note_id, '_', 1) as bigint) as doc from ({chunk_select('v_clinical', CHUNK_COLS)})"
D["resp"] = " union all ".join(
    f"select note_id, '{stage}' as stage, case when {rule} and doc % 7 > 0 then '[{{\"phenotype\": \"Diarrhea\", \"evidence_text\": \"' || note_id || '\"}}]' end as response from chunks"
    for stage, rule in (("extractor", "doc % 3 > 0"), ("validator", "doc % 4 = 0"), ("enrollment", "doc % 5 = 0"))
)


def sentence_list(x: str) -> str:
    """The tiles of a text by marking and splitting: full stops that end no
    sentence are set aside, marks are put behind what ends one."""
    letter = "(^|[^\\p{L}])"
    out = x
    for _ in range(2):
        out = f"regexp_replace({out}, '{letter}(Dr|Mr|Mrs|Ms|Prof|St|vs|e\\.g|i\\.e|approx|Pt|[A-Z])\\.', '\\1\\2' || chr(2), 'g')"
    out = f"regexp_replace({out}, '(^|\\n)([ \\t\\r\\f]{{0,8}}\\d{{1,3}})\\.', '\\1\\2' || chr(2), 'g')"
    short = "a\\.m|p\\.m|etc|No|b\\.i\\.d|t\\.i\\.d|q\\.d|mg|mL|wk|wks|mo|mos|yr|yrs|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec"
    for _ in range(2):
        out = f"regexp_replace({out}, '{letter}({short})\\.([ \\t\\n\\r\\f]+[\\p{{Ll}}\\d])', '\\1\\2' || chr(2) || '\\3', 'g')"
    out = f"""regexp_replace({out}, '([.!?]+["'')\\]]*)([ \\t\\n\\r\\f])', '\\1' || chr(1) || '\\2', 'g')"""
    out = f"regexp_replace({out}, '\\n([ \\t\\r\\f]*\\n)', chr(1) || chr(10) || '\\1', 'g')"
    out = f"regexp_replace({out}, '\\n([ \\t\\n\\r\\f]*)([^\\p{{Ll}}\\d \\t\\n\\r\\f]|\\d{{1,3}}[.)\\x02][ \\t\\n\\r\\f])', chr(1) || chr(10) || '\\1\\2', 'g')"
    return f"list_transform(string_split({out}, chr(1)), lambda s: replace(s, chr(2), '.'))"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$', '', 'g')"


_drug = f"list_filter(list_transform({sentence_list('note_text')}, lambda s: {_strip('s')}), lambda s: contains(lower(s), 'daybue') or contains(lower(s), 'trofinetide'))"
D["asked"] = (
    f"select note_id, 'extractor' as stage, case when len({_drug}) = 0 then 'No Daybue-related information found' else array_to_string({_drug}, ' ') end as body from chunks "
    "union all select c.note_id, 'validator', 'ORIGINAL_NOTE:' || chr(10) || note_text || chr(10) || chr(10) || 'EXTRACTION:' || chr(10) || response "
    "from chunks c join resp r on c.note_id = r.note_id and r.stage = 'extractor' where response is not null "
    + " ".join(f"union all select note_id, '{k}', note_text from chunks" for k in ("summarizer", "enrollment", "prior_events"))
)
SQL["llm_requests"] = _with(
    ["asked", "resp"],
    "select a.note_id, a.stage, case a.stage " + " ".join(f"when {q(k)} then {q(v)}" for k, v in STAGES.items())
    + " end || chr(10) || chr(10) || body as request_text from asked a where body is not null and not exists ("
    "select 1 from resp r where r.note_id = a.note_id and r.stage = a.stage and r.response is not null)",
)
SQL["llm_responses"] = _with(
    ["chunks", "resp"],
    "select note_id, " + ", ".join(f"(select max(response) from resp r where r.note_id = c.note_id and r.stage = '{k}') as {k}" for k in STAGES) + " from chunks c",
)
D["given"] = " union all ".join(
    f"select note_id, cast(note_id as bigint) as doc, '{stage}' as stage, '[{{\"phenotype\": \"Diarrhea\", \"evidence_text\": \"' || note_id || '\"}}]' as response "
    f"from v_clinical where {rule.replace('doc', 'cast(note_id as bigint)')} and cast(note_id as bigint) % 7 > 0"
    for stage, rule in (("extractor", "doc % 3 > 0"), ("validator", "doc % 4 = 0"), ("enrollment", "doc % 5 = 0"))
)
D["ledger"] = " union all ".join(
    f"select v.note_id, '{k}' as stage, sha256('{k}' || chr(10) || sha256({q(text)}) || chr(10) || sha256(note_text) || chr(10)"
    + (" || sha256(g.response) || chr(10)) as request_id from v_clinical v join given g on v.note_id = g.note_id and g.stage = 'extractor'" if k == "validator" else ") as request_id from v_clinical v")
    for k, text in STAGES.items()
)
SQL["request_ledger"] = _with(
    ["ledger", "given"],
    "select * from ledger l where not exists (select 1 from given g where g.note_id = l.note_id and g.stage = l.stage and g.doc % 3 > 0)",
)
D["om"] = "select distinct mrn, order_start_date as os, order_end_date as oe, refills from v_order_meds"
D["days_given"] = "select distinct mrn, cast(taken_time as date) as given from v_admin"
D["stays"] = "select mrn, given, lead(given) over (partition by mrn order by given) as until from days_given where given is not null"
SQL["interval_overlaps"] = _with(
    ["om", "stays"],
    "select mrn, count(*) as pairs, cast(sum(least(coalesce(oe, until), coalesce(until, oe)) - greatest(os, given) + 1) as bigint) as days, "
    "count(case when oe is null and until is null then 1 end) as open_pairs, cast(min(greatest(os, given)) as varchar) as first_overlap "
    "from om join stays using (mrn) where os is not null and (oe is null or oe >= os) and (until is null or os <= until) and (oe is null or given <= oe) group by mrn",
)
SQL["annotation_agreement"] = _with(
    ["oxf", "oxb"],
    "select *, round(matched * 100.0 / nullif(compared, 0), 1)::double as percent from (select count(*) as compared, count(case when starts_with(f.diarrhea_status_formatted, 'Yes') = (a.annotation = 'Yes') then 1 end) as matched from oxf f join "
    "(select mrn, time_bucket, max(case when severity_level = '1' then 'Yes' else 'No' end) as annotation from oxb group by mrn, time_bucket) a "
    "on f.mrn = a.mrn and f.time_bucket = a.time_bucket where f.diarrhea_status_formatted is not null)",
)

# L rules over clinical notes ------------------------------------------------
# What each sentence of the fixture notes says, read and written down by hand:
# phrase, its sentences, and for each what is so of it. A date is of the start
# or the end; ``mention`` is a stated one of the patient, with the word for its
# kind and its date; ``isolated`` is one that is no chronic mention; ``dates`` are
# all that stand in it.
SAID = (
    (0, "Started Daybue on 2/15/24 and tolerating it well.", dict(drug=1, start=1, start_date="2/15/24")),
    (1, "Mother reports loose stool in diaper since starting trofinetide.", dict(drug=1, start=1, mention=1, severity=1, relative="since starting trofinetide")),
    (2, "Watery stool in diaper for the past 3 months, much better this week.", dict(mention=1, kind="prolonged", severity=2, intensity="high", relative="for the past 3 months")),
    (3, "Daybue was stopped due to diarrhea on February 15, 2024.", dict(drug=1, stop=1, stop_date="2/15/24", mention=1, mention_date="2/15/24")),
    (4, "Will start Daybue next month; prior authorization submitted.", dict(drug=1, planned=1)),
    (5, "Insurance denied trofinetide.", dict(drug=1, denied=1)),
    (6, "Chronic diarrhea with watery stool on clothes, workup for malabsorption.", dict(mention=1, kind="chronic", severity=3)),
    (7, "Patient passed away in Feb 2024.", dict(gone=1)),
    (8, "Had one episode of diarrhea after eating, resolved same day.", dict(isolated=1)),
    (9, "Call if you develop diarrhea.", dict()),
    (10, "Slight improvement in hand use on trofinetide, seen 12/5/2023.", dict(drug=1, start=1, intensity="low")),
    (11, "Recurrent diarrhea with watery stool outside clothes, dramatically worse.", dict(mention=1, kind="recurrent", severity=4, intensity="high")),
    (12, "Patient has not started Daybue.", dict(drug=1, planned=1)),
    (13, "Family decided to hold off on Daybue.", dict(drug=1, planned=1)),
    (14, "Started Daybue 0.5 mL on 2/15/24.", dict(drug=1, start=1, start_date="2/15/24")),
    (15, "Dose of Daybue is 3.5 mg.", dict(drug=1)),
    (15, "Seen by Dr. Smith on 2.15.24 for daybue.", dict(drug=1)),
    (16, "Her cousin started Daybue in Mar 2023.", dict(drug=1)),
    (17, "Patient started Daybue on 3/1/24 but discontinued it in June 2024.", dict(drug=1, start=1, start_date="3/1/24", stop=1, stop_date="6/1/24")),
    (18, "Insurance denied Daybue at first.", dict(drug=1, denied=1)),
    (18, "She has been taking trofinetide since 5/6/24.", dict(drug=1, start=1, start_date="5/6/24")),
    (19, "Denies diarrhea.", dict()),
    (19, "No loose stool since starting trofinetide.", dict(drug=1, start=1, relative="since starting trofinetide")),
    (20, "Sister had chronic diarrhea.", dict()),
    (21, "1. Continue Daybue 20 mL b.i.d. as tolerated.", dict(drug=1, start=1)),
    (21, "2. Call if watery stool on clothes recurs.", dict(severity=3)),
    (22, "Diarrhea today, watery stool in diaper at 5 p.m. after lunch.", dict(mention=1, severity=2)),
    (23, "Persistent loose stool in diaper for several weeks despite loperamide.", dict(mention=1, kind="persistent", severity=1, relative="for several weeks")),
)
_FLAGS = ("drug", "start", "stop", "denied", "planned", "gone", "mention", "isolated", "severity")
_TEXTS = ("start_date", "stop_date", "kind", "mention_date", "intensity", "relative")
# Sentences by phrase in which February 15, 2024 is written.
FEB_15 = (0, 3, 14)
D["said"] = (
    "select * from (values "
    + ", ".join(
        f"({p}, {i}, {q(text)}, {', '.join(str(so.get(f, 0)) for f in _FLAGS)}, {', '.join(q(so[t]) if t in so else 'null::varchar' for t in _TEXTS)})"
        for i, (p, text, so) in enumerate(SAID)
    )
    + f") as t(p, i, said, {', '.join(_FLAGS)}, {', '.join(_TEXTS)})"
)
_N = len(fx.CLINICAL_PHRASES)
# The phrase before the document (part 0) and the one behind it (part 1), and where it begins.
D["ends"] = (
    f"select v.patient_id, v.note_id, v.contact_date, v.note_text, part, cast(case part when 0 then cast(v.note_id as bigint) else cast(v.note_id as bigint) // {_N} end % {_N} as integer) as p, "
    "case part when 0 then 0 else length(v.note_text) end as edge from v_clinical v cross join (values (0), (1)) as t(part)"
)
D["note_said"] = (
    "select e.patient_id, e.note_id, e.contact_date, e.part * 1000 + s.i as ord, s.*, "
    f"case e.part when 0 then 0 else e.edge - length({pick('e.p', fx.CLINICAL_PHRASES)}) end + instr({pick('e.p', fx.CLINICAL_PHRASES)}, s.said) - 1 as s_start "
    "from ends e join said s on e.p = s.p"
)
SQL["passage_extract"] = _with(
    ["note_said"],
    "select v.note_id, coalesce(p, 'No Daybue-related information found') as passage from v_clinical v left join "
    "(select note_id, string_agg(said, ' ' order by ord) as p from note_said where drug = 1 group by note_id) d on v.note_id = d.note_id",
)
SQL["passage_spans"] = _with(
    ["note_said"], 'select note_id, cast(s_start as integer) as "start", cast(s_start + length(said) as integer) as "end", said as passage from note_said where drug = 1'
)
D["phrase"] = (
    "select p, max(mention + isolated) > 0 as stated, case when max(severity) > 0 then cast(max(severity) as varchar) else 'N/A' end as level, "
    f"rtrim({pick('p', fx.CLINICAL_PHRASES)}, '.') as words, p in {FEB_15} as has_date, p = 10 as hand_use from said group by p"
)
D["checks"] = (
    "select n.note_id, n.doc, a.words as a_words, a.level as a_level, case when a.has_date and n.doc % 3 < 2 then '2/15/24' end as a_time, a.stated as a_ok, "
    "c.words as c_words, c.level as c_level, c.stated as c_ok, c.p in (a.p, b.p) as c_found, b.words as b_words, b.hand_use as b_ok "
    f"from (select note_id, cast(note_id as bigint) as doc from v_clinical) n join phrase a on a.p = n.doc % {_N} join phrase b on b.p = (n.doc // {_N}) % {_N} join phrase c on c.p = (n.doc + 5) % {_N}"
)
D["judged"] = (
    "select *, c_found and c_ok and not (a_ok and a_time is null) as c_kept, a_ok and a_time is null as a_undated from checks"
)
SQL["validated_entries"] = _with(
    ["judged"],
    "select note_id, concat_ws('|', "
    "case when a_ok then '0:fix:quote' || case when a_level <> '4' then '+severity' else '' end || case when doc % 3 < 2 and a_time is null then '+date' else '' end "
    "|| case when doc % 3 = 1 and a_time is not null then '+date_format' else '' end else '0:remove:not_supported' end, "
    "case when not c_found then '1:remove:quote_not_found' when not c_ok then '1:remove:not_supported' when not c_kept then '1:remove:duplicate' "
    "else '1:fix:quote' || case when c_level <> 'N/A' then '+severity' else '' end || case when doc % 2 = 1 then '+date' else '' end end, "
    "case when a_ok then '2:remove:duplicate' else '2:remove:not_supported' end, '3:remove:not_positive', "
    "case when b_ok then '4:fix:quote+severity' else '4:remove:not_supported' end) as outcomes, "
    "concat_ws('|', case when a_ok then concat_ws('~', 'Diarrhea', a_level, coalesce(a_time, '-'), a_words) end, "
    "case when c_kept then concat_ws('~', 'Diarrhea', c_level, '-', c_words) end, "
    "case when b_ok then concat_ws('~', 'Hand use', 'N/A', '-', b_words) end) as validated from judged",
)
D["tiles"] = f"select note_id, {sentence_list('note_text')} as ts from v_clinical"
SQL["sentence_spans"] = _with(
    ["tiles"],
    'select note_id, cast(s as integer) as "start", cast(s + length(t) as integer) as "end", t as sentence from ('
    f"select note_id, o + length(raw) - length(regexp_replace(raw, '^[ \\t\\n\\r\\f]+', '')) as s, {_strip('raw')} as t from ("
    "select note_id, raw, sum(length(raw)) over (partition by note_id order by k) - length(raw) as o from ("
    "select note_id, unnest(ts) as raw, unnest(range(len(ts))) as k from tiles))) where regexp_matches(t, '[\\p{L}\\p{N}]')",
)
_n = len(fx.CLINICAL_PHRASES)
SQL["evidence_grounding"] = _with(
    ["v_clinical"],
    "select note_id, evidence_text, case when evidence_text is null or note_text is null then false "
    f"else ({_mf('evidence_text')} <> '' and contains({_mf('note_text')}, {_mf('evidence_text')})) end as grounded from "
    "(select note_id, note_text, case when cast(note_id as bigint) % 2 = 0 then "
    f"upper(regexp_replace({pick('cast(note_id as bigint) % ' + str(_n), fx.CLINICAL_PHRASES)}, '[.,;]', '', 'g')) "
    f"else {pick('(cast(note_id as bigint) + 5) % ' + str(_n), fx.CLINICAL_PHRASES)} end as evidence_text from v_clinical)",
)

# Quotes against notes sign by sign: what both forms keep, and where it stands.
D["quoted"] = (
    "select note_id, note_text, case when cast(note_id as bigint) % 2 = 0 then "
    f"upper(regexp_replace({pick('cast(note_id as bigint) % ' + str(_n), fx.CLINICAL_PHRASES)}, '[.,;]', '', 'g')) "
    f"else {pick('(cast(note_id as bigint) + 5) % ' + str(_n), fx.CLINICAL_PHRASES)} end as evidence_text from v_clinical"
)
D["signs"] = "select note_id, unnest(string_split(note_text, '')) as c, unnest(range(length(note_text))) as i from v_clinical"
D["held"] = (
    "select note_id, i, case when regexp_matches(c, '\\s') then ' ' else lower(c) end as c from signs where regexp_matches(c, '[\\p{L}\\p{N}\\s]')"
)
D["folded"] = (
    "select note_id, string_agg(c, '' order by i) as form, list(i order by i) as idx from ("
    "select *, lag(c) over (partition by note_id order by i) as before from held) where c <> ' ' or (before is not null and before <> ' ') group by note_id"
)
D["found"] = f"select q.note_id, note_text, evidence_text, {_mf('evidence_text')} as form_q, instr(form, {_mf('evidence_text')}) as pos, idx from quoted q join folded f on q.note_id = f.note_id"
SQL["evidence_spans"] = _with(
    ["found"],
    "select note_id, evidence_text, pos > 0 as grounded, quote_start, quote_end, note_text[quote_start + 1 : quote_end] as quote_text from ("
    "select *, cast(case when pos > 0 then idx[pos] end as integer) as quote_start, cast(case when pos > 0 then idx[pos + length(form_q) - 1] + 1 end as integer) as quote_end from found)",
)



def _rule_sql():
    from ..operators import extraction as ex

    def best(column: str, order: str) -> str:
        return f"(select {column} from note_said s where s.note_id = v.note_id and {column} is not null order by {order} limit 1)"

    SQL["severity_rules"] = _with(
        ["note_said"],
        "select v.note_id, case when l > 0 then cast(l as varchar) else 'N/A' end as severity_level from v_clinical v "
        "join (select note_id, max(severity) as l from note_said group by note_id) s on v.note_id = s.note_id",
    )
    SQL["intensity_rules"] = _with(
        ["note_said"],
        "select v.note_id, case l when 3 then 'high' when 2 then 'moderate' when 1 then 'low' else 'N/A' end as intensity from v_clinical v "
        "join (select note_id, max(case intensity when 'high' then 3 when 'moderate' then 2 when 'low' then 1 else 0 end) as l from note_said group by note_id) s on v.note_id = s.note_id",
    )
    first = lambda what, flag: f"arg_min({what}, ord) filter ({flag})"
    D["rec"] = (
        f"select patient_id, note_id, {first('said', 'gone = 1')} as gone, {first('said', 'start = 1')} as st, {first('said', 'stop = 1')} as en, {first('said', 'denied = 1')} as de, "
        f"{first('said', 'planned = 1')} as pl_, {first('said', 'drug = 1')} as dr, {first('start_date', 'start_date is not null')} as confirmed_start_date, "
        f"{first('stop_date', 'stop_date is not null')} as confirmed_end_date from note_said group by patient_id, note_id"
    )
    D["record"] = (
        "select patient_id, note_id, case when gone is not null then 'deceased_or_ineligible' when st is not null then 'confirmed_start' when en is not null then 'confirmed_end' "
        "when de is not null then 'denied' when pl_ is not null then 'planned_only' when dr is not null then 'ambiguous' else 'no_mention' end as enrollment_status, "
        "st is not null as confirmed_start, confirmed_start_date, en is not null as confirmed_end, confirmed_end_date, "
        "case when gone is not null or confirmed_start_date is not null or confirmed_end_date is not null then 'high' when st is not null or en is not null then 'medium' else 'low' end as confidence, "
        "coalesce(gone, st, en, de, pl_, dr) as evidence_text from rec"
    )
    SQL["status_rules"] = _with(
        ["record"], "select note_id, enrollment_status, confirmed_start, confirmed_start_date, confirmed_end, confirmed_end_date, confidence, evidence_text from record"
    )
    SQL["enrollment_from_notes"] = _with(
        ["record"],
        "select *, any_confirmed_start and not any_ineligible as enrolled from (select patient_id as mrn, bool_or(confirmed_start) as any_confirmed_start, "
        "bool_or(enrollment_status = 'deceased_or_ineligible') as any_ineligible, "
        f"cast(min(case when confirmed_start then {mdyy('confirmed_start_date')} end) as varchar) as enrollment_start_date, "
        f"cast(max(case when confirmed_end then {mdyy('confirmed_end_date')} end) as varchar) as enrollment_end_date from record group by patient_id)",
    )
    SQL["chronicity_rules"] = _with(
        ["note_said"],
        "select patient_id, mention_notes, mention_dates, chronic_notes, chronic_notes > 0 or mention_dates >= 2 as qualifies from ("
        "select v.patient_id, count(distinct case when mention = 1 then v.note_id end) as mention_notes, count(distinct case when mention = 1 then v.contact_date end) as mention_dates, "
        "count(distinct case when kind is not null then v.note_id end) as chronic_notes from v_clinical v join note_said s on v.note_id = s.note_id group by v.patient_id)",
    )
    D["mdates"] = f"select *, coalesce({mdyy('mention_date')}, contact_date) as d from note_said where mention = 1"
    # Episodes without windows over gaps: a date opens one if no other mention stands in the 30 days before it.
    D["mdays"] = "select distinct patient_id, d from mdates"
    D["opens"] = "select a.patient_id, a.d from mdays a where not exists (select 1 from mdays b where b.patient_id = a.patient_id and b.d < a.d and a.d - b.d <= 30)"
    D["inep"] = "select m.patient_id, m.d, (select count(*) from opens o where o.patient_id = m.patient_id and o.d <= m.d) as episode from mdays m"
    SQL["chronic_entries"] = _with(
        ["mdates", "inep"],
        'select m.patient_id, m.note_id, cast(s_start as integer) as "start", cast(s_start + length(said) as integer) as "end", said as evidence_text, mention_date as time, '
        "case when mention_date is null then relative end as time_description, case when severity > 0 then cast(severity as varchar) else 'N/A' end as severity_level, "
        "cast(e.episode as integer) as episode, (select count(*) from inep x where x.patient_id = m.patient_id and x.episode = e.episode) as episode_dates, "
        "coalesce(kind, case when (select max(episode) from inep x where x.patient_id = m.patient_id) > 1 then 'recurrent' "
        "when (select count(*) from inep x where x.patient_id = m.patient_id) > 1 then 'persistent' end) as chronicity_indicator "
        "from mdates m join inep e on m.patient_id = e.patient_id and m.d = e.d",
    )
    SQL["relative_time"] = _with(["note_said"], f"select note_id, {best('relative', 'ord')} as time_description from v_clinical v")
    SQL["date_grounding"] = _with(
        ["v_clinical"],
        f"select note_id, time, case when list_contains(list_filter(list_transform(regexp_extract_all(note_text, {q(ex.DATE_MENTION_PATTERN)}), "
        f"lambda s: {_normdate('s')}), lambda s: s is not null), {_normdate('time')}) then {_normdate('time')} end as grounded_time from "
        "(select note_id, note_text, case cast(note_id as bigint) % 4 when 0 then '2/15/24' when 1 then '12/5/23' when 2 then '2/1/24' end as time from v_clinical)",
    )
    out_fmts = ("%-m/%-d/%y", "%-m/%-d/%Y", "%B %-d, %Y", "%b %Y", "%B %Y")
    raw = "case " + " ".join(f"when o_orderkey % 5 = {j} then strftime(d, '{f}')" for j, f in enumerate(out_fmts)) + " end"
    SQL["date_normalize"] = (
        f"select note_id, raw, {_normdate('raw')} as normalized from (select cast(o_orderkey as varchar) as note_id, {raw} as raw from "
        "(select o_orderkey, cast(cast(o_orderdate as date) + interval 300 month as date) as d from orders))"
    )


_rule_sql()


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
