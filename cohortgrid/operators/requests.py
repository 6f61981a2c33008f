"""Model request table and agreement with annotations.

The model service itself is outside this library: ``requests`` renders
one request row per (note, stage) that has no answer yet, and answers
come back as a table, by the request's id or by (note_id, stage).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.status import is_positive
from ..spec import DEFAULT_KEYWORDS
from .extraction import passage

# Short task headers per stage (instruction wording is supplied by the user
# of the library; these defaults only name the task).
STAGE_HEADERS = {
    "summarizer": "Return only the passages of this note about the study drug, verbatim.",
    "extractor": "Return the phenotype findings of these passages as a JSON array.",
    "validator": "Validate the extracted findings against this note; return a JSON array.",
    "enrollment": "Return what this note states about starting or stopping the study drug as JSON.",
    "prior_events": "Return the chronic or recurrent phenotype findings of this note as a JSON array.",
}


def _extractions(responses: DataFrame) -> DataFrame:
    """(note_id, extraction) of the notes that have one."""
    given = responses.filter((F.col("stage") == "extractor") & F.col("response").isNotNull())
    return given.groupBy("note_id").agg(F.max("response").alias("extraction"))


def request_ledger(notes: DataFrame, responses: DataFrame, headers: Mapping[str, str] = STAGE_HEADERS) -> DataFrame:
    """(note_id, stage, request_id) of every request that can be made:
    each note with text and each stage, the validator's once there is an
    extraction. The id is a digest of what is asked: the note's text, the
    stage, its instruction, and for the validator the extraction. It changes
    with any of them. Only digests leave the scan of the texts."""
    known = notes.filter(F.col("note_text").isNotNull()).select(F.col("note_id").cast("string").alias("note_id"), F.sha2("note_text", 256).alias("digest"))
    told = _extractions(responses).select("note_id", F.sha2("extraction", 256).alias("told"))
    known = known.join(told, "note_id", "left")

    def asked(stage: str, header: str) -> Column:
        parts = [F.lit(stage), F.sha2(F.lit(header), 256), F.col("digest")]
        if stage == "validator":
            parts.append(F.col("told"))
        return F.struct(F.lit(stage).alias("stage"), F.sha2(F.concat(*(F.concat(p, F.lit("\n")) for p in parts)), 256).alias("request_id"))

    rows = known.select("note_id", F.inline(F.array(*(asked(k, v) for k, v in headers.items()))))
    return rows.filter(F.col("request_id").isNotNull())


def open_requests(ledger: DataFrame, responses: DataFrame) -> DataFrame:
    """The ledger's rows without an answer. Responses that name the
    ``request_id`` they answer match it alone, so a changed note or
    instruction is asked again; others answer their (note_id, stage)."""
    by = ["request_id"] if "request_id" in responses.columns else ["note_id", "stage"]
    answered = responses.filter(F.col("response").isNotNull()).select(*by).distinct()
    return ledger.join(answered, by, "left_anti")


def requests(
    notes: DataFrame,
    responses: DataFrame,
    headers: Mapping[str, str] = STAGE_HEADERS,
    keywords: Iterable[str] = DEFAULT_KEYWORDS,
) -> DataFrame:
    """(note_id, stage, request_id, request_text) for every open
    request of the ledger. The extractor reads the note's passages about the
    drug, the validator the note and the extraction to validate (so its
    request waits for that response), the others the note. ``responses`` is
    (note_id, stage, response[, request_id]); a null response is no answer.

    What is open is found on ids and digests; then a note's open stages, at
    most one of each, meet its text once. Notes have different ids."""
    waiting = open_requests(request_ledger(notes, responses, headers), responses)
    of_note = waiting.groupBy("note_id").agg(F.map_from_entries(F.collect_list(F.struct("stage", "request_id"))).alias("open"))
    n = notes.filter(F.col("note_text").isNotNull()).select(F.col("note_id").cast("string").alias("note_id"), "note_text")
    n = n.join(of_note, "note_id").join(_extractions(responses), "note_id", "left")
    both = F.concat(F.lit("ORIGINAL_NOTE:\n"), F.col("note_text"), F.lit("\n\nEXTRACTION:\n"), F.col("extraction"))
    body = {"extractor": passage("note_text", keywords), "validator": both}

    def rendered(stage: str, header: str) -> Column:
        text = F.concat(F.lit(f"{header}\n\n"), body.get(stage, F.col("note_text")))
        asked = F.element_at("open", F.lit(stage))
        return F.when(asked.isNotNull(), F.struct(F.lit(stage).alias("stage"), asked.alias("request_id"), text.alias("request_text")))

    rows = F.filter(F.array(*(rendered(k, v) for k, v in headers.items())), lambda r: r.isNotNull())
    return n.select("note_id", F.inline(rows))


def attach_responses(notes: DataFrame, responses: DataFrame, stages: Iterable[str] = tuple(STAGE_HEADERS)) -> DataFrame:
    """Each note's responses as one column per stage; a stage without
    a response is null, a repeated one takes the greatest text."""
    wide = responses.groupBy("note_id").agg(*[F.max(F.when(F.col("stage") == s, F.col("response"))).alias(s) for s in stages])
    return notes.select(F.col("note_id").cast("string").alias("note_id")).join(wide, "note_id", "left")


def agreement(cells: DataFrame, annotations: DataFrame) -> DataFrame:
    """Cells assessed by both sides, and how many agree on positive vs
    not, as counts and as a percentage (null when none is compared); keys
    (mrn, variable, time_bucket)."""
    c = cells.filter(F.col("cell").isNotNull())
    a = annotations.filter(F.col("annotation").isNotNull())
    j = c.join(a, ["mrn", "variable", "time_bucket"])
    same = is_positive("cell") == is_positive("annotation")
    counts = j.agg(F.count(F.lit(1)).alias("compared"), F.count_if(same).alias("matched"))
    return counts.withColumn("percent", F.round(F.try_divide(F.col("matched") * 100.0, F.col("compared")), 1))
