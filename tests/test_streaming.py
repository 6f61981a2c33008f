import os
import tempfile

from pyspark.sql import functions as F

from cohortgrid.operators import notes as nt
from cohortgrid.sources import fixtures as fx
from cohortgrid.sources.sinks import read_stage
from cohortgrid.sources.tables import Tables
from cohortgrid.streaming.notes import start_mention_stream
from conftest import SF_SMALL


def test_stream_matches_batch(spark):
    t = Tables(spark, SF_SMALL)
    notes = fx.notes(t)
    ids = nt.resolve_cohort(fx.patients(t), fx.mapping(t))
    root = tempfile.mkdtemp(prefix="cg-stream-")
    src = os.path.join(root, "src")
    # two arriving files
    notes.filter(F.col("note_id").cast("long") % 2 == 0).write.parquet(os.path.join(src, "a"))
    notes.filter(F.col("note_id").cast("long") % 2 == 1).write.parquet(os.path.join(src, "b"))
    schema = notes.schema
    q1, q2 = start_mention_stream(
        spark, os.path.join(src, "*"), schema, ids, os.path.join(root, "chunks"), os.path.join(root, "anchors"),
        keywords=fx.FIXTURE_KEYWORDS, max_chars=fx.FIXTURE_MAX_CHARS, checkpoint=os.path.join(root, "ckpt"),
    )
    q1.awaitTermination()
    q2.awaitTermination()
    got = spark.read.parquet(os.path.join(root, "chunks"))
    exp = nt.chunk_text(nt.mention_filter(notes, ids, fx.FIXTURE_KEYWORDS), fx.FIXTURE_MAX_CHARS)
    cols = ["patient_id", "note_id", "note_text", "mrn"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, exp.select(cols).collect()))
    anchors = {r["mrn"]: r["medication_start_date"] for r in read_stage(spark, os.path.join(root, "anchors")).collect()}
    batch = {r["mrn"]: r["medication_start_date"] for r in nt.with_first_mention(nt.mention_filter(notes, ids, fx.FIXTURE_KEYWORDS)).select("mrn", "medication_start_date").distinct().collect()}
    assert anchors == batch
