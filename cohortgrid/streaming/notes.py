"""Stage 1 over note files that keep arriving (Structured Streaming).

The stateless part of stage 1 (date floor, cohort join, keyword filter,
chunking) runs per micro-batch as a stream-static join; the per-patient
first mention date is a streaming ``min`` whose state is one row per
patient. The anchor lookback (C4) and whole-row dedup (C5) need the
finished anchor, so they stay a batch step over the sink
(``operators.notes.anchor_lookback`` / ``dedup_rows``).

Checkpoints go under the session's ``spark.checkpoint.dir`` unless a
location is given; the query is exactly-once with the file sink.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.notes import chunk_text, mention_filter
from ..sources.sinks import checkpoint_dir, publish, vacuum
from ..spec import DEFAULT_KEYWORDS, DEFAULT_MAX_CHARS, DEFAULT_NOTE_FLOOR


def first_mentions(mentions: DataFrame) -> DataFrame:
    """Per patient the earliest mention date (state: one row per mrn)."""
    return mentions.groupBy("mrn").agg(F.min("contact_date").alias("medication_start_date"))


def _location(spark: SparkSession, name: str, given: str | None) -> str:
    return given or f"{checkpoint_dir(spark).rstrip('/')}/cohortgrid-stream/{name}"


def start_mention_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    cohort_ids: DataFrame,
    chunks_path: str,
    anchors_path: str,
    keywords: Iterable[str] = DEFAULT_KEYWORDS,
    floor: str | None = DEFAULT_NOTE_FLOOR,
    max_chars: int = DEFAULT_MAX_CHARS,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start two queries over a folder of note parquet files: chunked
    mention rows appended to ``chunks_path``, and the first-mention table
    published as a new version of ``anchors_path`` after every micro-batch
    (``sources.sinks.read_stage`` reads the latest; older ones go)."""
    notes = spark.readStream.schema(schema).parquet(source_dir)
    hits = mention_filter(notes, cohort_ids, keywords, floor)
    chunks = chunk_text(hits, max_chars)

    def trig(w):
        return w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")

    q1 = trig(
        chunks.writeStream.format("parquet")
        .option("path", chunks_path)
        .option("checkpointLocation", _location(spark, "chunks", checkpoint and f"{checkpoint}/chunks"))
        .outputMode("append")
    ).start()

    def write_anchors(batch: DataFrame, _epoch: int) -> None:
        publish(batch, anchors_path)
        vacuum(spark, anchors_path, keep=2)

    q2 = trig(
        first_mentions(hits)
        .writeStream.outputMode("complete")
        .foreachBatch(write_anchors)
        .option("checkpointLocation", _location(spark, "anchors", checkpoint and f"{checkpoint}/anchors"))
    ).start()
    return q1, q2
