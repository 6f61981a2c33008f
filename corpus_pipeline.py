"""The corpus pipeline: quality, exact copies, near copies, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet and the next stage reads that as its documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgrid.llm import quality_classifier
from cohortgrid.llm.exact_dedup import exact_dedup
from cohortgrid.llm.ngram_join import ngram_jaccard_join
from cohortgrid.llm.sentencepiece_viterbi import encode
from cohortgrid.llm.source_mix import mix_sources, source_sizes
from cohortgrid.llm.storage import table, workspace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, model, keep_cols=tuple(COLUMNS))
    return scored.filter("accepted").select(*COLUMNS)


def _rows_of(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """The documents whose id (null or not) and text key are in ``kept``;
    rows that agree in both are one, the first by a hash of their other
    columns. Both steps use one shuffle."""
    keyed = docs.select(*COLUMNS, key.alias("text_key"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_key"))
    wanted = kept.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_key"), "text_key")
    rest = ("lang", "source", "n_chars")
    first = F.min_by(F.struct(*COLUMNS), F.struct(F.xxhash64(*rest), *rest)).alias("row")
    return keyed.join(wanted, ["id_key", "text_key"], "left_semi").groupBy("id_key", "text_key").agg(first).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    kept = exact_dedup(docs).filter("kept").select("doc_id", F.col("text_sha256").alias("text_key"))
    folded = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return _rows_of(docs, F.sha2(folded, 256), kept)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    kept = ngram_jaccard_join(docs).filter("kept").select("doc_id", F.col("text_sha256").alias("text_key"))
    return _rows_of(docs, F.sha2(F.coalesce("text", F.lit("")), 256), kept)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed by the square roots of their sizes."""
    weights = source_sizes(docs).select("source", F.sqrt("size").alias("weight"))
    return mix_sources(docs, weights).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each copy that the mix holds."""
    coded = encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "ids", F.size("ids").alias("n_tokens"))


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mix", mix),
    ("tokens", tokens),
]

#: A trained classifier and a token search have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{workspace(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
