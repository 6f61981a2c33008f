"""Quality rules with host-level verdicts.

Rules are counted on every whole text. Their failures are aggregated by
host, each host's failure rate of each rule is shrunk towards the corpus
rate by a beta prior fitted to all hosts (a host with few documents says
little about itself), and the verdict of the host is joined back to its
documents: a host whose shrunk rate of some rule reaches ``max_rate`` is
rejected with all its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgrid.llm.arrays import SPACE, row_slices, span_codes, utf8, words
from cohortgrid.llm.storage import kept, scratch, written

# The symbols that are counted, and the length of a window.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
SALTS = 32

#: Failed rules per document, over the measures; base rules come first.
RULES = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words)",
}
BASE_RULES = ("short", "repeats")

#: The least and greatest weight of the prior, in documents. Hosts that
#: differ wildly fit a prior of no weight; one document is no verdict yet.
MIN_STRENGTH, MAX_STRENGTH = 10.0, 1e6


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row its lines with a word, and those equal to an earlier one."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    row = np.repeat(np.arange(n), _per_row(data == 0x0A, offsets) + 1)
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~SPACE[data], out=filled[1:])
    held = filled[ends] > filled[starts]
    row = row[held]
    codes, distinct = span_codes(data, starts[held], ends[held])
    different = np.unique(row * max(len(distinct), 1) + codes) // max(len(distinct), 1)
    lines = np.bincount(row, minlength=n)
    return lines, lines - np.bincount(different, minlength=n)


def _repeated(codes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Per row the words in windows that the row holds twice or more.
    Windows get exact numbers by doubling: a window of 2k words is the pair
    of its halves' numbers."""
    if len(codes) < WINDOW:
        return np.zeros(n, np.int64)
    ids, width = codes, 1
    while width < WINDOW:
        pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        ids = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        width *= 2
    at = np.flatnonzero(row[: len(ids)] == row[WINDOW - 1 :])
    if not len(at):
        return np.zeros(n, np.int64)
    _, which, count = np.unique(row[at] * (int(ids.max()) + 1) + ids[at], return_inverse=True, return_counts=True)
    at = at[count[which] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.subtract.at(edge, at + WINDOW, 1)
    return np.bincount(row[np.cumsum(edge[:-1]) > 0], minlength=n)


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The measures of the rows of one slice, as int64 arrays."""
    n = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    row = np.repeat(np.arange(n), np.diff(first))
    codes, _ = span_codes(data, starts, ends)
    lines, repeated_lines = _lines(data, offsets)
    chars = _per_row(~SPACE[data] & ((data & 0xC0) != 0x80), offsets)
    out = (np.diff(first), chars, _per_row(SYMBOLS[data], offsets), lines, repeated_lines, _repeated(codes, row, n))
    return [x.astype(np.int64) for x in out]


def measured(docs: DataFrame, host: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, host, measures) per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for lo, hi in row_slices(offsets):
                cut = offsets[lo : hi + 1]
                values = measure(data[cut[0] : cut[-1]], cut - cut[0])
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(1)[lo:hi], *map(pa.array, values)], names=["id", "host", *MEASURES])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), host.cast("string").alias("host"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "id long, host string, " + ", ".join(f"{m} long" for m in MEASURES))


def host_counts(rows: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Documents and failures of each rule, per host (null is a host)."""
    return rows.groupBy("host").agg(F.count("*").alias("documents"), *(F.count_if(F.expr(rule)).alias(f"f_{name}") for name, rule in rules.items()))


def beta_priors(hosts: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row: per rule the corpus rate (``m_``) and the weight (``s_``) of
    the beta prior of the hosts' rates, by moments: the spread between
    hosts beyond what equal rates would give by chance. No such spread, or
    a single host, gives the greatest weight; a prior has a least one too."""
    n = F.sum("documents").cast("double")
    squares = F.sum(F.col("documents").cast("double") * F.col("documents"))
    sums = hosts.agg(n.alias("n"), squares.alias("n2"), F.count("*").cast("double").alias("h"), *(c for r in rules for c in (F.sum(f"f_{r}").cast("double").alias(f"t_{r}"), F.sum(F.col(f"f_{r}").cast("double") * F.col(f"f_{r}") / F.col("documents")).alias(f"q_{r}"))))
    out = []
    for r in rules:
        mean = F.try_divide(f"t_{r}", "n")
        spread = F.col(f"q_{r}") - mean * F.col(f"t_{r}")
        chance = mean * (1 - mean)
        excess = F.try_divide(spread - chance * (F.col("h") - 1), chance * (F.col("n") - F.try_divide("n2", "n") - (F.col("h") - 1)))
        weight = F.when(excess > 0, F.least(1 / excess - 1, F.lit(MAX_STRENGTH))).otherwise(MAX_STRENGTH)
        out += [mean.alias(f"m_{r}"), F.greatest(weight, F.lit(MIN_STRENGTH)).alias(f"s_{r}")]
    return sums.select(*out)


def host_verdicts(hosts: DataFrame, rules: dict[str, str], max_rate: float) -> DataFrame:
    """Per host its shrunk rates (``p_``) and whether one of them reaches
    ``max_rate``. The prior is one row of a few numbers."""
    prior = beta_priors(hosts, rules).first()
    rates = {}
    for r in rules:
        mean, weight = (prior[f"m_{r}"] or 0.0, prior[f"s_{r}"] or 0.0)
        rates[f"p_{r}"] = F.round((F.col(f"f_{r}") + F.lit(mean * weight)) / (F.col("documents") + F.lit(weight)), 9)
    return hosts.select("host", *(c.alias(k) for k, c in rates.items())).withColumn("host_rate", F.greatest(F.lit(0.0), *rates)).withColumn("host_rejected", F.col("host_rate") >= max_rate)


def quality_rules(docs: DataFrame, host: Column, max_rate: float = 0.5, rules: dict[str, str] = RULES, base_rules: tuple[str, ...] = BASE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, host_rate,
    host_rejected).

    ``rules`` are SQL conditions over the measures that a failing document
    meets, all with rates by host; failing one of ``base_rules`` rejects the
    document itself. A host's verdict rests on every rule but the base ones,
    whose documents go anyway. Null texts have no words (and so fail the
    base rules); rows with a null host are one host; ids may be null or
    repeated, rows are kept apart. Other columns are ignored. An empty table
    gives no rows.

    A host with a third of all rows is folded before the shuffle, and its
    rows are spread over salts when the verdict joins them.
    """
    spark = docs.sparkSession
    with scratch(spark):
        rows = written(measured(docs, host, id_col, text_col), "quality-measures")
        by_host = {name: rule for name, rule in rules.items() if name not in base_rules}
        hosts = written(host_counts(rows, by_host), "quality-hosts")
        verdicts = host_verdicts(hosts, by_host, max_rate).select(F.col("host").alias("of"), "host_rate", "host_rejected", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt_of"))
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", *MEASURES), F.lit(SALTS)).cast("int"))
        joined = salted.join(verdicts, F.col("host").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("salt_of")), "left")
        failed = F.greatest(F.lit(False), F.lit(False), *(F.expr(rules[r]) for r in base_rules))
        out = joined.withColumn("base_failed", failed)
        result = out.select(
            F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"), "host_rate", "host_rejected",
        )
        return kept(result, "quality-rules")
