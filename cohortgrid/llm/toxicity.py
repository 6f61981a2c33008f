"""Toxicity by a weighted finite-state pattern grammar.

Small transducers read a clause's word classes: one marks words in the
scope of a negation, one those that report somebody's speech, one words
near a target, and one emits insults and threats. Their composition is one
transition table whose outputs are events (what, targeted, negated,
reported). A document's score is a logistic function of its events' weights
over its clauses, with hand-set weights as the prior of the learned ones.

Insults are word stems: a few fixed ones, and those that the labels of
training rows single out, in whatever language.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgrid.llm.arrays import row_slices, utf8
from cohortgrid.llm.logistic import fit, labelled_sample, one_per_id, predict, sigmoid
from cohortgrid.llm.ngram_join import shingle_sets
from cohortgrid.llm.recent import Recent
from cohortgrid.llm.storage import scratch, written

# Seed words by class.
INSULTS = "idiot moron stupid scum trash loser pathetic worthless disgusting".split()
THREATS = "kill hurt destroy murder strangle stab töten tuer matar".split()
TARGETS = "you your yours yourself he him she her they them these those du dich dir ihr sie tu toi te vous il elle tú te usted ustedes él ella".split()
NEGATIONS = "not no never nobody none isn't aren't wasn't don't doesn't didn't nicht kein keine nie ne pas jamais no nunca".split()
REPORTS = "said says say wrote writes called calls quoted claims reportedly sagte schrieb meinte dit écrit déclare dijo escribió".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
SCOPE = 4  # words that a negation or a target reaches
STEM_LENGTHS = range(3, 13)
_CLAUSE_END = re.compile(r"[.,;:!?|)\]]\W*$")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
KNOWN_PIECES = 200_000


# --- transducers: (state, class) -> (state, output) ------------------------


def _counting(trigger: int):
    """States 0..SCOPE: words since the trigger that are still in scope;
    outputs whether the word read is."""
    return [[(0 if c == END else SCOPE if c == trigger else max(0, s - 1), int(s > 0)) for c in range(7)] for s in range(SCOPE + 1)]


NEGATED = _counting(NEGATION)
TARGETED = _counting(TARGET)
REPORTED = [[(0 if c == END else 1 if c == REPORT else s, s) for c in range(7)] for s in range(2)]
HIT = [[(0, {INSULT: 1, THREAT: 2}.get(c, 0)) for c in range(7)]]


def compose(*machines: list) -> tuple[list[list[int]], list[list[tuple]]]:
    """The product of transducers over the same input: next states, and
    the outputs of all of them together."""
    index, queue, step, out = {(0,) * len(machines): 0}, [(0,) * len(machines)], [], []
    for state in queue:
        moves, outputs = [], []
        for c in range(7):
            pairs = [m[s][c] for m, s in zip(machines, state, strict=True)]
            nxt = tuple(p[0] for p in pairs)
            if nxt not in index:
                index[nxt] = len(queue)
                queue.append(nxt)
            moves.append(index[nxt])
            outputs.append(tuple(p[1] for p in pairs))
        step.append(moves)
        out.append(outputs)
    return step, out


STEP, OUT = compose(HIT, TARGETED, NEGATED, REPORTED)
#: Events in the order of the features: (hit, targeted, negated, reported).
EVENTS = [(h, t, n, r) for h in (1, 2) for t in (0, 1) for n in (0, 1) for r in (0, 1)]
EVENT_OF = {e: k for k, e in enumerate(EVENTS)}
#: Prior weights: an event counts less when negated or reported, more when aimed at someone.
PRIOR = np.array([(1.5 if h == 1 else 1.0) + 0.5 * t - 0.5 * n - 0.5 * r for h, t, n, r in EVENTS] + [1.0, -3.0])


def clause_events(codes: list[tuple[int, float]]) -> np.ndarray:
    """Summed weights by event of one document's (class, weight) sequence
    with END marks, and the largest sum of one clause. A target after the
    hit in the same clause counts too."""
    total, largest = np.zeros(len(EVENTS)), 0.0
    state, hits, aimed = 0, [], 0  # the first ``aimed`` hits have a target behind them

    def close() -> float:
        weight = 0.0
        for k, ((h, t, n, r), w) in enumerate(hits):
            total[EVENT_OF[(h, max(t, int(k < aimed)), n, r)]] += w
            weight += w * (1 - 0.5 * n) * (1 - 0.5 * r)
        hits.clear()
        return weight

    for c, w in codes:
        output = OUT[state][c]
        state = STEP[state][c]
        if output[0]:
            hits.append((output, w))
        elif c == TARGET:
            aimed = len(hits)
        elif c == END:
            largest, aimed = max(largest, close()), 0
    largest = max(largest, close())
    return np.r_[np.log1p(total), math.log1p(largest)]


# --- words -----------------------------------------------------------------


@dataclass
class Lexicon:
    """Classes of white-space pieces, found once for each recent piece."""

    stems: dict[str, float]
    fixed: dict[str, int] = field(init=False)
    known: Recent = field(init=False)

    def __post_init__(self) -> None:
        self.fixed = {w: k for k, group in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in group}
        self.known = Recent(KNOWN_PIECES)

    def weight(self, word: str) -> float:
        return max((self.stems[word[:k]] for k in range(1, len(word) + 1) if word[:k] in self.stems), default=0.0)

    def codes(self, piece: str) -> tuple:
        """() for a plain word, else its marks in the order of the text."""
        out = []
        for m in _WORD.finditer(piece):
            word = m.group().replace("’", "'")
            if w := self.weight(word):
                out.append((INSULT, w))
            elif k := self.fixed.get(word):
                out.append((k, 1.0))
        if _CLAUSE_END.search(piece) or not _WORD.search(piece):
            out.append((END, 0.0))
        return tuple(out)

    def features(self, texts: list[str]) -> np.ndarray:
        split = [t.lower().replace("\n", " | ").split() for t in texts]
        young = self.known.young
        for piece in self.known.missing(set().union(*split)):
            self.known.young[piece] = self.codes(piece)
        young = self.known.young
        out = np.zeros((len(texts), len(EVENTS) + 1))
        plain = ((OTHER, 0.0),)
        for row, pieces in enumerate(split):
            codes = [young[p] for p in pieces]
            if any(m[0] in (INSULT, THREAT) for c in codes for m in c):
                out[row] = clause_events([x for c in codes for x in (c or plain)])
        return out


# --- training --------------------------------------------------------------


def _stems_of(text: str) -> set[str]:
    words = {w.replace("’", "'") for w in _WORD.findall(text.lower())}
    return {w[:k] for w in words for k in STEM_LENGTHS if k <= len(w)} | words


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by stem of toxic and clean documents, once per batch slice."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            toxic, clean = Counter(), Counter()
            for label, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                (toxic if label else clean).update(_stems_of(text))
            stems = list(toxic.keys() | clean.keys())
            yield pa.record_batch([pa.array(stems, pa.string()), pa.array([toxic[s] for s in stems], pa.int64()), pa.array([clean[s] for s in stems], pa.int64())], ["stem", "toxic", "clean"])


def _family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hash of a text's shingles: near copies mostly share it."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for lo, hi in row_slices(offsets):
            sets = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], 5)
            least = [int(s[0].view(np.int64)) if len(s) else 0 for s in sets]
            part = batch.slice(lo, hi - lo)
            yield pa.record_batch([part.column(0), pa.array(least, pa.int64()), *(part.column(k) for k in range(1, part.num_columns))], ["id", "family", "text", "label"])


def learn_stems(sample: DataFrame, max_stems: int, chance: float) -> dict[str, float]:
    """Stems of (id, text, label) rows that are far commoner in toxic
    documents than chance allows for all the stems tried; near copies
    count once. Weights are log odds; at most ``max_stems``, by evidence."""
    family = F.min_by(F.struct("label", "text"), "id").alias("one")
    single = sample.select("id", "text", "label").mapInArrow(_family, "id long, family long, text string, label int").groupBy("family", "label").agg(family).select("one.*")
    size = single.agg(F.sum("label").alias("toxic"), F.count("*").alias("rows")).first()
    if not size["rows"] or not size["toxic"] or size["toxic"] == size["rows"]:
        return {}
    share = size["toxic"] / size["rows"]
    counts = single.select("label", "text").mapInArrow(_count_stems, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    seen = F.col("toxic") + F.col("clean")
    rate = F.col("toxic") / seen
    log_rest = F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - rate) / (1 - share))).otherwise(F.lit(0.0))
    evidence = F.col("toxic") * F.log(rate / share) + log_rest
    # Bound of a binomial tail, for some ten million stems tried.
    strong = counts.filter((F.col("toxic") > 0) & (rate > 0.8)).withColumn("evidence", evidence).filter(F.col("evidence") > math.log(1e7 / chance))
    rows = strong.orderBy(F.col("evidence").desc(), "stem").limit(max_stems).collect()
    n_toxic, n_clean = size["toxic"], size["rows"] - size["toxic"]
    odds = lambda r: math.log((r["toxic"] + 0.5) / (n_toxic + 1)) - math.log((r["clean"] + 0.5) / (n_clean + 1))
    # Of stems with about the same documents the longest says most.
    longest = [r for r in rows if not any(o["stem"] != r["stem"] and o["stem"].startswith(r["stem"]) and o["toxic"] >= 0.95 * r["toxic"] for o in rows)]
    return {r["stem"]: min(2.0, max(0.5, odds(r) / 3)) for r in longest}


@dataclass
class Model:
    lexicon: Lexicon
    coefficients: np.ndarray


def train(docs: DataFrame, labels: DataFrame, only, label_col: str = "toxic", max_labelled: int = 20_000, max_stems: int = 2_000, chance: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from at most ``max_labelled`` labelled rows for whose id
    ``only`` holds, one row of each id. Without labels the fixed words and prior weights hold."""
    with scratch(docs.sparkSession):
        return _train(docs, labelled_sample(labels, label_col, max_labelled, id_col, only), max_stems, chance, id_col, text_col)


def _train(docs: DataFrame, sample: DataFrame, max_stems: int, chance: float, id_col: str, text_col: str) -> Model:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # Bounded by max_labelled; written, so that the documents are read once.
    rows = written(one_per_id(rows.join(F.broadcast(sample), "id")), "toxicity-sample")
    stems = dict.fromkeys(INSULTS, 1.0) | learn_stems(rows, max_stems, chance)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(stems)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield pa.record_batch([part.column(0), part.column(2), pa.array(lexicon.features(part.column(1).to_pylist()).tolist(), pa.list_(pa.float64()))], ["id", "label", "features"])

    got = rows.select("id", "text", "label").mapInArrow(features, "id long, label int, features array<double>").toArrow()
    order = np.argsort(got.column(0).to_numpy())
    x = np.array(got.column(2).to_pylist(), float).reshape(-1, len(EVENTS) + 1)[order]
    return Model(Lexicon(stems), fit(x, got.column(1).to_numpy()[order].astype(float), prior=PRIOR, ridge=0.5))


def score(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, score, predicted).

    Only the text is read. A null or empty text has no events and the least
    score of all texts without hits; ids may be null or repeated; other
    columns are ignored; an empty table gives no rows. One pass, no shuffle.
    """
    stems, coefficients = model.lexicon.stems, model.coefficients

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(stems)
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for lo, hi in row_slices(offsets, 1 << 20):
                z = predict(coefficients, lexicon.features(batch.column(1)[lo:hi].to_pylist()))
                yield pa.record_batch([batch.column(0)[lo:hi], pa.array(sigmoid(z))], ["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = rows.mapInArrow(run, "id long, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
