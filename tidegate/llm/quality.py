"""Text quality from trusted positives and unlabelled text: non-negative positive-unlabelled learning.

The risk of a classifier g over positives P, unlabelled text U and class prior p is
``p R(P, +) + max(0, R(U, -) - p R(P, -))``. The bracket estimates the risk on negatives without bias
and must not be negative; where a batch drives it below zero, the step goes the other way. Labels of
negatives are never used.

The prior is estimated first: a plain P-against-U classifier ranks held-back rows of both, and the
least ratio of U's share to P's share above any score, with a margin for chance, bounds the share of
positives in U.

Features describe the shape of the whole text: which kinds of character follow which, word lengths,
repeated words. They are counted in numpy, in Spark tasks; a small two-layer network scores them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import words as W
from tidegate.llm.language import held_out
from tidegate.llm.repeated_windows import keyed
from tidegate.llm.scratch import shipped

#: Bounds of the training sample.
POSITIVE_ROWS = 6000
UNLABELLED_ROWS = 10000
HIDDEN = 16
EPOCHS = 60
MIN_STEPS = 600
BATCH = 500
RATE = 0.01

#: Kind of each byte: letters apart by case, bytes beyond ASCII as lower-case letters.
KINDS = np.full(256, 9, np.int64)
for _kind, _bytes in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", ".,;:", "!?", "#$%&*@^~", "|<>{}[]=_\\/")):
    KINDS[list(_bytes.encode())] = _kind
KINDS[0x80:] = 0
N_KINDS = 10
N_FEATURES = N_KINDS * N_KINDS + N_KINDS + 6


def features(column: pa.Array) -> np.ndarray:
    """(rows, N_FEATURES) of whole texts; an empty or null text is all zeros."""
    out = np.zeros((len(column), N_FEATURES), np.float32)
    pairs = N_KINDS * N_KINDS
    for texts in W.text_groups(column):
        n = len(texts.begin)
        size = texts.end - texts.begin
        kind = KINDS[texts.data]
        text = np.repeat(np.arange(n), size)
        both = np.bincount(text[1:] * pairs + kind[:-1] * N_KINDS + kind[1:], minlength=n * pairs).reshape(n, pairs) if len(kind) > 1 else np.zeros((n, pairs))
        ends = texts.begin[1:][(size[1:] > 0) & (texts.begin[1:] > 0)]
        if len(ends):  # pairs across two texts
            np.subtract.at(both, (text[ends], kind[ends - 1] * N_KINDS + kind[ends]), 1)
        one = np.bincount(text * N_KINDS + kind, minlength=n * N_KINDS).reshape(n, N_KINDS)
        words = W.find_words(texts, W.NON_SPACE)
        hashes = W.span_hashes(texts.data, words.start, words.end)
        long_ = (words.end - words.start).astype(np.float64)
        count = np.maximum(words.count, 1)
        order = np.lexsort((hashes, words.text))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (words.text[order][1:] != words.text[order][:-1])
        distinct = np.bincount(words.text[order][fresh], minlength=n)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
        row = out[texts.first : texts.first + n]
        length = np.maximum(size, 1)[:, None]
        row[:, :pairs] = np.sqrt(both / length)
        row[:, pairs : pairs + N_KINDS] = np.sqrt(one / length)
        mean = np.bincount(words.text, long_, minlength=n) / count
        square = np.bincount(words.text, long_ * long_, minlength=n) / count
        more = (
            np.log1p(size) / 10, mean / 10, np.sqrt(np.maximum(square - mean * mean, 0)) / 10, distinct / count,
            np.log1p(distinct) / np.log1p(count), np.bincount(words.text[again], minlength=n) / count,
        )
        row[:, pairs + N_KINDS :] = np.stack(more, axis=1) * (size > 0)[:, None]
    return out


@dataclass
class Scorer:
    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return _forward(self.weights, (x - self.centre) / self.scale)[1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x).astype(np.float64), -40, 40)))


def _forward(weights: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = weights
    hidden = np.tanh(x @ w1 + b1)
    return hidden, (hidden @ w2 + b2)[:, 0]


def _backward(weights: list[np.ndarray], x: np.ndarray, hidden: np.ndarray, g: np.ndarray) -> list[np.ndarray]:
    inner = g[:, None] * weights[2][:, 0] * (1 - hidden * hidden)
    return [x.T @ inner, inner.sum(axis=0), hidden.T @ g[:, None], g.sum(keepdims=True)]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def non_negative_risk(weights: list[np.ndarray], positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, list[np.ndarray]]:
    """The risk under logistic loss, and the gradient to step against."""
    hp, zp = _forward(weights, positive)
    hu, zu = _forward(weights, unlabelled)
    plus, minus = np.logaddexp(0, -zp).mean(), np.logaddexp(0, zp).mean()
    negative = np.logaddexp(0, zu).mean() - prior * minus
    g_plus, g_minus = -_sigmoid(-zp) / len(zp), _sigmoid(zp) / len(zp)
    g_u = _sigmoid(zu) / len(zu)
    if negative >= 0:
        gp, gu = prior * (g_plus - g_minus), g_u
    else:
        gp, gu = prior * g_minus, -g_u
    grads = [a + b for a, b in zip(_backward(weights, positive, hp, gp), _backward(weights, unlabelled, hu, gu))]
    return prior * plus + max(0.0, negative), grads


def plain_risk(weights: list[np.ndarray], positive: np.ndarray, unlabelled: np.ndarray, _: float) -> tuple[float, list[np.ndarray]]:
    """Logistic loss of telling positives from unlabelled rows."""
    hp, zp = _forward(weights, positive)
    hu, zu = _forward(weights, unlabelled)
    grads = [
        a + b
        for a, b in zip(
            _backward(weights, positive, hp, -_sigmoid(-zp) / len(zp)), _backward(weights, unlabelled, hu, _sigmoid(zu) / len(zu))
        )
    ]
    return np.logaddexp(0, -zp).mean() + np.logaddexp(0, zu).mean(), grads


def _optimise(risk, positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int, seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    d = positive.shape[1]
    weights = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    batches = max(1, len(unlabelled) // BATCH)
    epochs = max(epochs, -(-MIN_STEPS // batches))
    step, steps = 0, epochs * batches
    for _ in range(epochs):
        p_parts, u_parts = (np.array_split(rng.permutation(len(x)), batches) for x in (positive, unlabelled))
        for p, u in zip(p_parts, u_parts):
            if not len(p) or not len(u):
                continue
            step += 1
            grads = risk(weights, positive[p], unlabelled[u], prior)[1]
            rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
            for w, g, m, v in zip(weights, grads, first, second):
                g = g + 1e-4 * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return weights


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """Share of positives among unlabelled rows, from scores of rows the scorer was not fitted on."""
    cuts = np.sort(positive)
    above_p = 1 - np.searchsorted(cuts, cuts, side="left") / len(cuts)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), cuts, side="left") / len(unlabelled)
    slack = np.sqrt(np.log(4 / confidence) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, seed: int = 11) -> Scorer:
    """A scorer from feature rows; the prior is estimated where none is given."""
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    centre, scale = both.mean(axis=0), both.std(axis=0) + 0.05
    p, u = (positive - centre) / scale, (unlabelled - centre) / scale
    if prior is None:
        weights = _optimise(plain_risk, p[::2], u[::2], 0.5, EPOCHS // 4, seed)
        prior = estimate_prior(_forward(weights, p[1::2])[1], _forward(weights, u[1::2])[1])
    return Scorer(centre, scale, _optimise(non_negative_risk, p, u, prior, EPOCHS, seed), prior)


def training_rows(docs: DataFrame, positive_ids: DataFrame, known_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tag, positive, features) of a bounded sample: rows of `positive_ids`, and rows of no `known_ids`, by a hash.

    A row is an id and its text: copies of both are one, however many there are, and texts that share
    an id are rows of their own. Rows without an id teach nothing.
    """
    named = keyed(docs, id_col, text_col).where("doc_id is not null")
    key = F.xxhash64("id", "tag")

    def drawn(rows: DataFrame, most: int) -> DataFrame:
        return rows.select("id", "tag").distinct().orderBy(key, "id", "tag").limit(most)

    ids = named.select("id", "tag")
    positive = drawn(ids.join(positive_ids.select(F.col(id_col).alias("id")).distinct(), "id"), POSITIVE_ROWS)
    unlabelled = drawn(ids.join(known_ids.select(F.col(id_col).alias("id")).distinct(), "id", "left_anti"), UNLABELLED_ROWS)
    chosen = positive.withColumn("positive", F.lit(True)).union(unlabelled.withColumn("positive", F.lit(False)))
    texts = named.select("id", "tag", "text").join(F.broadcast(chosen), ["id", "tag"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = pa.array([r.tobytes() for r in features(batch.column(3))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], raw], ["id", "tag", "positive", "features"])

    read = texts.select("id", "tag", "positive", "text").mapInArrow(rows, "id long, tag long, positive boolean, features binary")
    return read.dropDuplicates(["id", "tag"])


def fit_on(docs: DataFrame, positive_ids: DataFrame, known_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Scorer | None:
    """None where there are no positives or no unlabelled rows."""
    sample = sorted((r.positive, r.id, r.tag, r.features) for r in training_rows(docs, positive_ids, known_ids, id_col, text_col).collect())
    parts = [np.array([np.frombuffer(f, np.float32) for p, *_, f in sample if p is want]) for want in (True, False)]
    if min(len(x) for x in parts) < 2:
        return None
    return fit(*parts)


def score_texts(docs: DataFrame, scorer: Scorer | None, text_col: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) of each whole text; 0.5 everywhere without a scorer. Null and empty texts are scored as texts without characters."""
    fields = [f for f in docs.schema.fields if f.name != "score"]
    kept = docs.select(*(F.col(f"`{f.name}`") for f in fields), F.col(text_col).cast("string").alias("_read"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.full(batch.num_rows, 0.5) if scorer is None else scorer.score(features(batch.column(len(fields))))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(fields))), pa.array(score)], [*(f.name for f in fields), "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", score double"
    return kept.mapInArrow(rows, schema)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = shipped(spark).read
    docs, labels = read.parquet(f"{sf_dir}/documents.parquet"), read.parquet(f"{sf_dir}/labels.parquet")
    held = held_out("doc_id", 3, 1)
    trusted = labels.where(~held).groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1")
    scorer = fit_on(docs.where(~held), trusted, labels)
    scored = score_texts(docs.select("doc_id", held.alias("held_out"), "text"), scorer)
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
