"""Mixing documents to target weights under soft domain membership.

A classifier fitted on a labelled table gives every document a posterior over domains. Non-negative
document rates are then fitted so that the expected tokens of each domain (rate x tokens x posterior,
summed over documents) match its target: projected gradient descent on the squared gaps, with
momentum that restarts when it overshoots. Rates start at one and each gradient is a combination of a
document's posteriors, so the steps taken so far, a few numbers each, are all that tasks need to work
out any document's rate; every step is one pass over a small table of posteriors and returns one row
of sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import words as W
from tidegate.llm.quality import N_FEATURES, features
from tidegate.llm.repeated_windows import keyed
from tidegate.llm.scratch import shipped, small_batches, written_in_small_batches

#: Bound of the training sample, in labelled rows of each domain.
SAMPLE_ROWS = 4000
#: Rows with whole texts that go between Spark and Python at a time.
TEXTS_AT_ONCE = 500
WORD_BUCKETS = 1 << 16
WORD_FEATURES = 1500
#: Chi-square under which a word's shares differ by chance.
LEAST_WORTH = 12.0
FIT_STEPS = 250
STEPS = 80
TOLERANCE = 1e-4
#: Targets may be out of reach, such as tokens of a domain no document has a share of: give up then.
STALE_STEPS = 5
#: Shares of tokens asked for by the registered query and the pipeline.
TARGETS = {"clean": 0.94, "junk": 0.04, "toxic": 0.02}
U64 = np.uint64


def word_buckets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, row of each word, bucket of each word, words of each row), words in lower case."""
    for texts in W.text_groups(column):
        lower = W.Texts(texts.first, W.LOWER[texts.data], texts.begin, texts.end)
        words = W.find_words(lower, W.ALNUM)
        hashes = W.span_hashes(lower.data, words.start, words.end)
        yield texts.first, len(words.count), words.text, (hashes >> U64(48)).astype(np.int64), words.count


@dataclass
class DomainModel:
    """Softmax over shape features and the presence of chosen words."""

    domains: list[str]
    place: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    shape_weights: np.ndarray
    word_weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """((rows, domains), words of each row)."""
        tokens = np.zeros(len(column), np.int64)
        logits = ((features(column) - self.centre) / self.scale) @ self.shape_weights + self.bias
        for first, n, row, bucket, count in word_buckets(column):
            tokens[first : first + n] = count
            met = self.place[bucket]
            hit = np.flatnonzero(met >= 0)
            own = np.unique(row[hit] * len(self.word_weights) + met[hit])
            for k in range(len(self.domains)):
                logits[first : first + n, k] += np.bincount(own // len(self.word_weights), self.word_weights[own % len(self.word_weights), k], minlength=n)
        return _softmax(logits), tokens


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits = np.exp(logits - logits.max(axis=1, keepdims=True))
    return logits / logits.sum(axis=1, keepdims=True)


def fit_domains(shape: np.ndarray, row: np.ndarray, bucket: np.ndarray, label: np.ndarray, domains: list[str]) -> DomainModel:
    """Full-batch Adam on cross-entropy, from shape features and the (row, bucket) pairs of words met.

    Words are chosen by how far their share of documents differs between domains.
    """
    n, k = len(shape), len(domains)
    met = np.bincount(bucket * k + label[row], minlength=WORD_BUCKETS * k).reshape(-1, k)
    size = np.bincount(label, minlength=k)
    expected = met.sum(axis=1, keepdims=True) * size / n
    worth = ((met - expected) ** 2 / (expected + 1)).sum(axis=1)
    chosen = np.argsort(-worth, kind="stable")[:WORD_FEATURES]
    chosen = np.sort(chosen[worth[chosen] >= LEAST_WORTH])
    place = np.full(WORD_BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    centre, scale = shape.mean(axis=0), shape.std(axis=0) + 0.05
    x = np.zeros((n, N_FEATURES + len(chosen)), np.float32)
    x[:, :N_FEATURES] = (shape - centre) / scale
    keep = place[bucket] >= 0
    x[row[keep], N_FEATURES + place[bucket[keep]]] = 1
    w, b = np.zeros((x.shape[1], k), np.float32), np.log(size / n + 1e-6).astype(np.float32)
    target = np.eye(k, dtype=np.float32)[label]
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, FIT_STEPS + 1):
        gap = (_softmax(x @ w + b) - target) / n
        g = x.T @ gap + 1e-5 * w
        b -= gap.sum(axis=0)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return DomainModel(domains, place, centre, scale, w[:N_FEATURES].astype(np.float64), w[N_FEATURES:].astype(np.float64), b.astype(np.float64))


def fit_on(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text") -> DomainModel | None:
    """A model from `labelled` (id, domain), at most `SAMPLE_ROWS` rows of each domain, by a hash. None without labelled texts.

    A row is an id and its text: copies of both are one, however many there are, and texts that share
    an id are rows of their own. Rows without an id teach nothing.
    """
    named = keyed(docs.where(F.col(text_col).isNotNull()), id_col, text_col).where("doc_id is not null")
    ids = labelled.where("domain is not null").groupBy(F.col(id_col).alias("id")).agg(F.min("domain").alias("domain"))
    rows_of = named.select("id", "tag").join(ids, "id").distinct()
    chosen = None
    for domain in domains:
        part = rows_of.where(F.col("domain") == domain).orderBy(F.xxhash64("id", "tag"), "id", "tag").limit(SAMPLE_ROWS)
        chosen = part if chosen is None else chosen.union(part)
    texts = named.select("id", "tag", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shape = features(batch.column(3))
            buckets = []
            for _, n, row, bucket, _ in word_buckets(batch.column(3)):
                pairs = np.unique(row * WORD_BUCKETS + bucket)
                ends = np.searchsorted(pairs, np.arange(1, n) * WORD_BUCKETS)
                buckets += [x.astype(np.uint16).tobytes() for x in np.split(pairs % WORD_BUCKETS, ends)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([x.tobytes() for x in shape], pa.binary()), pa.array(buckets, pa.binary())],
                ["id", "tag", "domain", "shape", "buckets"],
            )

    met = texts.join(F.broadcast(chosen), ["id", "tag"]).select("id", "tag", "domain", "text")
    read = met.mapInArrow(rows, "id long, tag long, domain string, shape binary, buckets binary").dropDuplicates(["id", "tag"])
    with small_batches(docs.sparkSession, TEXTS_AT_ONCE):
        sample = sorted((r.id, r.tag, r.domain, r.shape, r.buckets) for r in read.collect())
    if not sample:
        return None
    label = np.array([domains.index(domain) for _, _, domain, _, _ in sample])
    shape = np.array([np.frombuffer(x, np.float32) for *_, x, _ in sample]).astype(np.float64)
    words = [np.frombuffer(x, np.uint16).astype(np.int64) for *_, x in sample]
    row = np.repeat(np.arange(len(words)), [len(x) for x in words])
    return fit_domains(shape, row, np.concatenate(words), label, domains)


def memberships(docs: DataFrame, model: DomainModel | None, domains: list[str], text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """`docs` with n_tokens and posterior (array, in the order of `domains`); equal posteriors without a model. The text column is left out unless asked for."""
    fields = [f for f in docs.schema.fields if f.name not in (text_col, "n_tokens", "posterior")]
    kept = docs.select(*(F.col(f"`{f.name}`") for f in fields), F.col(text_col).cast("string").alias(text_col))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = batch.column(len(fields))
            text = [read] if keep_text else []
            if model:
                p, tokens = model.posteriors(read)
            else:
                p = np.full((len(read), len(domains)), 1 / len(domains))
                tokens = np.concatenate([np.zeros(0, np.int64), *(c[4] for c in word_buckets(read))])
            posterior = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * len(domains), pa.int32()), pa.array(p.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(fields))), *text, pa.array(tokens), posterior], names
            )
        W.release()

    names = [*(f.name for f in fields), *([text_col] if keep_text else []), "n_tokens", "posterior"]
    text_field = f"`{text_col}` string, " if keep_text else ""
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields) + text_field + "n_tokens long, posterior array<double>"
    return kept.mapInArrow(rows, schema)


@dataclass
class Steps:
    """Gradient steps taken: a document's rate is a replay of them on its posterior."""

    pulls: list[np.ndarray]
    momentum: list[float]

    def rates(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rates, the point the next gradient is taken at)."""
        rate = ahead = np.ones(len(p))
        for pull, momentum in zip(self.pulls, self.momentum):
            new = np.maximum(ahead - p @ pull, 0)
            ahead = new + momentum * (new - rate)
            rate = new
        return rate, ahead


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    tokens = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
    return tokens, batch.column(1).flatten().to_numpy().reshape(len(tokens), -1)


def _sums(members: DataFrame, of) -> np.ndarray:
    """Sum over documents of a vector that `of(tokens, posteriors)` gives for a batch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(*_batch(batch))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "total"])

    parts = members.select("n_tokens", "posterior").mapInArrow(rows, "k long, total double").groupBy("k").agg(F.sum("total").alias("total"))
    return np.array([r.total for r in parts.orderBy("k").collect()])


def fit_rates(members: DataFrame, shares: list[float], tokens: float | None = None, steps: int = STEPS, tolerance: float = TOLERANCE) -> Steps:
    """Steps after which expected domain tokens match `shares` of `tokens` (all tokens there are by default)."""
    k = len(shares)
    first = _sums(members, lambda t, p: np.concatenate([t @ p, ((p * t[:, None]).T @ p).reshape(-1)]))
    out = Steps([], [])
    if not len(first) or not first[:k].sum():
        return out
    now, gram = first[:k], first[k:].reshape(k, k)
    target = np.array(shares) / sum(shares) * (first[:k].sum() if tokens is None else tokens)
    weight = 1 / np.maximum(now, 1e-9 * now.sum())
    scaled = gram * np.sqrt(weight[:, None] * weight[None, :])
    rate = 1 / np.linalg.eigvalsh(scaled)[-1]
    speed, error = 1.0, None
    best, stale = np.inf, 0
    point = now
    for _ in range(steps):
        gap = point - target
        if error is not None and float(gap @ (weight * gap)) > error:
            speed = 1.0
            if out.momentum:
                out.momentum[-1] = 0.0
                point = _totals(members, out)[1]
                gap = point - target
        error = float(gap @ (weight * gap))
        pull = np.array([float(f"{x:.12e}") for x in rate * weight * gap])
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        out.pulls.append(pull)
        out.momentum.append((speed - 1) / faster)
        speed = faster
        reached, point = _totals(members, out)
        left = float((reached - target) @ (weight * (reached - target)))
        stale = stale + 1 if left > best * (1 - 1e-6) else 0
        best = min(best, left)
        if np.abs(reached - target).max() <= tolerance * target.sum() or stale == STALE_STEPS:
            break
    return out


def _totals(members: DataFrame, steps: Steps) -> tuple[np.ndarray, np.ndarray]:
    """Expected domain tokens at the rates, and at the point ahead of them."""

    def of(tokens: np.ndarray, p: np.ndarray) -> np.ndarray:
        rate, ahead = steps.rates(p)
        return np.concatenate([(tokens * rate) @ p, (tokens * ahead) @ p])

    both = _sums(members, of)
    return both[: len(both) // 2], both[len(both) // 2 :]


def with_rates(members: DataFrame, steps: Steps) -> DataFrame:
    """`members` with rate."""

    @F.pandas_udf("double")
    def rate(posterior: pd.Series) -> pd.Series:
        return pd.Series(steps.rates(np.stack(posterior.to_numpy()))[0] if len(posterior) else np.zeros(0))

    return members.withColumn("rate", rate("posterior"))


def mix(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", tokens: float | None = None, keep_text: bool = False
) -> DataFrame:
    """`docs`, without its text unless `keep_text`, with n_tokens, posterior, domain (the likeliest), rate and copies.

    copies is the rate rounded up or down by a hash of the id, so that its expectation is the rate; a
    row without an id rounds to the nearest. `labelled` is (id, domain); rows of domains without a
    target teach nothing. Columns of `docs` with the names of new ones are replaced. A null text has no tokens. Without labelled texts all memberships are
    equal; without tokens all rates are one. An empty table gives an empty table.
    """
    domains = sorted(targets)
    if not domains or min(targets.values()) < 0 or not sum(targets.values()):
        raise ValueError("targets are shares of at least one domain")
    docs = docs.drop("n_tokens", "posterior", "rate", "domain", "copies")
    model = fit_on(docs, labelled, domains, id_col, text_col)
    members = written_in_small_batches(memberships(docs, model, domains, text_col, keep_text), TEXTS_AT_ONCE)
    rated = with_rates(members, fit_rates(members, [targets[d] for d in domains], tokens))
    best = F.array_position("posterior", F.array_max("posterior"))
    toss = F.coalesce(F.pmod(F.xxhash64(F.col(id_col), F.lit("copies")), F.lit(1 << 30)) / float(1 << 30), F.lit(0.5))
    toss = F.when(F.col(id_col).isNull(), F.lit(0.5)).otherwise(toss)
    return rated.select(
        "*",
        F.element_at(F.array(*map(F.lit, domains)), best.cast("int")).alias("domain"),
        (F.floor("rate") + F.when(F.col("rate") - F.floor("rate") > toss, 1).otherwise(0)).cast("int").alias("copies"),
    )


def domain_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labels table: junk by quality, then toxic, else clean."""
    domain = F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = shipped(spark).read
    docs = read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    mixed = mix(docs, domain_labels(read.parquet(f"{sf_dir}/labels.parquet")), TARGETS)
    return mixed.select("doc_id", "n_tokens", "domain", "posterior", "rate", "copies")
