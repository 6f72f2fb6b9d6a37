"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's UTF-8 bytes in stretches of 64, forwards and backwards, with a minimal
gated unit in each direction (one gate both forgets and resets). Every position gets a probability
for each language from both states; a document's probabilities are the mean over all its positions.
It is trained in numpy, by backpropagation through time over the whole stretch, on a bounded sample
of labelled rows, and applied in Spark tasks to every byte of every text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidegate.llm import words as W
from tidegate.llm.scratch import shipped

STRETCH = 64
UNITS = 8
PAD = 256
GROUP_BYTES = 1 << 18
#: Bounds of the training sample: rows of each language, and stretches of each row.
SAMPLE_ROWS = 400
SAMPLE_STRETCHES = 3
UPDATES = 600
BATCH = 128
RATE = 0.01


@dataclass
class Network:
    """inputs (2, 2 * units, 257): gate and candidate terms of each byte; recurrent (2, 2 * units, units);
    out (languages, 2 * units); bias (languages, 1)."""

    inputs: np.ndarray
    recurrent: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    languages: list[str]

    @property
    def units(self) -> int:
        return self.recurrent.shape[2]

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.out, self.bias]


def fresh(languages: list[str], units: int = UNITS, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    inputs = rng.normal(0, 0.3, (2, 2 * units, 257)).astype(np.float32)
    inputs[:, :units, PAD] = -30  # a closed gate: padding leaves the state as it is
    recurrent = rng.normal(0, 0.3, (2, 2 * units, units)).astype(np.float32)
    out = rng.normal(0, 0.3, (len(languages), 2 * units)).astype(np.float32)
    return Network(inputs, recurrent, out, np.zeros((len(languages), 1), np.float32), languages)


def _gate(x: np.ndarray) -> np.ndarray:
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += 1
    x *= np.float32(0.5)
    return x


def states(net: Network, symbols: np.ndarray) -> np.ndarray:
    """(2 * units, length, stretches): both directions' states at each position of symbols (length, stretches)."""
    steps, n = symbols.shape
    units = net.units
    out = np.empty((2 * units, steps, n), np.float32)
    for way in range(2):
        state = np.zeros((units, n), np.float32)
        table, recurrent = net.inputs[way], net.recurrent[way]
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            x = np.take(table, symbols[t], axis=1)
            h = recurrent @ state
            x[:units] += h[:units]
            gate = _gate(x[:units])
            h[units:] *= gate
            h[units:] += x[units:]
            new = np.tanh(h[units:], out=h[units:])
            new -= state
            new *= gate
            state = np.add(state, new, out=out[way * units : (way + 1) * units, t])
    return out


def position_probabilities(net: Network, symbols: np.ndarray) -> np.ndarray:
    """(languages, length, stretches)."""
    both = states(net, symbols)
    logits = (net.out @ both.reshape(len(both), -1)) + net.bias
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits.reshape(-1, *symbols.shape)


def gradients(net: Network, symbols: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradients by backpropagation through time."""
    steps, n = symbols.shape
    units = net.units
    kept = []
    both = np.zeros((2 * units, steps, n), np.float32)
    for way in range(2):
        state, trace = np.zeros((units, n), np.float32), []
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            x, h = net.inputs[way][:, symbols[t]], net.recurrent[way] @ state
            gate = _gate(x[:units] + h[:units])
            new = np.tanh(x[units:] + gate * h[units:])
            trace.append((t, state, gate, new, h[units:]))
            state = state + gate * (new - state)
            both[way * units : (way + 1) * units, t] = state
        kept.append(trace)
    flat = both.reshape(2 * units, -1)
    logits = net.out @ flat + net.bias
    logits -= logits.max(axis=0)
    p = np.exp(logits)
    p /= p.sum(axis=0)
    real = (symbols != PAD).reshape(-1)
    target = np.tile(label, steps)
    loss = -np.log(p[target, np.arange(p.shape[1])] + 1e-9)[real].mean()
    p[target, np.arange(p.shape[1])] -= 1
    p *= real / max(real.sum(), 1)
    g_out, g_bias = p @ flat.T, p.sum(axis=1, keepdims=True)
    above = (net.out.T @ p).reshape(2 * units, steps, n)
    g_inputs, g_recurrent = np.zeros_like(net.inputs), np.zeros_like(net.recurrent)
    for way in range(2):
        carry = np.zeros((units, n), np.float32)
        by_symbol = np.zeros((257, 2 * units), np.float32)
        for t, state, gate, new, h_new in reversed(kept[way]):
            d = carry + above[way * units : (way + 1) * units, t]
            d_new = d * gate * (1 - new * new)
            d_gate = (d * (new - state) + d_new * h_new) * gate * (1 - gate)
            d_h = np.concatenate([d_gate, d_new * gate])
            g_recurrent[way] += d_h @ state.T
            carry = d * (1 - gate) + net.recurrent[way].T @ d_h
            np.add.at(by_symbol, symbols[t], np.concatenate([d_gate, d_new]).T)
        by_symbol[PAD] = 0
        g_inputs[way] = by_symbol.T
    return float(loss), [g_inputs, g_recurrent, g_out, g_bias]


def train(symbols: np.ndarray, label: np.ndarray, languages: list[str], updates: int = UPDATES, seed: int = 7) -> Network:
    """Adam over batches in which each language has the same share. symbols (stretches, length)."""
    net, rng = fresh(languages, seed=seed), np.random.default_rng(seed)
    of = [np.flatnonzero(label == k) for k in range(len(languages))]
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    for step in range(1, updates + 1):
        pick = np.concatenate([rng.choice(x, max(1, BATCH // len(of))) for x in of])
        _, grads = gradients(net, np.ascontiguousarray(symbols[pick].T), label[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1, 2 * (1 - step / (updates + 1)))
        for w, g, m, v in zip(net.weights(), grads, first, second):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def cut(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (length, stretches) of texts cut into stretches, and the text each is of."""
    pieces = -(-(end - begin) // STRETCH)
    text = np.repeat(np.arange(len(begin)), pieces)
    start = begin[text] + STRETCH * (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    at = start[None, :] + np.arange(STRETCH)[:, None]
    inside = at < end[text][None, :]
    symbols = np.where(inside, data.astype(np.int16)[np.minimum(at, max(len(data) - 1, 0))] if len(data) else PAD, PAD).astype(np.int16)
    return symbols, text


def document_probabilities(net: Network, column: pa.Array) -> np.ndarray:
    """(rows, languages): mean over all positions of each text; zeros for an empty one."""
    out = np.zeros((len(column), len(net.languages)))
    for texts in W.text_groups(column, GROUP_BYTES):
        n = len(texts.begin)
        total = np.zeros((n, len(net.languages)))
        symbols, text = cut(texts.data, texts.begin, texts.end)
        step = max(2 * GROUP_BYTES // STRETCH * 8 // max(8, len(net.languages)), 1)
        for lo in range(0, symbols.shape[1], step):  # one long text comes in parts, and so do many languages
            part, own = symbols[:, lo : lo + step], text[lo : lo + step]
            p = position_probabilities(net, np.ascontiguousarray(part))
            if (part[-1] == PAD).any():
                p *= part != PAD
            by_stretch = p.sum(axis=1)
            for k in range(len(by_stretch)):
                total[:, k] += np.bincount(own, by_stretch[k], minlength=n)
        size = np.maximum(texts.end - texts.begin, 1)
        out[texts.first : texts.first + n] = total / size[:, None]
    return out


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """crc32 of the id as text falls into `fold`. A row without an id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(True))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """A network for the languages of `labelled`, from at most `SAMPLE_ROWS` rows of each.

    Rows are picked by a hash of their text, equal texts once, so the sample is the same whatever the
    partitions. A share of each language's distinct texts that holds about twice the bound is drawn
    first; a language that comes out below the bound is drawn again from all its rows. None if no row
    has a language and a text.
    """
    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("lang is not null and text rlike '\\\\p{L}'").withColumn("pick", F.xxhash64("text"))
    size = F.length("text")
    spots = [F.pmod(F.xxhash64("pick", F.lit(k)), F.greatest(size - STRETCH, F.lit(1))) + 1 for k in range(SAMPLE_STRETCHES)]
    parts = [F.substring("text", spot.cast("int"), F.lit(STRETCH)).alias(f"part{k}") for k, spot in enumerate(spots)]
    place = F.row_number().over(Window.partitionBy("lang").orderBy("pick"))

    def draw(some: DataFrame) -> list:
        few = some.select("lang", "pick", *parts).distinct()
        return few.withColumn("place", place).where(F.col("place") <= SAMPLE_ROWS).drop("place").collect()

    # Shares go by distinct texts: copies would make them too small.
    texts = {r.lang: r.texts for r in rows.groupBy("lang").agg(F.approx_count_distinct("pick").alias("texts")).collect()}
    shared = {lang: 2 * SAMPLE_ROWS / n for lang, n in texts.items() if n > 2 * SAMPLE_ROWS}
    if shared:
        pairs = rows.sparkSession.createDataFrame(list(shared.items()), "lang string, share double")
        share = F.coalesce("share", F.lit(1.0))
        sample = draw(rows.join(F.broadcast(pairs), "lang", "left").where(F.pmod("pick", F.lit(1 << 30)) / float(1 << 30) < share))
        drawn = Counter(r.lang for r in sample)
        short = [lang for lang in shared if drawn[lang] < SAMPLE_ROWS]
        if short:
            sample = [r for r in sample if r.lang not in short] + draw(rows.where(F.col("lang").isin(short)))
    else:
        sample = draw(rows)
    sample.sort(key=lambda r: (r.lang, r.pick))
    languages = sorted({r.lang for r in sample})
    if not languages:
        return None
    texts = [(r[f"part{k}"].encode()[:STRETCH], languages.index(r.lang)) for r in sample for k in range(SAMPLE_STRETCHES)]
    symbols = np.full((len(texts), STRETCH), PAD, np.int16)
    for k, (raw, _) in enumerate(texts):
        symbols[k, : len(raw)] = np.frombuffer(raw, np.uint8)
    return train(symbols, np.array([label for _, label in texts]), languages)


def identify(docs: DataFrame, net: Network | None, text_col: str = "text", keep: list[str] | None = None, names_as: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """`docs`, or its columns `keep`, with lang_pred and score (0 to 1), the likeliest language and its pooled probability.

    A text that is null or has no letter is `und` with score 0; so is every text where there is no
    network to ask. The texts are read whole. `names_as` names the two new columns; columns of the
    same names are replaced.
    """
    letters = F.coalesce(F.col(text_col).cast("string").rlike("\\p{L}"), F.lit(False))
    fields = [f for f in docs.schema.fields if f.name not in names_as]
    kept = docs.select(*(F.col(f"`{f.name}`") for f in fields), letters.alias("_letters"))
    names = [f.name for f in fields]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(len(names)).to_numpy(zero_copy_only=False).astype(bool) & (net is not None)
            label, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            if known.any():
                p = document_probabilities(net, batch.column(names.index(text_col)))
                best = p.argmax(axis=1)
                label[known] = np.array(net.languages, object)[best[known]]
                score[known] = np.clip(p[np.arange(len(p)), best], 0, 1)[known]
            back = [k for k, name in enumerate(names) if name in keep]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in back), pa.array(label, pa.string()), pa.array(score)], [*(names[k] for k in back), *names_as]
            )

    keep = set(names if keep is None else keep)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields if f.name in keep) + f"`{names_as[0]}` string, `{names_as[1]}` double"
    return kept.mapInArrow(rows, schema)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")
    held = held_out("doc_id", 4, 2)
    net = fit(docs.where(~held))
    return identify(docs.select("doc_id", "text", held.alias("held_out")), net, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score")
