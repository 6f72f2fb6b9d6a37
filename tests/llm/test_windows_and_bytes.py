"""Window and byte dedup against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from fixtures_llm import documents, frame
from tidegate.llm import sketch
from tidegate.llm.repeated_bytes import drop_repeated_bytes
from tidegate.llm.repeated_windows import drop_repeated_windows, keyed
from tidegate.llm.scratch import shipped

LOW = -(1 << 63)


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def placed(docs):
    """(id that orders rows, text, doc_id): rows without an id have one from their text, below all others."""
    rows = [(r.doc_id, r.id, r.text) for r in keyed(docs, "doc_id", "text").select("doc_id", "id", "text").collect()]
    assert all(k == i if i is not None else k < LOW + (1 << 40) for i, k, _ in rows)
    return [(k, t, i) for i, k, t in rows]


def brute_windows(rows, size):
    words = [(i, t.encode().split()) for i, t, _ in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for (_, _, i), (n, w) in zip(rows, words):
        gone = {k + j for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < (n, k) for j in range(size)}
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def brute_bytes(rows):
    raw = [(i, t.encode()) for i, t in rows]
    met = Counter(t[k : k + 200] for _, t in raw for k in range(len(t) - 199))
    out = []
    for i, t in raw:
        cover = np.zeros(len(t) + 1, int)
        for k in range(len(t) - 199):
            if met[t[k : k + 200]] > 1:
                cover[k] += 1
                cover[k + 200] -= 1
        gone = np.cumsum(cover)[: len(t)] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("size,max_bits", [(20, 28), (3, 16)])
def test_windows(spark, size, max_bits):
    docs = documents(shipped(spark))
    rows = placed(docs)
    got = drop_repeated_windows(docs, size=size, max_bits=max_bits)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert ordered(got.collect()) == ordered(brute_windows(rows, size))


def test_a_sketch_that_is_too_small_changes_no_result(spark):
    docs = documents(shipped(spark)).where("doc_id < 100")
    full = ordered(drop_repeated_windows(docs, size=2).collect())
    assert full == ordered(drop_repeated_windows(docs, size=2, max_bits=10).collect())


@pytest.mark.parametrize("hot_rows", [50_000, 1, 3])
def test_bytes(spark, hot_rows):
    docs = documents(shipped(spark))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in drop_repeated_bytes(docs, hot_rows=hot_rows).collect()]
    assert ordered(got) == ordered(brute_bytes(rows_of(docs)))


@pytest.mark.parametrize("hot_rows", [50_000, 2])
def test_bytes_of_edited_copies(spark, hot_rows):
    rng = np.random.default_rng(4)
    base = bytes(rng.integers(97, 123, 6000, np.uint8)).decode()
    texts = [base]
    for k in range(12):
        edited = list(base)
        for at in rng.integers(0, len(base), 12):
            edited[at] = "#"
        texts.append("".join(edited)[k * 11 :])
    docs = frame(shipped(spark), [(i, t, "en") for i, t in enumerate(texts)])
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in drop_repeated_bytes(docs, hot_rows=hot_rows).collect()]
    assert ordered(got) == ordered(brute_bytes(rows_of(docs)))


def test_a_text_longer_than_a_stretch(spark):
    rng = np.random.default_rng(5)
    long_ = bytes(rng.integers(97, 123, 2_300_000, np.uint8)).decode()
    piece = long_[1_048_400:1_049_000]
    docs = frame(shipped(spark), [(1, long_, "en"), (2, f"{piece}!", "en"), (3, long_[:150], "en")])
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in drop_repeated_bytes(docs).collect()}
    assert got == {1: (600, 1), 2: (600, 1), 3: (0, 0)}


def shared_id_rows(seed=8):
    """Many texts under null ids, some alike in 16 bits of their checksum, and 20 texts under one id."""
    rng = random.Random(seed)
    texts = [f"{rng.choice('abcd')} {' '.join(rng.choice(['oak', 'elm', 'ash']) for _ in range(rng.randint(0, 9)))} {k}" for k in range(700)]
    check = lambda text: zlib.crc32(text.encode()) & 0xFFFF
    short = {check(t): t for t in (f"short {k}" for k in range(3000))}
    long_ = [t for t in (f"long {k} " + "word " * 40 + f"end {k}" for k in range(300)) if check(t) in short]
    assert len(long_) > 3
    rows = [(None, t, "en") for t in texts] + [(None, t, "en") for x in long_ for t in (x, short[check(x)])]
    return rows + [(5, f"{t} once more", "en") for t in texts[:20]] + [(k, texts[k], "en") for k in range(300, 320)]


def test_texts_that_share_an_id_are_not_mixed_up(spark):
    docs = frame(shipped(spark), shared_id_rows()).repartition(4)
    got = ordered(drop_repeated_windows(docs, size=3).collect())
    assert got == ordered(brute_windows(placed(docs), 3))
    keys = keyed(docs, "doc_id", "text").where("doc_id is null")
    assert keys.select("id").distinct().count() == keys.select("text").distinct().count()


def test_empty_tables(spark):
    docs = documents(shipped(spark)).limit(0)
    assert drop_repeated_windows(docs).count() == 0
    assert drop_repeated_bytes(docs).count() == 0


def test_sketches_merge_to_the_sketch_of_the_union():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 5000, np.uint64)
    left, right = sketch.RepeatSketch(16), sketch.RepeatSketch(16)
    left.add(hashes[:3000])
    right.add(hashes[2500:])
    again = left.again | right.again | (left.once & right.once)
    assert sketch.repeated(again, 16, hashes[2500:3000]).all()
    once = sketch.RepeatSketch(20)
    once.add(hashes[:100])
    assert not sketch.repeated(once.again, 20, hashes[:100]).any()
