"""Near groups against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegate.llm import components as C, simhash_groups as S
from tidegate.llm.components import components
from tidegate.llm.fingerprints import GrayTree, RunScan, gray_rank, near_pairs
from tidegate.llm.scratch import shipped
from tidegate.llm.simhash_groups import near_groups, near_links


def reach(n: int, pairs) -> list[int]:
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return [top(x) for x in range(n)]


def brute_fingerprint(text: str | None) -> int:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def clusters(seed: int, centres: int, each: int, flips: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    out = set()
    for centre in rng.integers(0, 1 << 63, centres):
        for _ in range(each):
            value = int(centre)
            for bit in rng.integers(0, 64, rng.integers(0, flips + 1)):
                value ^= 1 << int(bit)
            out.add(value)
    return np.array(sorted(out), np.uint64)


def brute_pairs(values: np.ndarray):
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3):
            yield i, i + 1 + int(j)


def test_tree_finds_every_pair():
    values = clusters(1, 30, 40, 4)
    values = values[np.argsort(gray_rank(values))]
    tree = GrayTree(values)
    found = {(int(a), int(b)) for x, y in near_pairs(tree, tree, 3) for a, b in zip(x, y)}
    assert found == set(brute_pairs(values))
    left, right = GrayTree(values[::3]), GrayTree(values[1:50])
    across = {(int(a), int(b)) for x, y in near_pairs(left, right, 3) for a, b in zip(x, y)}
    assert across == {
        (i, j)
        for i, a in enumerate(values[::3])
        for j, b in enumerate(values[1:50])
        if np.bitwise_count(a ^ b) <= 3
    }


def test_gray_rank_orders_neighbours_one_bit_apart():
    rank = np.arange(1 << 10, dtype=np.uint64)
    code = rank ^ (rank >> np.uint64(1))
    assert (gray_rank(code) == rank).all()


@pytest.mark.parametrize("batch", [1, 7, 5000])
def test_run_scan_keeps_pieces_of_long_runs(batch):
    keys = np.repeat([1, 2, 3, 4], [3, 9000, 1, 20])
    values = np.arange(len(keys), dtype=np.uint64) << np.uint64(20)
    scan = RunScan(lambda values: (values[:0], values[:0]), 0)
    nodes = []
    step = max(batch, 200)
    for lo in range(0, len(keys), step):
        nodes += scan.feed(keys[lo : lo + step], values[lo : lo + step])[1]
    nodes += scan.feed(keys[:0], values[:0], last=True)[1]
    assert sum(len(v) for k, v in nodes if k == 2) == 9000
    assert {k for k, _ in nodes} == {1, 2, 4}
    assert max(len(v) for _, v in nodes) <= 4096


@pytest.mark.parametrize("each,flips", [(40, 4), (1500, 5)])
def test_links_reach_what_brute_force_reaches(spark, each, flips):
    shipped(spark)
    values = clusters(7, 6, each, flips)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    got = {r.node: r.component for r in components(near_links(frame)).collect()}
    top = reach(len(values), brute_pairs(values))
    groups, mine = {}, {}
    for i, v in enumerate(values.view(np.int64)):
        groups.setdefault(top[i], set()).add(int(v))
        mine.setdefault(got.get(int(v), int(v)), set()).add(int(v))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


@pytest.mark.parametrize("contract", [1, 1 << 20])
def test_components(spark, contract, monkeypatch):
    monkeypatch.setattr(C, "CONTRACT_EDGES", contract)
    components = C.components
    shipped(spark)
    chain = spark.range(50).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(4)
    assert {r.component for r in components(chain).collect()} == {0}
    assert components(chain.limit(0)).count() == 0
    rng = np.random.default_rng(11)
    pairs = [tuple(map(int, x)) for x in rng.integers(0, 90, (60, 2))]
    top = reach(90, pairs)
    frame = spark.createDataFrame([(a - 40, b - 40) for a, b in pairs], "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {n - 40: top[n] - 40 for a, b in pairs if a != b for n in (a, b)}


@pytest.mark.parametrize("piece", [16, 300])
def test_links_across_many_pieces_and_levels(spark, monkeypatch, piece):
    monkeypatch.setattr(S, "PIECE_ROWS", piece)
    monkeypatch.setattr(S, "LEVEL_BITS", 2)
    shipped(spark)
    values = clusters(9, 500, 9, 5)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    found = S.written(S.gray_pieces(frame, 3))
    pieces = found.where("head is not null")
    n = pieces.count()
    assert sorted(v for r in pieces.collect() for v in np.frombuffer(r.members, np.uint64)) == sorted(values)
    pairs = S.near_pieces(pieces, 3)
    assert 0 < pairs.count() <= n * (n - 1) / 2 * (0.75 if piece == 16 else 1)  # whole groups were pruned
    got = {r.node: r.component for r in components(near_links(frame)).collect()}
    top = reach(len(values), brute_pairs(values))
    names = [int(v) for v in values.view(np.int64)]
    least = {}
    for k, v in zip(top, names):
        least[k] = min(least.get(k, v), v)
    assert all(got.get(v, v) == least[k] for k, v in zip(top, names))


def test_most_nodes_are_pruned_on_real_fingerprints(spark, monkeypatch):
    docs = shipped(spark).read.parquet("/root/testdata/sf0.1/documents.parquet")
    values = np.unique(np.array([r.fp for r in S.fingerprints(docs).collect()], np.int64).view(np.uint64))
    values = values[np.argsort(gray_rank(values))]
    met = []
    real = np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: met.append(np.size(x)) or real(x))
    tree = GrayTree(values)
    found = {(int(a), int(b)) for x, y in near_pairs(tree, tree, 3) for a, b in zip(x, y)}
    monkeypatch.undo()
    assert found == set(brute_pairs(values))
    assert sum(met) < 0.35 * len(values) * (len(values) - 1) / 2


def test_odd_rows(spark):
    shipped(spark)
    texts = [None, "", " \n", "One", "one", "one two", "a b c d", "A B C D", "a b c d", "word " * 30000, None, "é ü ß"]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(6, "a b c d", "y", 2), (None, "one", "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id long")
    got = near_groups(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, text in enumerate(texts):
        assert by[i].fingerprint == f"{brute_fingerprint(text):016x}"
    assert by[0].component_id == by[1].component_id == by[2].component_id == by[10].component_id == 0
    assert by[7].component_id == 6 and by[None].component_id == 3
    assert near_groups(docs.limit(0)).count() == 0
