"""Fingerprints, the next document, and block tables."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from fixtures_llm import documents
from test_simhash_groups import brute_pairs, clusters, reach
from tidegate.llm.components import components
from tidegate.llm.scratch import shipped
from tidegate.llm.simhash_groups import near_links
from tidegate.llm.weighted_simhash import block_tables, bounds_reached, direct_pairs, edited_fingerprints, near_classes, text_fingerprints


@pytest.mark.parametrize("radius", [1, 3, 5])
def test_any_two_within_the_radius_share_a_key(radius):
    rng = np.random.default_rng(radius)
    one = rng.integers(0, 1 << 63, 200, np.uint64)
    two = one.copy()
    for k in range(len(two)):
        for bit in rng.choice(64, radius, replace=False):
            two[k] ^= np.uint64(1 << int(bit))
    keys_one, keys_two = (block_tables(radius)(x)[0].reshape(-1, 200) for x in (one, two))
    assert (keys_one == keys_two).any(axis=0).all()


def test_block_links(spark):
    shipped(spark)
    values = clusters(9, 8, 60, 4)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    got = {r.node: r.component for r in components(near_links(frame, 3, block_tables(3), direct_pairs)).collect()}
    top = reach(len(values), brute_pairs(values))
    groups, mine = {}, {}
    for i, v in enumerate(values.view(np.int64)):
        groups.setdefault(top[i], set()).add(int(v))
        mine.setdefault(got.get(int(v), int(v)), set()).add(int(v))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_fingerprints_do_not_depend_on_neighbours():
    texts = ["one two three", None, "", "one", "One  TWO\nthree", "x " * 3000]
    fp = text_fingerprints(pa.array(texts))
    for k, text in enumerate(texts):
        assert fp[k] == text_fingerprints(pa.array([text], pa.string()))[0]
    assert fp[0] == fp[4] and fp[1] == fp[2] == 0


def test_edited_texts(spark):
    docs = documents(shipped(spark))
    rows = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").distinct().collect() if r.doc_id is not None))
    alone = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in edited_fingerprints(alone).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        half, after = len(text) // 2, rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - half] + after[:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].n_chars == len(text)
        assert got[i].edited_fp == text_fingerprints(pa.array([edited])).view(np.int64)[0]
        assert got[i].next_fp == text_fingerprints(pa.array([after])).view(np.int64)[0]


def test_odd_rows(spark):
    docs = documents(shipped(spark))
    marked = edited_fingerprints(docs)
    assert marked.count() == docs.count()
    assert edited_fingerprints(docs.limit(0)).count() == 0
    one = edited_fingerprints(docs.where("doc_id = 7").limit(1)).collect()
    assert len(one) == 1 and one[0].fp == one[0].next_fp
    assert near_classes(marked.limit(0)).count() == 0


def test_bounds_reached(spark):
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 100):
        bounds = sorted({int(b) for b in rng.integers(-50, 50, n)})
        values = spark.range(-60, 60)
        got = {r.id: r.n for r in values.select("id", bounds_reached(values["id"], bounds).alias("n")).collect()}
        assert got == {v: sum(b <= v for b in bounds) for v in range(-60, 60)}
