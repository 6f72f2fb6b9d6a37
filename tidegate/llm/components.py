"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.fingerprints import forest
from tidegate.llm.scratch import written

#: Rows that a task contracts at a time.
CONTRACT_EDGES = 1 << 20


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b): component is the smallest node reachable.

    Alternates large-star and small-star steps until no edge changes; every step is two shuffles by
    node with a partial minimum, and its edges go to the shared folder. Before each round the edges
    that lie in one task are contracted to stars there, which leaves few rounds. Nothing reaches the
    driver but a checksum. An empty table gives an empty table.
    """
    now = written(
        edges.where("a is not null and b is not null and a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .mapInArrow(_contracted, "a long, b long")
        .distinct()
    )
    before = None
    while True:
        check = _checksum(now)
        if check == before or check[0] == 0:
            break
        before = check
        now = written(_small_star(_large_star(now)).mapInArrow(_contracted, "a long, b long").distinct())
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as stars around the smallest node each reaches there."""
    held: list[np.ndarray] = []

    def out() -> Iterator[pa.RecordBatch]:
        if held:
            nodes, place = np.unique(np.concatenate(held, axis=1), return_inverse=True)
            a, b = place.reshape(2, -1)
            label = forest(len(nodes), iter([(a, b)]))
            held.clear()
            member = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[label[member]]), pa.array(nodes[member])], ["a", "b"])

    for batch in batches:
        if batch.num_rows:
            held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1)]))
        if sum(x.shape[1] for x in held) >= CONTRACT_EDGES:
            yield from out()
    yield from out()


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").where("b != m").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b")).distinct()
