"""Near fingerprints by keys: values that may be near share a key, and runs of one key are searched."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.fingerprints import RunScan, forest, gray_rank, star_edges
from tidegate.llm.scratch import written

U64 = np.uint64


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


LINKS = "a long, b long, key long, head long, mask long, pattern long, members binary"


def _links(edges: list, nodes: list) -> Iterator[pa.RecordBatch]:
    """Edge rows have a and b; node rows have a key, the first Gray rank, shared bits and members."""
    schema = pa.schema([(n, pa.int64()) for n in ("a", "b", "key", "head", "mask", "pattern")] + [("members", pa.binary())])
    edges = [(a, b) for a, b in edges if len(a)]
    if edges:
        a, b = (_signed(np.concatenate(x)) for x in zip(*edges))
        empty = [pa.nulls(len(a), field.type) for field in list(schema)[2:]]
        yield pa.RecordBatch.from_arrays([a, b, *empty], schema=schema)
    for key, values in nodes:
        ones, any_ = np.bitwise_and.reduce(values), np.bitwise_or.reduce(values)
        mask = ~(ones ^ any_)
        columns = [_signed(np.array([x], np.uint64)) for x in (U64(key), gray_rank(values[:1])[0], mask, ones & mask)]
        members = pa.array([values.tobytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), *columns, members], schema=schema)


Tables = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
Pairs = Callable[[np.ndarray, np.ndarray | None, int], Iterator[tuple[np.ndarray, np.ndarray]]]


def linked_by_keys(distinct: DataFrame, radius: int, tables: Tables, pairs: Pairs) -> DataFrame:
    """(a, b): links that connect whatever distinct fingerprints `fp` lie within `radius` of each other.

    `tables` deals values to keys such that any two within `radius` share one, and orders those of a
    key. `pairs` finds the pairs of a run.
    """

    def search(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return star_edges(values, forest(len(values), pairs(values, None, radius)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            columns = [_signed(x) for x in tables(values)]
            # Ranks order unsigned; flipping the top bit makes the signed order the same.
            columns[1] = _signed(columns[1].to_numpy().view(np.uint64) ^ U64(1 << 63))
            yield pa.RecordBatch.from_arrays(columns, ["key", "rank", "fp"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = RunScan(search, radius)
        for batch in batches:
            yield from _links(*runs.feed(batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
        yield from _links(*runs.feed(np.zeros(0, np.int64), np.zeros(0, np.uint64), last=True))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one, two = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                found = ((i, j + len(one)) for i, j in pairs(one, two, radius))
                both = np.concatenate([one, two])
                label = forest(len(both), found)
                member = np.flatnonzero(label != np.arange(len(label)))
                if len(member):
                    columns = [_signed(both[label[member]]), _signed(both[member])]
                    yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    spark = distinct.sparkSession
    dealt = distinct.select("fp").mapInArrow(deal, "key long, rank long, fp long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartitionByRange(parts, "key", "rank").sortWithinPartitions("key", "rank")
    found = written(ordered.select("key", "fp").mapInArrow(scan, LINKS))
    nodes = found.where("key is not null").select("key", "head", "mask", "pattern", "members")
    left = nodes.select("key", *(F.col(c).alias(f"l_{c}") for c in nodes.columns[1:]))
    right = nodes.select("key", *(F.col(c).alias(f"r_{c}") for c in nodes.columns[1:]))
    meet = left.join(right, "key").where(
        "(l_head < r_head) and bit_count((l_pattern ^ r_pattern) & l_mask & r_mask) <= " + str(radius)
    )
    across = meet.select("l_members", "r_members").mapInArrow(pair, "a long, b long")
    return found.where("key is null").select("a", "b").union(across)
