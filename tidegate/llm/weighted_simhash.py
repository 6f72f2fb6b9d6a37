"""Document fingerprints: SimHash of weighted terms, and tables that find what lies near.

Terms are pairs of neighbouring words (the word itself where there is only one), in lower case. A
term's hash votes on each of 64 signed sums with the term's length in bytes as its weight: long
pairs are rare ones and say more. Equal texts have equal fingerprints.

For a radius r the 64 bits are cut into r + 3 blocks. Two fingerprints within r differ in at most r
blocks, so three blocks agree: there is a table for each choice of three, whose key is those blocks
permuted to the front. Runs of one key are compared within, and linked as a forest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.llm import words as W
from tidegate.llm.components import components
from tidegate.llm.fingerprints import bit_votes, pack_bits
from tidegate.llm.key_tables import linked_by_keys
from tidegate.llm.repeated_windows import keyed
from tidegate.llm.scratch import shipped, written, written_in_small_batches

RADIUS = 3
U64 = np.uint64
SLICE_ROWS = 256


def text_fingerprints(column: pa.Array) -> np.ndarray:
    out = [np.zeros(0, np.uint64)]
    for texts in W.text_groups(column):
        texts = W.Texts(texts.first, W.LOWER[texts.data], texts.begin, texts.end)
        words = W.find_words(texts, W.NON_SPACE)
        hashes = W.span_hashes(texts.data, words.start, words.end)
        terms = np.where(words.count == 0, 0, np.maximum(words.count - 1, 1))
        first = np.concatenate([[0], np.cumsum(terms)])[:-1]
        owner = np.repeat(np.arange(len(terms)), terms)
        head = words.first[owner] + np.arange(len(owner)) - first[owner]
        tail = head + (words.count[owner] > 1)
        value = W.mix(hashes[head] * U64(0xA0761D6478BD642F) + hashes[tail])
        weight = (words.end[tail] - words.start[head]).astype(np.float64)
        total = np.bincount(owner, weight, minlength=len(terms))
        out.append(pack_bits(2 * bit_votes(value, first, terms, weight) > total[:, None]))
    return np.concatenate(out)


def block_tables(radius: int):
    """Deals fingerprints into a table for each three of radius + 3 blocks."""
    blocks = radius + 3
    edges = [64 * k // blocks for k in range(blocks + 1)]

    def tables(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = [(values >> U64(a)) & U64((1 << b - a) - 1) for a, b in zip(edges, edges[1:])]
        keys, ranks = [], []
        for number, front in enumerate(combinations(range(blocks), 3)):
            order = [*front, *(k for k in range(blocks) if k not in front)]
            permuted = np.zeros(len(values), np.uint64)
            for k in order:
                permuted = (permuted << U64(edges[k + 1] - edges[k])) | part[k]
            shared = sum(edges[k + 1] - edges[k] for k in front)
            keys.append((U64(number) << U64(48)) | (permuted >> U64(64 - shared)))
            ranks.append(permuted)
        return np.concatenate(keys), np.concatenate(ranks), np.tile(values, len(keys))

    return tables


def direct_pairs(one: np.ndarray, two: np.ndarray | None, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for lo in range(0, len(one), 64):
        near = np.bitwise_count(one[lo : lo + 64, None] ^ (one if two is None else two)[None, :]) <= radius
        i, j = np.nonzero(near)
        yield (i + lo, j) if two is not None else (i[i + lo < j] + lo, j[i + lo < j])


def near_classes(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, near_class) of each fingerprint in `marked` (doc_id, fp): the smallest id that can be reached by links of at most `radius`."""
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    label = components(linked_by_keys(distinct, radius, block_tables(radius), direct_pairs))
    placed = distinct.join(label.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    head = placed.groupBy("component").agg(F.min("least").alias("near_class"))
    return placed.select("fp", "component").join(head, "component").select("fp", "near_class")


def bounds_reached(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most `value`: first by groups of them, then within one."""
    if not bounds:
        return F.lit(0)
    size = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[k : k + size] for k in range(0, len(bounds), size)]

    def reached(among: Column) -> Column:
        return F.size(F.filter(among, lambda b: b <= value))

    heads = F.array(*(F.lit(g[0]) for g in groups)).cast("array<long>")
    inside = F.array(*(F.array(*map(F.lit, g)).cast("array<long>") for g in groups))
    group = reached(heads)
    return F.when(group == 0, 0).otherwise((group - 1) * size + reached(F.get(inside, group - 1)))


def in_order(keys: DataFrame, buckets: int) -> DataFrame:
    """`keys` dealt to buckets of consecutive ids; the first row of each also stands, marked `ahead`, at the end of the bucket before.

    Only bounds and first ids, a row for each bucket, reach the driver.
    """
    shares = [k / buckets for k in range(1, buckets)]
    bounds = keys.agg(F.percentile_approx("id", shares, 10_000)).first()[0] if shares else []
    bounds = sorted(set(bounds or []))
    keys = keys.withColumn("bucket", bounds_reached(F.col("id"), bounds))
    firsts = [(r.bucket, r.first.id, r.first.tag) for r in keys.groupBy("bucket").agg(F.min(F.struct("id", "tag")).alias("first")).collect()]
    firsts.sort()
    spark = keys.sparkSession
    before = spark.createDataFrame(
        [(b, i, t, firsts[k - 1][0]) for k, (b, i, t) in enumerate(firsts)], "bucket int, id long, tag long, before int"
    )
    return (
        keys.join(F.broadcast(before), ["bucket", "id", "tag"], "left")
        .withColumn("place", F.expr("explode(if(before is null, array(struct(bucket as at, false as ahead)), array(struct(bucket as at, false as ahead), struct(before as at, true as ahead))))"))
        .select("doc_id", "text", "id", "tag", F.col("place").getField("at").alias("bucket"), F.col("place").getField("ahead").alias("ahead"))
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp) of each row of `docs`.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by as many of
    the first ones (or all) of the next document by ascending id; after the last comes the first. A
    null text is empty. Null ids come first; rows that share an id follow each other, ordered by a
    checksum of their text. An empty table gives an empty table; extra columns are ignored.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = in_order(keyed(docs, id_col, text_col), buckets)
    schema = "doc_id long, n_chars long, edited_sha256 string, fp long, edited_fp long, next_fp long"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = pa.Table.from_batches([batch.slice(lo, SLICE_ROWS)])
                part = part if held is None else pa.concat_tables([held, part])
                yield from edited(part)
                held = part.slice(part.num_rows - 1)
        W.release()

    def edited(part: pa.Table) -> Iterator[pa.RecordBatch]:
        """Rows that have their next one in the same bucket behind them."""
        bucket, ahead = part["bucket"].to_numpy(), part["ahead"].to_numpy()
        at = np.flatnonzero((bucket[1:] == bucket[:-1]) & ~ahead[:-1].astype(bool))
        if not len(at):
            return
        texts = part["text"].to_pylist()
        fp = text_fingerprints(part["text"])
        size = np.array([len(t) for t in texts])
        new = [texts[i][: size[i] - size[i] // 2] + texts[i + 1][: size[i] // 2] for i in at.tolist()]
        sha = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in new]
        columns = [part["doc_id"].combine_chunks().take(pa.array(at)), pa.array(size[at]), pa.array(sha)]
        prints = [fp[at], text_fingerprints(pa.array(new, pa.string())), fp[at + 1]]
        yield pa.RecordBatch.from_arrays(columns + [pa.array(x.view(np.int64)) for x in prints], [f.split()[0] for f in schema.split(", ")])

    return (
        dealt.repartition("bucket").sortWithinPartitions("bucket", "ahead", "id", "tag")
        .select("doc_id", "text", "bucket", "ahead").mapInArrow(rows, schema)
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = written_in_small_batches(edited_fingerprints(shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")))
    near = near_classes(marked)

    def text_of(name: str):
        return F.lower(F.lpad(F.hex(name), 16, "0"))

    def likeness(name: str):
        return 1 - F.bit_count(F.col("fp").bitwiseXOR(F.col(name))) / F.lit(64.0)

    return marked.join(near, "fp").select(
        "doc_id", "n_chars", "edited_sha256", text_of("fp").alias("fingerprint"), text_of("edited_fp").alias("edited_fingerprint"),
        likeness("edited_fp").alias("near_edited"), likeness("next_fp").alias("near_next"), "near_class",
    )
