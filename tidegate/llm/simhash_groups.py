"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints of 3-word shingles are collapsed to distinct values, range partitioned and sorted by Gray
rank, and cut into pieces of 4,096: neighbours share long bit patterns. One tree stands over all of
them. Its upper nodes are ranges of the Gray order with the bits that all below share; its lower nodes
are inside the pieces. Pairs of nodes are followed from the root down, in joins on the parent above
the pieces and in numpy below, and go with all under them when their shared bits already differ too
much. The longer the order, the more bits its ranges share: with n values about n log^3 n pairs of
values are ever compared.

Links leave a pair of pieces as a spanning forest, never as all pairs; connected components join the
forests. A third of all documents under one fingerprint is one row from the second step on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidegate.llm import words as W
from tidegate.llm.components import components
from tidegate.llm.fingerprints import GrayTree, bit_votes, forest, gray_rank, near_pairs, pack_bits, star_edges
from tidegate.llm.repeated_windows import keyed, tagged
from tidegate.llm.scratch import shipped, written, written_in_small_batches

RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
U64 = np.uint64
#: Values of a piece; bits of the rank by which an upper node has children; pairs of pieces in a batch of a task.
PIECE_ROWS = 4096
LEVEL_BITS = 4
PAIRS_AT_ONCE = 64
TOP, _MIN = U64(1 << 63), -(1 << 63)


def shingle_fingerprints(texts: W.Texts) -> np.ndarray:
    """The fingerprint of each text of a group."""
    lower = W.Texts(texts.first, W.LOWER[texts.data], texts.begin, texts.end)
    words = W.find_words(lower, W.NON_SPACE)
    length = words.end - words.start
    at = np.concatenate([[0], np.cumsum(length + 1)])
    source = np.repeat(words.start - at[:-1], length + 1) + np.arange(at[-1])
    joined = lower.data[np.minimum(source, max(len(lower.data) - 1, 0))] if len(source) else np.zeros(0, np.uint8)
    joined[at[1:] - 1] = 0x20
    shingles = np.where(words.count == 0, 0, np.maximum(words.count - SHINGLE_WORDS + 1, 1))
    owner = np.repeat(np.arange(len(shingles)), shingles)
    first = np.concatenate([[0], np.cumsum(shingles)])[:-1]
    head = words.first[owner] + np.arange(len(owner)) - first[owner]
    tail = head + np.minimum(words.count, SHINGLE_WORDS)[owner] - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(raw[a:b], SEED) for a, b in zip(at[head].tolist(), (at[tail + 1] - 1).tolist())), np.uint64, len(head)
    )
    return pack_bits(2 * bit_votes(hashes, first, shingles) > shingles[:, None])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tag, doc_id, fp): one row per row of `docs`, fp as a signed long. A null text has fingerprint 0."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                fp = np.concatenate([shingle_fingerprints(t) for t in W.text_groups(batch.column(3))])
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fp.view(np.int64))], ["id", "tag", "doc_id", "fp"])

    return keyed(docs, id_col, text_col).mapInArrow(rows, "id long, tag long, doc_id long, fp long")


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


PIECES = "a long, b long, head long, ones long, some long, members binary"
PIECE_SCHEMA = pa.schema([(n, pa.int64()) for n in ("a", "b", "head", "ones", "some")] + [("members", pa.binary())])


def gray_pieces(distinct: DataFrame, radius: int) -> DataFrame:
    """Distinct fingerprints `fp` in Gray order, cut into pieces, with the links within each.

    A piece has the Gray rank of its first member, the bits that all of its members set, those that
    some set, and the members; a link has a and b.
    """

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            # Ranks order unsigned; flipping the top bit makes the signed order the same.
            yield pa.RecordBatch.from_arrays([_signed(gray_rank(values) ^ TOP), batch.column(0)], ["rank", "fp"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64)
        for batch in batches:
            held = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)])
            while len(held) >= PIECE_ROWS:
                yield from piece(held[:PIECE_ROWS])
                held = held[PIECE_ROWS:]
        if len(held):
            yield from piece(held)

    def piece(values: np.ndarray) -> Iterator[pa.RecordBatch]:
        tree = GrayTree(values)
        a, b = star_edges(values, forest(len(values), near_pairs(tree, tree, radius)))
        if len(a):
            yield pa.RecordBatch.from_arrays([_signed(a), _signed(b), *(pa.nulls(len(a), f.type) for f in list(PIECE_SCHEMA)[2:])], schema=PIECE_SCHEMA)
        facts = [_signed(np.array([x], np.uint64)) for x in (gray_rank(values[:1])[0], np.bitwise_and.reduce(values), np.bitwise_or.reduce(values))]
        none = [pa.nulls(1, pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([*none, *facts, pa.array([values.tobytes()], pa.binary())], schema=PIECE_SCHEMA)

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = distinct.select("fp").mapInArrow(rank, "rank long, fp long")
    return ranked.repartitionByRange(parts, "rank").sortWithinPartitions("rank").mapInArrow(cut, PIECES)


def _node(head: str, level: int) -> Column:
    """The node of a level that a rank is below: its leading bits."""
    return F.shiftrightunsigned(head, 64 - LEVEL_BITS * level)


def _apart(radius: int) -> Column:
    """Whether nodes l and r may hold values within `radius`: what all below each of them share differs in so few places."""
    shared = [F.bitwise_not(F.col(f"{s}_ones").bitwiseXOR(F.col(f"{s}_some"))) for s in "lr"]
    differ = F.col("l_ones").bitwiseXOR(F.col("r_ones")).bitwiseAND(shared[0]).bitwiseAND(shared[1])
    return F.bit_count(differ) <= radius


def _sides(nodes: DataFrame) -> list[DataFrame]:
    return [nodes.select(*(F.col(c).alias(f"{s}_{c}") for c in nodes.columns)) for s in "lr"]


def near_pieces(pieces: DataFrame, radius: int) -> DataFrame:
    """(l_head, r_head): pairs of pieces that may hold values within `radius` of each other.

    Upper nodes of the tree are ranges of the Gray order, by the leading bits of the rank, each with
    the bits shared by all below it. Pairs of nodes are followed from the root down, level by level;
    one goes, with all below it, when its shared bits already differ in more than `radius` places.
    """
    levels = max(-(-pieces.count().bit_length() // LEVEL_BITS), 1)
    pairs = None
    for level in range(1, levels + 1):
        nodes = pieces.groupBy(_node("head", level).alias("node")).agg(F.bit_and("ones").alias("ones"), F.bit_or("some").alias("some"))
        left, right = _sides(nodes.withColumn("above", F.shiftrightunsigned("node", LEVEL_BITS)))
        above = pieces.sparkSession.range(1).select(F.col("id").alias("a"), F.col("id").alias("b")) if pairs is None else pairs
        met = above.join(left, F.col("a") == F.col("l_above")).join(right, F.col("b") == F.col("r_above"))
        pairs = met.where((F.col("l_node") <= F.col("r_node")) & _apart(radius)).select(F.col("l_node").alias("a"), F.col("r_node").alias("b"))
    left, right = _sides(pieces.select("head", "ones", "some", _node("head", levels).alias("node")))
    met = pairs.join(left, F.col("a") == F.col("l_node")).join(right, F.col("b") == F.col("r_node"))
    first = F.col("l_head").bitwiseXOR(F.lit(_MIN)) < F.col("r_head").bitwiseXOR(F.lit(_MIN))
    return met.where(((F.col("a") < F.col("b")) | first) & _apart(radius)).select("l_head", "r_head")


def near_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect whatever distinct fingerprints `fp` lie within `radius` of each other."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one, two = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                found = ((i, j + len(one)) for i, j in near_pairs(GrayTree(one), GrayTree(two), radius))
                both = np.concatenate([one, two])
                a, b = star_edges(both, forest(len(both), found))
                if len(a):
                    yield pa.RecordBatch.from_arrays([_signed(a), _signed(b)], ["a", "b"])

    found = written(gray_pieces(distinct, radius))
    pieces = found.where("head is not null").select("head", "ones", "some", "members")
    pairs = written(near_pieces(pieces.drop("members"), radius))
    left, right = (pieces.select(F.col("head").alias(f"{s}_head"), F.col("members").alias(f"{s}_members")) for s in "lr")
    met = pairs.join(left, "l_head").join(right, "r_head").select("l_members", "r_members")
    across = written_in_small_batches(met.mapInArrow(pair, "a long, b long"), PAIRS_AT_ONCE)
    return found.where("a is not null").select("a", "b").union(across)


def fingerprint_groups(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component) of each fingerprint in `marked`; component is the smallest fingerprint reachable."""
    distinct = written(marked.select("fp").distinct())
    label = components(near_links(distinct, radius))
    placed = distinct.join(label.select(F.col("node").alias("fp"), "component"), "fp", "left")
    return placed.select("fp", F.coalesce("component", "fp").alias("component"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of `docs`.

    component_id is the smallest id that can be reached over links, the row's own included. Null,
    empty and blank texts have fingerprint zero and link like any other. Repeated rows stay as rows
    of their own. Null ids never become a component_id unless a component has no other. An empty
    table gives an empty table; extra columns are ignored.
    """
    marked = written(fingerprints(docs, id_col, text_col))
    group = fingerprint_groups(marked, radius)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least")).join(group, "fp")
    head = least.groupBy("component").agg(F.min("least").alias("component_id"))
    named = group.join(head, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """`docs` with one row of each group: that of the smallest id, rows without an id only where a group has no other.

    Of rows repeated under that id, the first by text checksum and the other columns stays.
    """
    marked = written(fingerprints(docs, id_col, text_col))
    return kept_heads(docs, marked, fingerprint_groups(marked, radius), id_col, text_col)


def kept_heads(docs: DataFrame, marked: DataFrame, group: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` that `keep_one_each` keeps: `marked` has id, tag, doc_id and fp of each row, `group` the component of each fp."""
    key = F.struct(F.col("doc_id").isNull().alias("last"), "id", "tag")
    least = marked.groupBy("fp").agg(F.min(key).alias("least")).join(group, "fp")
    rows, (id_, tag) = tagged(docs, id_col, text_col)
    heads = least.groupBy("component").agg(F.min("least").alias("head")).select(F.col("head.id").alias(id_), F.col("head.tag").alias(tag))
    others = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant") and f.name not in (id_col, text_col)]
    place = F.row_number().over(Window.partitionBy(id_, tag).orderBy(F.col(text_col).isNull(), *others, text_col))
    kept = rows.join(heads, [id_, tag]).withColumn(f"{tag}_place", place)
    return kept.where(F.col(f"{tag}_place") == 1).select(*(F.col(f"`{c}`") for c in docs.columns))


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(shipped(spark).read.parquet(f"{sf_dir}/documents.parquet"))
