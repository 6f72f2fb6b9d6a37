"""Prefix trie of rebuilt conversations, by Z-fast tries that merge.

A sequence of turns is named by its prefix hashes: at depth d the exclusive or of 128 random bits for
each (turn, place) up to d. Every task keeps a Z-fast trie of its conversations: compacted nodes are
hashed at their two-fattest depth handle, a batch of conversations finds its exit nodes by fat binary
search over prefix hashes, and is then inserted, splitting the edges it leaves. A task expands the
edges of its trie into one row for each prefix, and rows of equal prefix merge in one aggregate: a
first turn that a third of all conversations share comes to that shuffle once per trie.

Sums over a subtree need no walk over the tree. A node is owned by the smallest conversation in it, so
a conversation owns a stretch of its own path, down to its end; what a conversation owns counts for all
prefixes of it, which is one more pass of tries with other weights.

Sequences are cut into segments of 1,024 turns, each a string below the prefix that it continues, so
that no row or trie holds a conversation of any length whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidegate.llm.scratch import shipped, written

GROUP = 20
HEADS = 4
SEGMENT_TURNS = 1 << 10
#: Prefixes that a task's trie holds before it is expanded and begun anew.
TRIE_PREFIXES = 1 << 18
BLOCK_IDS = 1 << 16
PREFIX_CHARS = 64
KEY = ["k1", "k2", "depth"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class ZFastTrie:
    """Compacted trie over sequences of prefix hashes; element 0 of a sequence names its root."""

    def __init__(self, width: int):
        self.width = width
        self.handles: dict[bytes, int] = {}
        self.below: dict[bytes, int] = {}  # by the first prefix of an edge
        self.roots: dict[bytes, int] = {}
        self.path: list[tuple] = []  # (prefixes, words up to each, depth of the root)
        self.low: list[int] = []
        self.high: list[int] = []
        self.parent: list[int] = []
        self.least: list[int] = []
        self.sums: list[list[int]] = []
        self.held = 0

    def _node(self, path: tuple, low: int, high: int, parent: int) -> int:
        for field, value in zip((self.path, self.low, self.high, self.parent, self.least, self.sums), (path, low, high, parent, None, [0] * self.width)):
            field.append(value)
        node = len(self.path) - 1
        if high > low:
            self.handles[path[0][self.handle(low, high)]] = node
            self.below[path[0][low + 1]] = node
        return node

    @staticmethod
    def handle(low: int, high: int) -> int:
        """The two-fattest number in (low, high]."""
        return high & (-1 << ((low ^ high).bit_length() - 1))

    def locate(self, prefixes: list[bytes], top: int) -> int:
        """The deepest node at or below `top` whose whole extent the sequence has."""
        low, high = self.high[top], len(prefixes) - 1
        while low < high:
            at = self.handle(low, high)
            node = self.handles.get(prefixes[at])
            if node is None:
                high = at - 1
                continue
            extent = self.high[node]
            if extent >= len(prefixes) or self.path[node][0][extent] != prefixes[extent]:
                return self.parent[node]
            top, low = node, extent
        return top

    def insert(self, path: tuple, top: int, weights: list[int], least: int) -> None:
        prefixes = path[0]
        top = self.locate(prefixes, top)
        at, end = self.high[top], len(prefixes) - 1
        if at < end:
            child = self.below.get(prefixes[at + 1])
            if child is not None:
                top = self._split(child, self._shared(child, prefixes))
                at = self.high[top]
            if at < end:
                top = self._node(path, at, end, top)
                self.held += end - at
        self.sums[top] = [a + b for a, b in zip(self.sums[top], weights)]
        self.least[top] = least if self.least[top] is None else min(self.least[top], least)

    def _shared(self, node: int, prefixes: list[bytes]) -> int:
        """How far down the edge of `node` the sequence goes."""
        low, high = self.low[node] + 1, min(self.high[node], len(prefixes) - 1)
        own = self.path[node][0]
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if own[middle] == prefixes[middle] else (low, middle - 1)
        return low

    def _split(self, node: int, at: int) -> int:
        path, low, high = self.path[node], self.low[node], self.high[node]
        if at == high:
            return node
        del self.handles[path[0][self.handle(low, high)]]
        middle = self._node(path, low, at, self.parent[node])
        self.low[node], self.parent[node] = at, middle
        self.handles[path[0][self.handle(at, high)]] = node
        self.below[path[0][at + 1]] = node
        return middle

    def insert_batch(self, batch: list[tuple[tuple, list[int], int]]) -> None:
        """Exit nodes of the whole batch first; splits by its own members only move an exit further down."""
        tops = []
        for path, _, _ in batch:
            root = self.roots.get(path[0][0])
            if root is None:
                root = self.roots[path[0][0]] = self._node(path, 0, 0, -1)
            tops.append(self.locate(path[0], root))
        for (path, weights, least), top in zip(batch, tops):
            self.insert(path, top, weights, least)

    def expanded(self) -> Iterator[tuple]:
        """(prefix, depth, prefix before it, words of the last turn, words up to it, least, sums) of every prefix."""
        for node in sorted(range(len(self.path)), key=lambda k: -self.high[k]):
            above = self.parent[node]
            if above >= 0:
                self.sums[above] = [a + b for a, b in zip(self.sums[above], self.sums[node])]
                if self.least[above] is None or self.least[node] < self.least[above]:
                    self.least[above] = self.least[node]
            prefixes, words, base = self.path[node]
            if above < 0 and base == 0:
                yield prefixes[0], 0, None, 0, 0, self.least[node], self.sums[node]
            for d in range(self.low[node] + 1, self.high[node] + 1):
                yield prefixes[d], base + d, prefixes[d - 1], words[d] - words[d - 1], words[d], self.least[node], self.sums[node]


def _prefixes(start: tuple[int, int], first: np.ndarray, second: np.ndarray) -> list[bytes]:
    chain = np.empty((len(first) + 1, 2), np.int64)
    chain[0], chain[1:, 0], chain[1:, 1] = start, first, second
    raw = np.bitwise_xor.accumulate(chain, axis=0).tobytes()
    return [raw[k : k + 16] for k in range(0, len(raw), 16)]


def prefix_sums(segments: DataFrame, weights: list[str]) -> DataFrame:
    """Each prefix of `segments` with its parent, words, smallest conversation, and sums of `weights` over the conversations that have it.

    (k1, k2, depth, p1, p2, words, sofar, least, *weights); the empty prefix has no parent.
    """
    names = ["k1", "k2", "depth", "p1", "p2", "words", "sofar", "least", *weights]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def rows(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
        found = list(trie.expanded())
        for lo in range(0, len(found), 10_000):
            prefix, depth, before, words, sofar, least, sums = zip(*found[lo : lo + 10_000])
            own = np.frombuffer(b"".join(prefix), np.int64).reshape(-1, 2)
            up = np.frombuffer(b"".join(b or bytes(16) for b in before), np.int64).reshape(-1, 2)
            root = np.array([b is None for b in before])
            columns = [pa.array(own[:, 0]), pa.array(own[:, 1]), pa.array(depth, pa.int64())]
            columns += [pa.array(up[:, 0], mask=root), pa.array(up[:, 1], mask=root)]
            columns += [pa.array(x, pa.int64()) for x in (words, sofar, least, *zip(*sums))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie(len(weights))
        for batch in batches:
            conv, base, r1, r2, sofar = (batch.column(k).to_pylist() for k in range(5))
            lists = [batch.column(k).combine_chunks() if isinstance(batch.column(k), pa.ChunkedArray) else batch.column(k) for k in (5, 6, 7)]
            amounts = list(zip(*(batch.column(k).to_pylist() for k in range(8, 8 + len(weights)))))
            held = []
            for k in range(batch.num_rows):
                g1, g2, words = (x[k].values.to_numpy(zero_copy_only=False) for x in lists)
                chain = _prefixes((r1[k], r2[k]), g1, g2)
                held.append(((chain, (np.concatenate([[0], np.cumsum(words)]) + sofar[k]).tolist(), base[k]), list(amounts[k]), conv[k]))
            trie.insert_batch(held)
            if trie.held > TRIE_PREFIXES:
                yield from rows(trie)
                trie = ZFastTrie(len(weights))
        yield from rows(trie)

    columns = ["conv", "base", "r1", "r2", "before", "g1", "g2", "words", *weights]
    parts = segments.select(*columns).mapInArrow(expand, ", ".join(f"{n} long" for n in names))
    same = (F.max(c).alias(c) for c in ("p1", "p2", "words", "sofar"))
    return parts.groupBy(*KEY).agg(*same, F.min("least").alias("least"), *(F.sum(w).alias(w) for w in weights))


def _crc(conv: str) -> Column:
    return F.crc32(F.col(conv).cast("string").cast("binary")) % HEADS


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, at, t1, t2, words) of the turns of rebuilt conversations, `at` from 1, and (conv) of all conversations.

    Turns are placed by a global sort in range partitions; a conversation that spans several is
    numbered on from one to the next, so none is gathered whole.
    """
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    ordered = turns.repartitionByRange(parts, "conv", "turn", "role", F.substring("text", 1, PREFIX_CHARS)).sortWithinPartitions("conv", "turn", "role", "text")
    # One row each, numbered in that order; the number's upper bits are the partition.
    placed = written(
        ordered.select(
            "conv",
            F.monotonically_increasing_id().alias("number"),
            F.xxhash64(F.lit(1), "role", "text").alias("t1"),
            F.xxhash64(F.lit(2), "text", "role").alias("t2"),
            F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        ).withColumn("part", F.shiftright("number", 33))
    )
    spans = placed.groupBy("conv", "part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select("conv", "part", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    convs = placed.groupBy("conv").agg(F.count("*").alias("n")).select("conv", "n", _crc("conv").alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("donor"))
    donors = convs.where(f"conv % {GROUP} = 0").select(F.col("conv").alias("donor"), F.col("n").alias("donor_n"))
    convs = written(convs.join(donors, "donor", "left").select("conv", "donor", "h", F.least("h", F.coalesce("donor_n", F.lit(0))).alias("given")))
    spans = spans.join(convs.drop("donor"), "conv")
    place = F.row_number().over(Window.partitionBy("conv", "part").orderBy("number"))
    at = placed.withColumn("place", place).join(spans, ["conv", "part"]).withColumn("at", F.col("earlier") + F.col("place"))
    at = written(at.select("conv", "at", "t1", "t2", "words", "h", "given"))
    own = at.where("at > h").select("conv", (F.col("at") - F.col("h") + F.col("given")).alias("at"), "t1", "t2", "words")
    heads = at.where(f"conv % {GROUP} = 0 and at < {HEADS}").select(F.col("conv").alias("donor"), "at", "t1", "t2", "words")
    lent = convs.where("given > 0").join(heads, "donor").where("at <= given").select("conv", "at", "t1", "t2", "words")
    return own.unionByName(lent), convs.select("conv")


def segments_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, base, r1, r2, before, g1, g2, words, total, last, k1, k2, depth): stretches of at most 1,024 turns.

    r1, r2 name the prefix before a segment, `before` are its words; g1, g2 are the random bits of
    each turn in its place; total are the words of the conversation. Of the last segment, k1, k2 and
    depth name the whole sequence. A conversation without turns has one empty segment.
    """
    seg = F.floor((F.col("at") - 1) / SEGMENT_TURNS).cast("long")
    bits = turns.select("conv", seg.alias("seg"), "at", F.xxhash64("t1", "t2", "at", F.lit(1)).alias("g1"), F.xxhash64("t2", "t1", "at", F.lit(2)).alias("g2"), "words")
    bits = written(bits)
    sums = bits.groupBy("conv", "seg").agg(F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"), F.sum("words").alias("w"), F.count("*").alias("n"))
    ahead = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv")
    sums = sums.select(
        "conv",
        "seg",
        *(F.coalesce(F.bit_xor(f"x{k}").over(ahead), F.lit(0)).alias(f"r{k}") for k in (1, 2)),
        F.coalesce(F.sum("w").over(ahead), F.lit(0)).alias("before"),
        F.sum("w").over(whole).alias("total"),
        (F.max("seg").over(whole) == F.col("seg")).alias("last"),
        "x1",
        "x2",
        (F.col("seg") * SEGMENT_TURNS + F.col("n")).alias("depth"),
    )
    lists = bits.groupBy("conv", "seg").agg(F.sort_array(F.collect_list(F.struct("at", "g1", "g2", "words"))).alias("s"))
    joined = lists.join(sums, ["conv", "seg"]).select(
        "conv",
        (F.col("seg") * SEGMENT_TURNS).alias("base"),
        "r1",
        "r2",
        "before",
        *(F.col(f"s.{c}").alias(c) for c in ("g1", "g2", "words")),
        "total",
        "last",
        *(F.col(f"r{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"k{k}") for k in (1, 2)),
        "depth",
    )
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")
    names = dict(base=zero, r1=zero, r2=zero, before=zero, g1=none, g2=none, words=none, total=zero, last=F.lit(True), k1=zero, k2=zero, depth=zero)
    without = convs.join(bits.select("conv").distinct(), "conv", "left_anti")
    return joined.unionByName(without.select("conv", *(c.alias(n) for n, c in names.items())))


def end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, depth, sha): SHA-256 of the comma-joined ids `conv` that end at each prefix, in ascending order.

    Ids are sorted in range partitions and packed into blocks there; a hash runs over the blocks of a
    prefix in order and holds one of them at a time.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        key, ids, out = None, [], []

        def close() -> None:
            if ids:
                out.append((*key, ids[0], packer.compress(",".join(map(str, ids)).encode())))
                ids.clear()

        for batch in batches:
            for *now, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if now != key or len(ids) >= BLOCK_IDS:
                    close()
                    key = now
                ids.append(conv)
            yield block(out)
            out.clear()
        close()
        yield block(out)

    def block(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * 5
        kinds = (*[pa.int64()] * 4, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [*KEY, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        held, state = None, None

        def done(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (*[pa.int64()] * 3, pa.string()))], [*KEY, "sha"])

        for batch in batches:
            out = []
            for key, group in groupby(zip(*(c.to_pylist() for c in batch.columns)), key=lambda r: r[:3]):
                if key != held:
                    if held is not None:
                        out.append((*held, state.hexdigest()))
                    held, state, comma = key, hashlib.sha256(), b""
                else:
                    comma = b","
                for *_, ids in group:
                    state.update(comma + opener.decompress(ids))
                    comma = b","
            yield done(out)
        if held is not None:
            yield done([(*held, state.hexdigest())])

    packed = ends.select(*KEY, "conv").repartitionByRange(parts, *KEY, "conv").sortWithinPartitions(*KEY, "conv")
    blocks = packed.mapInArrow(pack, "k1 long, k2 long, depth long, first long, ids binary")
    return blocks.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, "k1 long, k2 long, depth long, sha string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations, the empty one included.

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `conversations` has conv_id, turn, role and text. Turns of a conversation are in order of turn
    (null first), then role, then text, so repeated rows are turns of their own and ties have one
    order. Null roles and texts are empty. Rows without a conv_id belong to no conversation. Extra
    columns are ignored, whatever their names. An empty table gives an empty table.
    """
    turns, convs = rebuilt_turns(conversations)
    segments = written(segments_of(turns, convs).withColumn("n", F.lit(1).cast("long")))
    ends = segments.where("last").select(*KEY, "conv")
    nodes = prefix_sums(segments, ["n", "total"])
    at_end = ends.groupBy(*KEY).agg(F.count("*").alias("ended"))
    nodes = written(nodes.join(at_end, KEY, "left").withColumn("leaf", (F.col("n") == F.coalesce("ended", F.lit(0))).cast("long")))
    owners = written(nodes.groupBy(F.col("least").alias("conv")).agg(F.sum("words").alias("owned"), F.max("leaf").alias("leaf"), F.max("sofar").alias("to_end")))
    below = prefix_sums(segments.join(owners.select("conv", "owned", "leaf"), "conv"), ["owned", "leaf"]).select(*KEY, "owned", F.col("leaf").alias("leaves"))
    children = nodes.where("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    facts = (
        nodes.join(below, KEY)
        .join(children, KEY, "left")
        .join(end_digests(ends), KEY, "left")
        .join(owners.select(F.col("conv").alias("least"), F.col("owned").alias("its_own"), "to_end"), "least")
    )
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("least").alias("parent_conv_id"))
    # Words from a node down: of each member conversation, less those of each distinct node once.
    above = F.col("sofar") - F.col("words")
    spoken = F.col("total") - F.col("n") * above
    distinct = F.col("owned") - F.col("its_own") + F.col("to_end") - above
    return written(facts).join(parents, ["p1", "p2", "depth"], "left").select(
        F.col("least").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (spoken - distinct).alias("saved_tokens"),
        F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(shipped(spark).read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE_SQL = r"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as spot
  from conversations where conv_id is not null
), convs as (
  select conv_id, count(*) as n, conv_id - conv_id % 20 as donor,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, z: xor(b >> 1, 3988292384 * (b & 1)))), 4294967295) % 4 as h
  from turns group by conv_id
), made as (
  select c.conv_id, t.spot, t.role, t.text from convs c join turns t on t.conv_id = c.donor and t.spot <= c.h
  union all
  select c.conv_id, t.spot - c.h + least(c.h, coalesce(d.n, 0)) as spot, t.role, t.text
  from convs c join turns t using (conv_id) left join convs d on d.conv_id = c.donor where t.spot > c.h
), prefixes as (
  select conv_id, spot as depth, string_agg(md5(length(role) || ' ' || role || text), '') over (partition by conv_id order by spot) as path,
    len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as words
  from made
  union all
  select conv_id, 0 as depth, '' as path, 0 as words from convs
), nodes as (
  select path, depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(words) as saved from prefixes group by path, depth
), ends as (
  select path, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from (select conv_id, max_by(path, depth) as path from prefixes group by conv_id) group by path
), children as (
  select left(path, length(path) - 32) as path, count(*) as n_children from nodes where depth > 0 group by all
), sizes as (
  select v.path, sum(u.saved) as saved_tokens, count(*) filter (c.path is null) as n_leaves
  from nodes v join nodes u on starts_with(u.path, v.path) left join children c on c.path = u.path group by v.path
)
select v.conv_id, v.depth, p.conv_id as parent_conv_id, v.n_convs, coalesce(c.n_children, 0)::bigint as n_children, s.n_leaves::bigint as n_leaves,
  s.saved_tokens::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from nodes v join sizes s using (path) left join children c using (path) left join ends e using (path)
left join nodes p on v.depth > 0 and p.depth = v.depth - 1 and p.path = left(v.path, length(v.path) - 32)
"""
