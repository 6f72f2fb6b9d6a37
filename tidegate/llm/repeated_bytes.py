"""Byte-level dedup of 200-byte strings by prefix-free parsing.

Rolling-hash triggers: every start of a 200-byte string belongs to the position with the least
rolling hash among the 128 that follow it, the leftmost of equals. That depends on the string alone,
so equal strings have their triggers at equal places, and no start is further than 127 bytes from its
trigger. The starts of one trigger make a phrase: the bytes from its first start to the end of the
string of its last one. The distinct phrases are the dictionary, their places the parse.

A phrase that occurs twice repeats whole, and needs no look at its single starts; in repetitive text
these are nearly all. What is left are phrases that share the 73 bytes behind the trigger, which all
strings of a phrase have in common, and differ elsewhere. For these two orders are built: of the
dictionary, by the bytes before the trigger read backwards, and of the parse, by the bytes from the
trigger on. Strings that start x bytes before their triggers are equal if their phrases lie in one
run of the first order with common prefixes of x or more, and in one run of the second with common
prefixes of 200 - x or more. So the two sorted orders decide corpus order without sorting each start.

Families too large for one task, such as the edges of a passage that stands in a third of all texts,
are counted first and dealt out by the hash of each 200-byte string instead; equal strings of a
batch come once, and unequal ones spread evenly.

A phrase whose 73 bytes are met once in the corpus cannot repeat; a merged bit sketch of bounded size
keeps nearly all of these from the shuffle. Equal phrases of one batch are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import sketch, words as W
from tidegate.llm.repeated_windows import keyed
from tidegate.llm.scratch import shipped, written_in_small_batches

LENGTH = 200
ROLLING_BYTES = 8
REACH = 128
SHARED = LENGTH - REACH + 1
CHUNK_BYTES = 1 << 20
ORDER_ROWS = 1 << 14
BUCKET_BYTES = 1 << 22
U64 = np.uint64
FIELDS = (("shared", np.uint64), ("whole", np.uint64), ("id", np.int64), ("start", np.int64), ("tag", np.int64), ("count", np.uint8), ("before", np.uint8), ("known", np.uint8))
STRING_FIELDS = (("a", np.uint64), ("b", np.uint32), ("id", np.int64), ("start", np.int64), ("tag", np.int64), ("known", np.uint8))
BLOBS = "bucket int, kind int, blob binary, id long, tag long, gone binary"
#: Kinds of blobs: phrases, or single strings of hot families.
PHRASES, STRINGS = 0, 1
#: A family of phrases (those that share the bytes behind their trigger) with more rows than this is
#: dealt out string by string. The list of such families has at most candidates / HOT_ROWS entries.
HOT_ROWS = 50_000


@dataclass
class Phrases:
    """Of a stretch of bytes: trigger, first start, number of starts, the text (its place in the stretch) each is in."""

    data: np.ndarray
    trigger: np.ndarray
    first: np.ndarray
    count: np.ndarray
    text: np.ndarray
    shared: np.ndarray
    sums: np.ndarray

    def whole(self, at: np.ndarray) -> np.ndarray:
        return _hashes(self.sums, self.first[at], self.first[at] + self.count[at] - 1 + LENGTH)


def _hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, _, inverse = W._lane(0)
    size = 1 << max(21, (len(sums) - 1).bit_length())
    return W.mix((sums[end] - sums[start]) * W.powers(inverse, size)[start] + (end - start).astype(np.uint64))


def stretches(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, int]]:
    """(data, begin, end, row, base): texts of a column, long ones in pieces that overlap by a string less a byte."""
    for texts in W.text_groups(column, CHUNK_BYTES):
        if len(texts.begin) > 1 or len(texts.data) <= 2 * CHUNK_BYTES:
            yield texts.data, texts.begin, texts.end, texts.first, 0
            continue
        for base in range(0, max(len(texts.data) - LENGTH + 1, 1), CHUNK_BYTES):
            data = texts.data[base : base + CHUNK_BYTES + LENGTH - 1]
            yield data, np.zeros(1, np.int64), np.array([len(data)]), texts.first, base


def parse(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Phrases:
    table, base, _ = W._lane(0)
    size = 1 << max(21, len(data).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * W.powers(base, size)[: len(data)], out=sums[1:])
    n = len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    starts_of = np.maximum(end - begin - LENGTH + 1, 0)
    if n <= 0 or not starts_of.any():
        return Phrases(data, none, none, none, none, np.zeros(0, np.uint64), sums)
    at = np.arange(n + REACH - 1)
    least = (_hashes(sums, at, at + ROLLING_BYTES) & U64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    step = 1
    while step < REACH:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    text = np.repeat(np.arange(len(begin)), starts_of)
    start = np.arange(len(text)) - np.repeat(np.cumsum(starts_of) - starts_of, starts_of) + begin[text]
    trigger = (least[start] & U64(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])]))
    count = np.diff(cut, append=len(start))
    trigger = trigger[cut]
    return Phrases(data, trigger, start[cut], count, text[cut], _hashes(sums, trigger, trigger + SHARED), sums)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length) of each run of true values in the rows of a matrix."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, lo = np.nonzero(edge == 1)
    return row, lo, np.nonzero(edge == -1)[1] - lo


def _order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each row in byte order, and at each place the length of the prefix common with the row before."""
    n, width = rows.shape
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").reshape(-1), kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    ordered = rows[order]
    differ = np.ones((n, width + 1), bool)
    differ[1:, :width] = ordered[1:] != ordered[:-1]
    common = differ.argmax(axis=1)
    common[0] = 0
    return place, common


def repeated_starts(phrases: list[np.ndarray], count: np.ndarray, before: np.ndarray) -> np.ndarray:
    """For each distinct phrase, which of its starts have an equal string among the others' (or its own) starts."""
    n = len(phrases)
    ahead = np.zeros((n, REACH), np.uint8)
    behind = np.zeros((n, LENGTH), np.uint8)
    for k, (phrase, split) in enumerate(zip(phrases, before.tolist())):
        ahead[k, :split] = phrase[:split][::-1]
        tail = phrase[split : split + LENGTH]
        behind[k, : len(tail)] = tail
    place_a, common_a = _order(ahead)
    place_b, common_b = _order(behind)
    out = np.zeros((n, REACH), bool)
    for x in range(int(before.max()) + 1):
        own = np.flatnonzero((x <= before) & (x > before - count))
        if len(own) < 2:
            continue
        run_a = np.cumsum(common_a < x)[place_a[own]] if x else np.zeros(len(own), np.int64)
        run_b = np.cumsum(common_b < LENGTH - x)[place_b[own]]
        key = run_a * (n + 1) + run_b
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(own), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        hit = own[twice]
        out[hit, before[hit] - x] = True
    return out


def settle(columns: list[np.ndarray], phrases: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(id, tag, start, count) of repeated starts among the phrases of a bucket."""
    shared, whole, id_, start, tag, count, before, known = columns
    count, before = count.astype(np.int64), before.astype(np.int64)
    order = np.lexsort((known, count, whole, shared))
    new_shared = np.concatenate([[True], shared[order][1:] != shared[order][:-1]])
    new = new_shared | np.concatenate([[True], (whole[order][1:] != whole[order][:-1]) | (count[order][1:] != count[order][:-1])])
    head = np.flatnonzero(new)
    times = np.diff(head, append=len(order))
    group = np.cumsum(new) - 1
    twice = (times > 1) | np.maximum.reduceat(known[order], head).astype(bool)
    out = [order[twice[group] & (known[order] == 0)]]
    found = [(id_[out[0]], tag[out[0]], start[out[0]], count[out[0]])]
    family = np.cumsum(new_shared)[head] - 1
    kinds, open_ = np.bincount(family), np.bincount(family, weights=~twice)
    rest = np.flatnonzero((kinds[family] > 1) & (open_[family] > 0))
    lo = 0
    while lo < len(rest):
        hi = min(lo + ORDER_ROWS, len(rest))
        while hi < len(rest) and family[rest[hi]] == family[rest[hi - 1]]:
            hi += 1
        pick = order[head[rest[lo:hi]]]
        flags = repeated_starts([phrases[k] for k in pick], count[pick], before[pick])
        flags[twice[rest[lo:hi]]] = False
        row, at, size = _runs(flags)
        k = pick[row]
        found.append((id_[k], tag[k], start[k] + at, size))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*found))


def settle_strings(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(id, tag, start, count) of strings met twice, or known to be."""
    a, b, id_, start, tag, known = columns
    order = np.lexsort((b, a))
    new = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
    head = np.flatnonzero(new)
    twice = (np.diff(head, append=len(order)) > 1) | np.maximum.reduceat(known[order], head).astype(bool)
    k = order[twice[np.cumsum(new) - 1] & (known[order] == 0)]
    return id_[k], tag[k], start[k], np.ones(len(k), np.int64)


def _packed(id_: np.ndarray, tag: np.ndarray, start: np.ndarray, count: np.ndarray) -> list[pa.Array]:
    """Columns id, tag, and the (start, count) pairs of each as packed int64."""
    order = np.lexsort((tag, id_))
    id_, tag = id_[order], tag[order]
    pairs = np.stack([start[order], count[order]], axis=1).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (id_[1:] != id_[:-1]) | (tag[1:] != tag[:-1])])) if len(id_) else np.zeros(0, np.int64)
    stop = np.append(cut[1:], len(id_))
    return [pa.array(id_[cut].astype(np.int64)), pa.array(tag[cut].astype(np.int64)), pa.array([pairs[a:b].tobytes() for a, b in zip(cut, stop)], pa.binary())]


def _blob(columns: list[np.ndarray], phrases: list[np.ndarray], packer: zstandard.ZstdCompressor) -> bytes:
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns]
    return packer.compress(len(columns[0]).to_bytes(8, "little") + b"".join(planes) + b"".join(p.tobytes() for p in phrases))


def _unblob(blob: bytes, opener: zstandard.ZstdDecompressor, fields: tuple = FIELDS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    raw = np.frombuffer(opener.decompress(blob), np.uint8)
    n, at, columns = int.from_bytes(raw[:8].tobytes(), "little"), 8, []
    for _, kind in fields:
        size = np.dtype(kind).itemsize
        columns.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).reshape(-1))
        at += n * size
    if fields != FIELDS:
        return columns, []
    length = columns[5].astype(np.int64) - 1 + LENGTH
    return columns, np.split(raw[at:], np.cumsum(length)[:-1])


def repeat_marks(docs: DataFrame, max_bits: int = sketch.MAX_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, tag, gone): runs of starts, packed (start, count), of strings that start elsewhere too. `docs` has id, tag, text."""
    spark = docs.sparkSession
    length = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = sketch.bits_for(2 * length // REACH, max_bits)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket_bits = min(max(4 * parts, length // BUCKET_BYTES).bit_length(), 30)

    def hashes_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for data, begin, end, _, _ in stretches(batch.column(0)):
            yield parse(data, begin, end).shared

    planes = spark.sparkContext.broadcast(sketch.merged_planes(docs.select("text"), hashes_of, bits))
    hot = spark.sparkContext.broadcast(_hot_families(docs, planes, bits, hot_rows))
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary()), ("id", pa.int64()), ("tag", pa.int64()), ("gone", pa.binary())])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in W.parts(batches):
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            found, phrases, strings = [], [], []
            for data, begin, end, row, base in stretches(batch.column(2)):
                p = parse(data, begin, end)
                k = np.flatnonzero(sketch.repeated(planes.value, bits, p.shared))
                is_hot = np.isin(p.shared[k], hot.value)
                if is_hot.any():
                    strings.append(_strings(p, k[is_hot], ids[row:], tags[row:], begin - base))
                k = k[~is_hot]
                if len(k):
                    text, first, count = p.text[k], p.first[k], p.count[k]
                    found.append((p.shared[k], p.whole(k), ids[row + text], first - begin[text] + base, tags[row + text], count, p.trigger[k] - first))
                    phrases += [data[a:b] for a, b in zip(first.tolist(), (first + count - 1 + LENGTH).tolist())]
            if found:
                yield from phrases_out([np.concatenate(x) for x in zip(*found)], phrases, packer)
            if strings:
                yield from strings_out([np.concatenate(x) for x in zip(*strings)], packer)

    def blobs_out(kind: int, columns: list[np.ndarray], phrases: list[np.ndarray], packer: zstandard.ZstdCompressor) -> Iterator[pa.RecordBatch]:
        """A blob for each bucket; rows are sorted by their first column, whose leading bits name it."""
        bucket = (columns[0] >> U64(64 - bucket_bits)).astype(np.int32)
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        for lo, hi in zip(cut, np.append(cut[1:], len(bucket))):
            blob = _blob([x[lo:hi] for x in columns], phrases[lo:hi], packer)
            nothing = [pa.nulls(1, f.type) for f in list(schema)[3:]]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[lo : lo + 1]), pa.array([kind], pa.int32()), pa.array([blob], pa.binary()), *nothing], schema=schema)

    def marks_out(id_: np.ndarray, tag: np.ndarray, start: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(id_):
            packed = _packed(id_, tag, start, count)
            spread = (W.mix(packed[0].to_numpy().view(np.uint64) ^ W.mix(packed[1].to_numpy().view(np.uint64))) >> U64(64 - bucket_bits)).astype(np.int32)
            nothing = [pa.nulls(len(spread), f.type) for f in list(schema)[1:3]]
            yield pa.RecordBatch.from_arrays([pa.array(spread), *nothing, *packed], schema=schema)

    def phrases_out(columns: list[np.ndarray], phrases: list[np.ndarray], packer: zstandard.ZstdCompressor) -> Iterator[pa.RecordBatch]:
        shared, whole, id_, start, tag, count, before = columns
        order = np.lexsort((start, id_, count, whole, shared))
        new = np.concatenate([[True], np.any([x[order][1:] != x[order][:-1] for x in (shared, whole, count)], axis=0)])
        head = np.flatnonzero(new)
        times = np.diff(head, append=len(order))
        kept = order[head]
        out = [x[kept] for x in (shared, whole, id_, start, tag)] + [x[kept].astype(np.uint8) for x in (count, before)] + [(times > 1).astype(np.uint8)]
        yield from blobs_out(PHRASES, out, [phrases[k] for k in kept], packer)
        twice = order[(times > 1)[np.cumsum(new) - 1]]
        yield from marks_out(id_[twice], tag[twice], start[twice], count[twice])

    def strings_out(columns: list[np.ndarray], packer: zstandard.ZstdCompressor) -> Iterator[pa.RecordBatch]:
        a, b, id_, start, tag = columns
        order = np.lexsort((b, a))
        new = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
        head = np.flatnonzero(new)
        times = np.diff(head, append=len(order))
        yield from blobs_out(STRINGS, [x[order[head]] for x in columns] + [(times > 1).astype(np.uint8)], [], packer)
        twice = order[(times > 1)[np.cumsum(new) - 1]]
        yield from marks_out(id_[twice], tag[twice], start[twice], np.ones(len(twice), np.int64))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        number, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                columns = [np.concatenate(x) for x in zip(*(h[0] for h in held))]
                marks = settle(columns, [p for h in held for p in h[1]]) if number[1] == PHRASES else settle_strings(columns)
                held.clear()
                if len(marks[0]):
                    yield pa.RecordBatch.from_arrays(_packed(*marks), ["id", "tag", "gone"])

        for batch in batches:
            local = batch.filter(pa.compute.is_null(batch.column(1)))
            if local.num_rows:
                yield pa.RecordBatch.from_arrays([local.column(k) for k in (3, 4, 5)], ["id", "tag", "gone"])
            batch = batch.filter(pa.compute.is_valid(batch.column(1)))
            for k, kind, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (k, kind) != number:
                    yield from done()
                    number = k, kind
                held.append(_unblob(blob, opener, FIELDS if kind == PHRASES else STRING_FIELDS))
        yield from done()

    rows = docs.select("id", "tag", "text").mapInArrow(candidates, BLOBS)
    return rows.repartition("bucket", "kind").sortWithinPartitions("bucket", "kind").mapInArrow(decide, "id long, tag long, gone binary")


def _strings(p: Phrases, k: np.ndarray, ids: np.ndarray, tags: np.ndarray, origin: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a, b, id, start, tag) of each string of the phrases `k`; ids, tags and origins by text."""
    count = p.count[k]
    start = np.repeat(p.first[k] - np.cumsum(count) + count, count) + np.arange(count.sum())
    text = np.repeat(p.text[k], count)
    one, two = (W.span_hashes(p.data, start, start + LENGTH, lane) for lane in (0, 1))
    return one, two.astype(np.uint32), ids[text], start - origin[text], tags[text]


def _hot_families(docs: DataFrame, planes, bits: int, hot_rows: int) -> np.ndarray:
    """Hashes behind the triggers that more than `hot_rows` phrases share, sorted."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.parts(batches):
            met = [np.zeros(0, np.uint64)]
            for data, begin, end, _, _ in stretches(batch.column(0)):
                shared = parse(data, begin, end).shared
                met.append(shared[sketch.repeated(planes.value, bits, shared)])
            shared, n = np.unique(np.concatenate(met), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shared.view(np.int64)), pa.array(n)], ["shared", "n"])

    met = docs.select("text").mapInArrow(counts, "shared long, n long").groupBy("shared").agg(F.sum("n").alias("n"))
    rows = met.where(F.col("n") > hot_rows).select("shared").collect()
    return np.sort(np.array([r.shared for r in rows], np.int64).view(np.uint64))


def drop_repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = sketch.MAX_BITS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each text's bytes without those of strings that start elsewhere too.

    Strings are 200 bytes of one text. A null text is empty; a shorter text has none and stays.
    Repeated rows are texts of their own and so repeat each other; texts that differ under one id are
    told apart. kept is binary, since cutting bytes may split a character. Extra columns are ignored.
    """
    keys = keyed(docs, id_col, text_col)
    marks = repeat_marks(keys, max_bits, hot_rows).groupBy("id", "tag").agg(F.collect_list("gone").alias("gone"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                size, removed, spans, left = [], [], [], []
                for text, gone in zip(part.column(1).cast(pa.large_binary()).to_pylist(), part.column(2).to_pylist()):
                    size.append(len(text))
                    cut = _spans(gone)
                    removed.append(sum(b - a for a, b in cut))
                    spans.append(len(cut))
                    edges = [0, *(x for span in cut for x in span), len(text)]
                    left.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(x, pa.int64()) for x in (size, removed, spans)), pa.array(left, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )
        W.release()

    joined = keys.join(marks, ["id", "tag"], "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _spans(gone: list[bytes] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that begin in the packed runs of starts."""
    if not gone:
        return []
    pairs = np.frombuffer(b"".join(gone), np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    end = np.maximum.accumulate(pairs[:, 0] + pairs[:, 1] - 1 + LENGTH)
    fresh = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] > end[:-1]]))
    return list(zip(pairs[fresh, 0].tolist(), end[np.append(fresh[1:] - 1, len(end) - 1)].tolist()))


def op2_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_bytes(shipped(spark).read.parquet(f"{sf_dir}/documents.parquet"))
    return written_in_small_batches(out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))
