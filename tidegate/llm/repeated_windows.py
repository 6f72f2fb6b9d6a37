"""Substring dedup over windows of words, with a count-min prefilter.

First pass: every task sketches the hashes of its windows, and the sketches merge. Second pass:
windows that the merged sketch reports as repeated, and only those, are grouped exactly, by a 96-bit
hash of their words. The sketch overestimates, so no repeated window is lost; its size is bounded,
so that past a few hundred million windows it lets more unique ones through, which costs shuffle and
changes no result.

Candidates are shuffled as compressed blobs, by the leading bits of their hash; a reducer holds one
such bucket, a few hundred thousand windows, at a time. A task passes on only the first of equal windows in a batch; the others are known there to repeat.
So a passage that stands in a third of all documents comes to a shuffle once per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.llm import sketch, words as W
from tidegate.llm.scratch import shipped, written_in_small_batches

WINDOW_WORDS = 20
U64 = np.uint64
NO_ID = -(1 << 63)
#: Candidates travel in blobs: those of one batch whose hashes share their leading bits.
BLOBS = "bucket int, owners int, blob binary"
BUCKET_WINDOWS = 1 << 18
OWNER_BYTES = 1 << 25
FIELDS = (("a", np.uint64), ("b", np.uint32), ("id", np.int64), ("start", np.int32), ("tag", np.int64))
#: Marks travel in blobs as well, by the leading bits of a hash of their id and tag (`owners`).
MARK_FIELDS = FIELDS[2:]
MARKS_AT_ONCE = 1 << 20


def _windows(texts: W.Texts, size: int, lane: int) -> tuple[W.Words, np.ndarray, np.ndarray]:
    words = W.find_words(texts, W.NON_SPACE)
    at, value = W.window_hashes(words, W.span_hashes(texts.data, words.start, words.end, lane), size, lane)
    return words, at, value


def _packed(ids: np.ndarray, tags: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Starts of each (id, tag) together."""
    order = np.lexsort((tags, ids))
    ids, tags, starts = ids[order], tags[order], starts[order].astype(np.int32)
    cut = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])) if len(ids) else np.zeros(0, np.int64)
    stop = np.append(cut[1:], len(ids))
    return ids[cut], tags[cut], [starts[a:b].tobytes() for a, b in zip(cut, stop)]


def _blob(columns: list[np.ndarray], packer: zstandard.ZstdCompressor) -> bytes:
    """Columns of one length, byte plane by byte plane: planes of small numbers are zeros."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns]
    return packer.compress(b"".join(planes))


def _unblob(blob: bytes, opener: zstandard.ZstdDecompressor, fields: tuple = FIELDS) -> list[np.ndarray]:
    raw = np.frombuffer(opener.decompress(blob), np.uint8)
    n = len(raw) // sum(np.dtype(t).itemsize for _, t in fields)
    out, at = [], 0
    for _, kind in fields:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).reshape(-1))
        at += n * size
    return out


def _firsts(a, b, id_, start, tag) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns sorted by hash and place, and which rows come later than the first of their hash."""
    order = np.lexsort((start, id_, b, a))
    columns = [x[order] for x in (a, b, id_, start, tag)]
    a, b, id_, start, _ = columns
    head = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    of = np.flatnonzero(head)[np.cumsum(head) - 1]
    return columns, (id_ != id_[of]) | (start != start[of])


def _blobs(bucket: np.ndarray, columns: list[np.ndarray], packer: zstandard.ZstdCompressor) -> tuple[np.ndarray, list[bytes]]:
    """A blob for each bucket that has rows."""
    if (np.diff(bucket) < 0).any():
        order = np.argsort(bucket, kind="stable")
        bucket, columns = bucket[order], [x[order] for x in columns]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    return bucket[cut], [_blob([x[lo:hi] for x in columns], packer) for lo, hi in zip(cut, np.append(cut[1:], len(bucket)))]


def window_marks(docs: DataFrame, size: int, max_bits: int = sketch.MAX_BITS) -> DataFrame:
    """(id, tag, starts): starts, packed int32, of windows that also start earlier, a row for each text that has any. `docs` has id, tag, text."""
    spark = docs.sparkSession
    length = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = sketch.bits_for(length // 6, max_bits)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket_bits = min(max(4 * parts, length // 6 // BUCKET_WINDOWS).bit_length(), 30)
    owner_bits = min(max(4 * parts, length // OWNER_BYTES).bit_length(), 30)

    def hashes_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for texts in W.text_groups(batch.column(0)):
            yield _windows(texts, size, 0)[2]

    planes = spark.sparkContext.broadcast(sketch.merged_planes(docs.select("text"), hashes_of, bits))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.parts(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tags = batch.column(1).to_numpy(zero_copy_only=False)
            found = []
            for texts in W.text_groups(batch.column(2)):
                words, at, value = _windows(texts, size, 0)
                twice = np.flatnonzero(sketch.repeated(planes.value, bits, value))
                if len(twice):
                    at, row = at[twice], words.text[at[twice]]
                    second = _windows(texts, size, 1)[2][twice]
                    found.append((value[twice], second.astype(np.uint32), texts.first + row, at - words.first[row]))
            if not found:
                continue
            a, b, row, start = (np.concatenate(x) for x in zip(*found))
            columns, later = _firsts(a, b, ids[row], start.astype(np.int32), tags[row])
            kept = [x[~later] for x in columns]
            bucket, blobs = _blobs((kept[0] >> U64(64 - bucket_bits)).astype(np.int32), kept, zstandard.ZstdCompressor(level=1))
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.nulls(len(bucket), pa.int32()), pa.array(blobs, pa.binary())], schema=schema)
            yield from marks_of([x[later] for x in columns[2:]])

    schema = pa.schema([("bucket", pa.int32()), ("owners", pa.int32()), ("blob", pa.binary())])

    def marks_of(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(columns[0]):
            owners = (W.mix(columns[0].view(np.uint64) ^ W.mix(columns[2].view(np.uint64))) >> U64(64 - owner_bits)).astype(np.int32)
            owners, blobs = _blobs(owners, columns, zstandard.ZstdCompressor(level=1))
            yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(owners), pa.array(blobs, pa.binary())], schema=schema)

    def later_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        number, held, marks = None, [], []

        def settle() -> None:
            if held:
                columns, later = _firsts(*(np.concatenate(x) for x in zip(*held)))
                marks.append([x[later] for x in columns[2:]])
                held.clear()

        def out() -> Iterator[pa.RecordBatch]:
            if marks:
                yield from marks_of([np.concatenate(x) for x in zip(*marks)])
                marks.clear()

        for batch in batches:
            yield batch.filter(pa.compute.is_valid(batch.column(1)))
            batch = batch.filter(pa.compute.is_null(batch.column(1)))
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != number:
                    settle()
                    number = k
                    if sum(len(m[0]) for m in marks) >= MARKS_AT_ONCE:
                        yield from out()
                held.append(_unblob(blob, opener))
        settle()
        yield from out()

    def by_owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        number, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                id_, start, tag = (np.concatenate(x) for x in zip(*held))
                id_, tag, starts = _packed(id_, tag, start)
                held.clear()
                yield pa.RecordBatch.from_arrays([pa.array(id_), pa.array(tag), pa.array(starts, pa.binary())], ["id", "tag", "starts"])

        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != number:
                    yield from out()
                    number = k
                held.append(_unblob(blob, opener, MARK_FIELDS))
        yield from out()

    rows = docs.select("id", "tag", "text").mapInArrow(candidates, BLOBS)
    marks = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(later_ones, BLOBS)
    owned = marks.select("owners", "blob").repartition("owners").sortWithinPartitions("owners")
    return owned.mapInArrow(by_owner, "id long, tag long, starts binary")


def key_columns(id_col: str, text_col: str) -> dict[str, Column]:
    """id and tag, which name a row by its id and 64 bits of its text.

    A row without an id gets one from 40 more bits of its text, below all others: ids of the 2**40
    smallest longs are kept for these. So such rows come first, and differ as documents by their text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(F.lit(1), text), 24)
    return {"id": F.coalesce(F.col(id_col).cast("long"), own), "tag": F.xxhash64(text)}


def tagged(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """`docs` and its keys, under names that no column of it has."""
    taken, names = {c.lower() for c in docs.columns}, []
    for name in ("_id", "_tag"):
        while name in taken:
            name = f"_{name}"
        names.append(name)
    return docs.select("*", *(c.alias(n) for n, c in zip(names, key_columns(id_col, text_col).values()))), names


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """id and tag of `key_columns`, doc_id and text, and the columns named."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = (c.alias(name) for name, c in key_columns(id_col, text_col).items())
    return docs.select(*keys, F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *more)


def drop_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_WORDS, max_bits: int = sketch.MAX_BITS
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each row's words without those of windows that start earlier.

    Earlier means in a row of a smaller id, or of the same id at a smaller word; null ids come
    before all others, in order of a hash of their texts. Rows repeated under one id are one document
    and lose the same words; a text of its own under a repeated id loses its own. A null text is empty; fewer words than `size` make
    no window. kept is the remaining words joined by one space. Extra columns are ignored.
    """
    keys = keyed(docs, id_col, text_col)
    marks = written_in_small_batches(window_marks(keys, size, max_bits))
    bits, planes = _id_sketch(marks)

    def kept(ids: pa.Array, texts: pa.Array, starts: list) -> pa.RecordBatch:
        count, removed, left = [], [], []
        for text, gone in zip(texts.cast(pa.large_binary()).to_pylist(), starts):
            words = text.split()
            count.append(len(words))
            if gone:
                cover = np.zeros(len(words) + 1, np.int64)
                at = np.unique(np.frombuffer(gone, np.int32))
                cover[at] += 1
                np.subtract.at(cover, at + size, 1)
                words = [w for w, out in zip(words, (np.cumsum(cover) > 0).tolist()) if not out]
            removed.append(count[-1] - len(words))
            left.append(b" ".join(words))
        columns = [ids, pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(left, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    def split(batches: Iterator[pa.RecordBatch], marked: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = W.mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            yield batch.filter(pa.array(sketch.repeated(planes.value, bits, hashes) == marked))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.parts(split(batches, False), 256):
            yield kept(batch.column(2), batch.column(3), [None] * batch.num_rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.parts(batches, 256):
            yield kept(batch.column(0), batch.column(1), batch.column(2).to_pylist())

    keys = keys.select("id", "tag", "doc_id", "text")
    schema = "doc_id long, n_words long, n_removed long, kept string"
    touched = keys.mapInArrow(lambda batches: split(batches, True), keys.schema)
    joined = touched.join(marks, ["id", "tag"], "left").select("doc_id", "text", "starts")
    return keys.mapInArrow(whole, schema).union(joined.mapInArrow(cut, schema))


def _id_sketch(marks: DataFrame):
    """A bounded sketch of the ids that have marks, on all executors: texts without any need no shuffle."""

    def hashes_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield W.mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))

    bits = sketch.bits_for(4 * marks.count())
    planes = sketch.merged_planes(marks.select("id"), hashes_of, bits, met=True)
    return bits, marks.sparkSession.sparkContext.broadcast(planes)


def op5_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_windows(shipped(spark).read.parquet(f"{sf_dir}/documents.parquet"))
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return written_in_small_batches(out.select("doc_id", "n_words", "n_removed", digest))


ORACLE_SQL = r"""
with texts as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents
), places as (
  select doc_id, words, unnest(range(1, len(words) - 18)) as start from texts where len(words) >= 20
), windows as (
  select doc_id, start, array_to_string(words[start:start + 19], ' ') as window_text from places
), ranked as (
  select doc_id, start, row_number() over (partition by window_text order by doc_id, start) as place from windows
), marks as (
  select distinct doc_id, unnest(range(start, start + 20)) as word from ranked where place > 1
), gone as (
  select doc_id, list(word) as words from marks group by doc_id
)
select t.doc_id, cast(len(t.words) as bigint) as n_words, cast(coalesce(len(g.words), 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(list_filter(t.words, lambda w, i: not list_contains(coalesce(g.words, []), i)), ' '), '')) as kept_sha256
from texts t left join gone g using (doc_id)
"""
