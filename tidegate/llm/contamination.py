"""Benchmark decontamination as a prefix-filtered set join.

A window is ten consecutive words of an item (all words of a shorter one); its tokens are its 3-word
shingles. A document holds the window only if it holds all tokens, so the necessary prefix of the
tokens, ordered by how rare they are in the whole corpus, is the single rarest one. Documents meet
windows on that token alone. Its place in the window bounds where the window must begin and end
(positional and length bounds), and the words there are compared one by one.

A bounded bit sketch of the tokens lets a task pass over what cannot match. The benchmark itself may
be of any size: its windows, tokens and counts stay in tables, and the joins are left to Spark, which
broadcasts by its own size checks and splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.llm import sketch, words as W
from tidegate.llm.repeated_windows import keyed, tagged
from tidegate.llm.scratch import shipped, written

WINDOW_WORDS = 10
TOKEN_WORDS = 3
U64 = np.uint64


def _lowered(column: pa.Array) -> Iterator[tuple[W.Texts, W.Words, np.ndarray]]:
    for texts in W.text_groups(column):
        texts = W.Texts(texts.first, W.LOWER[texts.data], texts.begin, texts.end)
        words = W.find_words(texts, W.ALNUM)
        yield texts, words, W.span_hashes(texts.data, words.start, words.end)


def _tokens(words: W.Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    at, value = W.window_hashes(words, hashes, size)
    return at, W.mix(value + U64(size))


def _joined(texts: W.Texts, words: W.Words, lo: int, hi: int) -> str:
    return b" ".join(texts.data[words.start[i] : words.end[i]].tobytes() for i in range(lo, hi)).decode("utf-8", "replace")


def item_windows(items: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, content, n, tokens): windows of each item; tokens are (token, place)."""
    schema = "item_id string, content string, n int, tokens array<struct<token: long, place: int>>"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("token", pa.int64()), ("place", pa.int32())]))
        for batch in batches:
            for texts, words, hashes in _lowered(batch.column(1)):
                found = {k: dict(zip(*(x.tolist() for x in _tokens(words, hashes, k)))) for k in range(1, TOKEN_WORDS + 1)}
                out = []
                for row, count in enumerate(words.count.tolist()):
                    n, first = min(size, count), int(words.first[row])
                    k = min(TOKEN_WORDS, n)
                    for lo in range(first, first + count - n + 1 if n else first):
                        tokens = [{"token": U64(found[k][lo + p]).view(np.int64).item(), "place": p} for p in range(n - k + 1)]
                        out.append((batch.column(0)[texts.first + row].as_py(), _joined(texts, words, lo, lo + n), n, tokens))
                    if len(out) >= 4096 or row == len(words.count) - 1:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32(), kind))],
                            ["item_id", "content", "n", "tokens"],
                        )
                        out = []

    kept = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return kept.mapInArrow(rows, schema)


def _token_hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def find_windows(
    docs: DataFrame, items: DataFrame, size: int, id_col: str, text_col: str, item_id_col: str, item_text_col: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (id, tag, doc_id, n_words) of `docs`; hits (id, tag, begin, n, content) of windows in them; the windows."""
    spark = docs.sparkSession
    windows = written(item_windows(items, size, item_id_col, item_text_col))
    parts = windows.select("content", "n", F.explode("tokens").alias("t")).select("content", "n", "t.*").distinct()
    tokens = written(parts)
    sizes = sorted({min(TOKEN_WORDS, r.n) for r in tokens.select(F.least("n", F.lit(TOKEN_WORDS)).alias("n")).distinct().collect()})
    distinct = tokens.select("token").distinct()
    keys = keyed(docs, id_col, text_col)

    def planes_of(table: DataFrame) -> tuple:
        bits = sketch.bits_for(4 * table.count())
        return bits, spark.sparkContext.broadcast(sketch.merged_planes(table, _token_hashes, bits, met=True))

    bits, planes = planes_of(distinct)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = [np.zeros(0, np.uint64)]
            for _, words, hashes in _lowered(batch.column(0)):
                for k in sizes:
                    value = _tokens(words, hashes, k)[1]
                    met.append(value[sketch.repeated(planes.value, bits, value)])
            token, n = np.unique(np.concatenate(met), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["token", "n_met"])

    rarity = keys.select("text").mapInArrow(counts, "token long, n_met long").groupBy("token").agg(F.sum("n_met").alias("n_met"))
    prefix = written(
        tokens.join(rarity, "token", "left")
        .groupBy("content", "n")
        .agg(F.min(F.struct(F.coalesce("n_met", F.lit(0)).alias("n_met"), "token", "place")).alias("rarest"))
        .select("content", "n", "rarest.token", "rarest.place")
    )
    rare_bits, rare = planes_of(prefix.select("token").distinct())
    nearby = pa.list_(pa.struct([("token", pa.int64()), ("at", pa.int32()), ("base", pa.int32()), ("near", pa.string())]))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, words, hashes in _lowered(batch.column(3)):
                n = len(words.count)
                met: list[list] = [[] for _ in range(n)]
                for k in sizes:
                    at, value = _tokens(words, hashes, k)
                    for i in np.flatnonzero(sketch.repeated(rare.value, rare_bits, value)).tolist():
                        row = int(words.text[at[i]])
                        first, here = int(words.first[row]), int(at[i])
                        lo, hi = max(first, here - size), min(first + int(words.count[row]), here + size)
                        met[row].append({"token": value[i : i + 1].view(np.int64).item(), "at": here - first, "base": lo - first, "near": _joined(texts, words, lo, hi)})
                part = batch.slice(texts.first, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(words.count, pa.int64()), pa.array(met, nearby)],
                    ["id", "tag", "doc_id", "n_words", "met"],
                )

    schema = "id long, tag long, doc_id long, n_words long, met array<struct<token: long, at: int, base: int, near: string>>"
    scanned = written(keys.select("id", "tag", "doc_id", "text").mapInArrow(candidates, schema))
    met = scanned.where(F.size("met") > 0).select("id", "tag", "n_words", F.explode("met").alias("m")).select("id", "tag", "n_words", "m.*")
    begin: Column = F.col("at") - F.col("place")
    hits = (
        met.join(prefix, "token")
        .where((begin >= 0) & (begin + F.col("n") <= F.col("n_words")))
        .where(F.array_join(F.slice(F.split("near", " "), begin - F.col("base") + 1, F.col("n")), " ") == F.col("content"))
        .select("id", "tag", begin.alias("begin"), "n", "content")
    )
    return scanned.drop("met"), hits, windows


def mark_contaminated(
    docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, items) of each row of `docs`: words within a window, ids of items found.

    Null and empty texts have no words, and an item without words no window. Rows repeated under one
    id get the same answer; texts that differ under one id are told apart. Items that share an id
    count once; an item without an id marks words and is not listed. Extra columns are ignored.
    """
    scanned, hits, windows = find_windows(docs, items, size, id_col, text_col, item_id_col, item_text_col)
    covered = hits.select("id", "tag", F.explode(F.sequence("begin", F.col("begin") + F.col("n") - 1)).alias("word")).distinct()
    n_hit = covered.groupBy("id", "tag").agg(F.count("*").alias("n_hit"))
    owners = windows.select("content", "item_id").distinct()
    items_of = hits.select("id", "tag", "content").distinct().join(owners, "content").groupBy("id", "tag").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return (
        scanned.join(n_hit, ["id", "tag"], "left")
        .join(items_of, ["id", "tag"], "left")
        .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """`docs` without the rows in which a window of an item occurs; all columns as they are."""
    hits = find_windows(docs, items, size, id_col, text_col, item_id_col, item_text_col)[1]
    rows, (id_, tag) = tagged(docs, id_col, text_col)
    gone = hits.select(F.col("id").alias(id_), F.col("tag").alias(tag)).distinct()
    return rows.join(gone, [id_, tag], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def op8_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = shipped(spark).read
    marked = mark_contaminated(read.parquet(f"{sf_dir}/documents.parquet"), read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
with texts as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as words from documents
), items as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as words from benchmark
), places as (
  select item_id, words, least(10, len(words)) as n, unnest(range(1, len(words) - least(10, len(words)) + 2)) as start from items where len(words) > 0
), windows as (
  select distinct item_id, n, array_to_string(words[start:start + n - 1], ' ') as content from places
), sizes as (
  select distinct n from windows
), spots as (
  select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as start from texts, sizes where len(words) >= n
), hits as (
  select s.doc_id, s.start, s.n, w.item_id from (select doc_id, start, n, array_to_string(words[start:start + n - 1], ' ') as content from spots) s
  join windows w on s.n = w.n and s.content = w.content
), covered as (
  select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(start, start + n)) as word from hits) group by doc_id
), found as (
  select doc_id, list_sort(list(distinct cast(item_id as varchar))) as items from hits group by doc_id
)
select t.doc_id, cast(len(t.words) as bigint) as n_words, cast(coalesce(c.n_hit, 0) as bigint) as n_hit,
  cast(coalesce(len(f.items), 0) as bigint) as n_items, sha256(coalesce(array_to_string(f.items, ','), '')) as items_sha256,
  coalesce(c.n_hit, 0) > 0 as contaminated
from texts t left join covered c using (doc_id) left join found f using (doc_id)
"""
