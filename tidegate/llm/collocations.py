"""Collocations of two to four words, grown best first under admissible score bounds.

A phrase's score is at most what its prefix allows: with f the count of a prefix p and l the count of
p's own first words, no phrase that begins with p scores above 2,000,000 f / (l + f), since it cannot
occur more often than p, and its rest not less often than itself. Words and pairs are counted for
all; longer phrases only below prefixes whose bound reaches a threshold, which starts at a high score
of pairs and sinks until each language has its full number of phrases at or above it that no longer
phrase swallows. Then everything at the threshold or above is known, ties included, and the rest of the
frontier stays unexpanded.

A pass over the texts counts phrases whose parts pass bounded bitmaps: bitmaps only let too much
through, and every occurrence of a phrase fares alike, so counts are whole. Counts combine in the
tasks, travel as compressed blobs by hash and are summed there; a phrase that stands in a third of all
texts comes to the shuffle once per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidegate.llm import sketch, words as W
from tidegate.llm.repeated_windows import _blobs, _unblob
from tidegate.llm.scratch import shipped, written, written_in_small_batches

TOP = 2000
LEAST_COUNT = 30
SWALLOWED_PERCENT = 80
SCALE = 2_000_000
#: The first threshold is the score of so many times TOP pairs of a language, then of four times as many, ...
FIRST_PAIRS = 2
U64 = np.uint64
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False
#: Rows that a task gathers before it combines them, distinct rows before it passes them on, rows of a bucket.
RAW_ROWS = 1 << 20
HELD_ROWS = 1 << 20
HELD_WORDS = 150_000
BUCKET_ROWS = 1 << 18


def stretches(texts: W.Texts, most: int = W.GROUP_BYTES) -> Iterator[W.Texts]:
    """A group as it is, or one long text cut behind piece ends, which no phrase crosses."""
    if len(texts.begin) > 1 or len(texts.data) <= most:
        yield texts
        return
    ends = np.flatnonzero(_BREAK[texts.data]) + 1
    lo = 0
    while lo < len(texts.data):
        k = np.searchsorted(ends, lo + most, side="right") - 1
        if k < 0 or ends[k] <= lo:
            k += 1
        hi = int(ends[k]) if k < len(ends) and len(texts.data) - lo > most else len(texts.data)
        yield W.Texts(texts.first, texts.data[lo:hi], np.array([0]), np.array([hi - lo]))
        lo = hi


@dataclass
class Spoken:
    """Words of a group: bytes, bounds, text, hash (with the language), and the run of words of one piece each is in."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    word: np.ndarray
    run: np.ndarray


def spoken(texts: W.Texts, langs: np.ndarray) -> Spoken:
    """`langs` has a hash of the language of each row of the batch."""
    lower = W.LOWER[texts.data]
    words = W.find_words(W.Texts(texts.first, lower, texts.begin, texts.end), _WORD)
    if not len(words.start):
        none = np.zeros(0, np.int64)
        return Spoken(lower, none, none, none, none.view(np.uint64), none)
    breaks = np.cumsum(_BREAK[lower], dtype=np.int32)
    apart = (words.text[1:] != words.text[:-1]) | (breaks[words.start[1:]] != breaks[words.end[:-1] - 1])
    text = words.text + texts.first
    word = W.mix(W.span_hashes(lower, words.start, words.end) + W.mix(langs)[text])
    return Spoken(lower, words.start, words.end, text, word, np.concatenate([[0], np.cumsum(apart)]))


def chained(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase and one more word."""
    return W.mix(first * U64(0x9FB21C651E98DF25) + word)


@dataclass
class Members:
    """A bounded bitmap of phrases: says yes to all of them, and to few others."""

    planes: np.ndarray
    bits: int

    def has(self, hashes: np.ndarray) -> np.ndarray:
        return sketch.repeated(self.planes, self.bits, hashes)


def members(phrases: DataFrame, size: int) -> Members:
    columns = [f"w{k}" for k in range(1, size + 1)]

    def hashes_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        words = [c.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in batch.columns]
        value = words[0]
        for word in words[1:]:
            value = chained(value, word)
        yield value

    bits = sketch.bits_for(4 * phrases.count())
    return Members(sketch.merged_planes(phrases.select(*columns), hashes_of, bits, met=True), bits)


def prepared(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.xxhash64(lang).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Spoken, pa.RecordBatch]]:
    for batch in W.parts(batches):
        keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for group in W.text_groups(batch.column(2)):
            for texts in stretches(group):
                yield spoken(texts, keys), batch


def word_counts(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, w1, word, f) of words with `least` occurrences or more, and (lang, n) of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        total: dict[str, int] = {}

        def rows(found: list) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [()] * 4
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["lang", "w1", "word", "f"])

        def out() -> pa.RecordBatch:
            signed = np.array(list(held), np.uint64).view(np.int64).tolist()
            made = rows([(lang, w, word, f) for w, (f, word, lang) in zip(signed, held.values())])
            held.clear()
            return made

        for group, batch in _groups(batches):
            langs = batch.column(0).to_pylist()
            for k, n in zip(*(x.tolist() for x in np.unique(group.text, return_counts=True))):
                total[langs[k]] = total.get(langs[k], 0) + n
            word, first, times = np.unique(group.word, return_index=True, return_counts=True)
            raw = group.data.tobytes()
            for w, at, n in zip(word.tolist(), first.tolist(), times.tolist()):
                if w in held:
                    held[w][0] += n
                else:
                    held[w] = [n, raw[group.start[at] : group.end[at]], langs[group.text[at]]]
            if len(held) > HELD_WORDS:
                yield out()
        yield out()
        yield rows([(lang, None, None, n) for lang, n in total.items()])

    parts = texts.mapInArrow(count, "lang string, w1 long, word binary, f long")
    whole = parts.groupBy("lang", "w1", "word").agg(F.sum("f").alias("f")).where(F.col("w1").isNull() | (F.col("f") >= least))
    whole = written_in_small_batches(whole.select("lang", "w1", F.col("word").cast("string").alias("word"), "f"))
    words = whole.where("w1 is not null")
    if words.groupBy("w1").count().where("count > 1").limit(1).count():
        raise ValueError("two frequent words share a 64-bit hash")
    return words, whole.where("w1 is null").select("lang", F.col("f").alias("n"))


def _combined(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Word columns and a count, with equal phrases summed."""
    *words, n = columns
    order = np.lexsort(words[::-1])
    words, n = [w[order] for w in words], n[order]
    head = np.zeros(len(order), bool)
    head[:1] = True
    for w in words:
        head[1:] |= w[1:] != w[:-1]
    at = np.flatnonzero(head)
    return [*(w[at] for w in words), np.add.reduceat(n, at) if len(at) else n]


Eligible = Callable[[Spoken], np.ndarray]


def phrase_counts(texts: DataFrame, size: int, eligible: Eligible, n_words: int, least: int) -> DataFrame:
    """(w1, ..., f) of the phrases of `size` words that `eligible` picks, with `least` occurrences or more.

    `eligible` gives, for a group of words, the first words of the phrases that count.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(max(4 * parts, n_words // BUCKET_ROWS).bit_length(), 30)
    names = [f"w{k}" for k in range(1, size + 1)]
    fields = (*((n, np.uint64) for n in names), ("f", np.int64))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        raw, held = [], []

        def combine() -> None:
            if raw:
                columns = [np.concatenate(x) for x in zip(*raw)]
                held.append(_combined([*columns, np.ones(len(columns[0]), np.int64)]))
                raw.clear()

        def out() -> Iterator[pa.RecordBatch]:
            combine()
            if held:
                columns = _combined([np.concatenate(x) for x in zip(*held)])
                held.clear()
                value = columns[0]
                for word in columns[1:-1]:
                    value = chained(value, word)
                bucket, blobs = _blobs((value >> U64(64 - bits)).astype(np.int32), columns, packer)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(blobs, pa.binary())], ["bucket", "blob"])

        for group, _ in _groups(batches):
            at = eligible(group)
            if len(at):
                raw.append([group.word[at + k] for k in range(size)])
                if sum(len(x[0]) for x in raw) >= RAW_ROWS:
                    combine()
                    if sum(len(x[0]) for x in held) >= HELD_ROWS:
                        yield from out()
        yield from out()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        number, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                columns = _combined([np.concatenate(x) for x in zip(*held)])
                held.clear()
                enough = columns[-1] >= least
                yield pa.RecordBatch.from_arrays([pa.array(c[enough].view(np.int64)) for c in columns], [*names, "f"])

        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != number:
                    yield from out()
                    number = k
                held.append(_unblob(blob, opener, fields))
        yield from out()
        W.release()

    blobs = texts.mapInArrow(pick, "bucket int, blob binary").repartition("bucket").sortWithinPartitions("bucket")
    return written_in_small_batches(blobs.mapInArrow(add, ", ".join(f"{n} long" for n in [*names, "f"])), 1000)


def _within(group: Spoken, size: int) -> np.ndarray:
    """Whether `size` words of one piece begin at each word but the last size - 1."""
    n = max(len(group.run) - size + 1, 0)
    return group.run[:n] == group.run[len(group.run) - n :]


def _pairs(group: Spoken) -> np.ndarray:
    return chained(group.word[:-1], group.word[1:]) if len(group.word) else group.word


def pairs_of(frequent: Members) -> Eligible:
    def pick(group: Spoken) -> np.ndarray:
        known = frequent.has(group.word)
        return np.flatnonzero(_within(group, 2) & known[:-1] & known[1:])

    return pick


def triples_of(pairs: Members, grow: Members, high: Members) -> Eligible:
    """Triples of two frequent pairs: below an expanded pair, or ending in a pair of high score, which they may swallow."""

    def pick(group: Spoken) -> np.ndarray:
        value = _pairs(group)
        at = np.flatnonzero(_within(group, 3))
        at = at[grow.has(value[at]) | high.has(value[at + 1])]
        return at[pairs.has(value[at]) & pairs.has(value[at + 1])]

    return pick


def chosen_triples(wanted: Members) -> Eligible:
    def pick(group: Spoken) -> np.ndarray:
        at = np.flatnonzero(_within(group, 3))
        return at[wanted.has(chained(_pairs(group)[at], group.word[at + 2]))]

    return pick


def fours_of(pairs: Members, grow: Members, high: Members) -> Eligible:
    def pick(group: Spoken) -> np.ndarray:
        value = _pairs(group)
        at = np.flatnonzero(_within(group, 4))
        triple = lambda k: chained(value[k], group.word[k + 2])
        at = at[grow.has(triple(at)) | high.has(triple(at + 1))]
        return at[pairs.has(value[at]) & pairs.has(value[at + 1]) & pairs.has(value[at + 2])]

    return pick


def _score(a: str, l: str, r: str) -> str:
    big = "cast({} as decimal(20,0))"
    return f"({big.format(a)} * {SCALE}) div ({big.format(l)} + {big.format(r)})"


def _lowest(cuts: int) -> list[Column]:
    """l, r and score of the lowest-scoring cut among (l1, r1), ..., the first of equals."""
    each = F.array(*(F.struct(F.expr(_score("a", f"l{k}", f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, cuts + 1)))
    return [F.array_min(each).getField(n).alias(n) for n in ("l", "r", "score")]


def _renamed(phrases: DataFrame, shift: int, size: int, **facts: str) -> DataFrame:
    """Word columns moved up by `shift`, and facts under other names."""
    words = (F.col(f"w{k}").alias(f"w{k + shift}") for k in range(1, size + 1))
    return phrases.select(*words, *(F.expr(v).alias(k) for k, v in facts.items()))


def _swallowed(phrases: DataFrame, longer: DataFrame, size: int) -> DataFrame:
    """`phrases` without those that a candidate one word longer holds nearly as often. A still longer one holds that one."""
    on = [f"w{k}" for k in range(1, size + 1)]
    inner = longer.select(*on, "f").unionByName(longer.select(*(F.col(f"w{k + 1}").alias(f"w{k}") for k in range(1, size + 1)), "f"))
    most = inner.groupBy(*on).agg(F.max("f").alias("most"))
    kept = F.coalesce(F.expr(f"cast(most as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * {SWALLOWED_PERCENT}"), F.lit(True))
    return phrases.join(most, on, "left").where(kept).drop("most")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP, least: int = LEAST_COUNT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases.

    A-Z are lower-cased; texts are cut into pieces at . , ; : ! ? and line ends, and pieces into words
    at blanks and tabs. A null text has no word, a null language is `und`. Repeated rows count as often
    as they stand; ties in score and count are in order of the phrase's bytes. Extra columns are ignored,
    whatever their names. An empty table, or one without a phrase often enough, gives an empty table.
    """
    texts = prepared(docs, text_col, lang_col)
    words, totals = word_counts(texts, least)
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    frequent = share(members(words, 1))
    f2 = phrase_counts(texts, 2, lambda group: pairs_of(frequent.value)(group), n_words, least)
    left = words.select("lang", "w1", F.col("f").alias("l"))
    right = words.select(F.col("w1").alias("w2"), F.col("f").alias("r"))
    pairs = f2.withColumnRenamed("f", "a").join(left, "w1").join(right, "w2")
    pairs = written(pairs.withColumn("score", F.expr(_score("a", "l", "r"))).withColumn("bound", F.expr(_score("a", "l", "a"))))
    known = share(members(pairs, 2))

    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc()))
    active = written(totals.select("lang", F.lit(SCALE).cast("long").alias("before")))
    f3, f4, done, tried = None, None, [], FIRST_PAIRS * top
    while True:
        enough = pairs.select("lang", "score").withColumn("place", place).where(f"place = {tried}").select("lang", F.col("score").alias("least"))
        levels = written(active.join(enough, "lang", "left").select("lang", "before", F.coalesce("least", F.lit(0).cast("long")).alias("least")))
        at_level = pairs.join(levels, "lang")
        # Expand the prefixes of the frontier whose bound has come into reach.
        grow = share(members(at_level.where("bound >= least and bound < before"), 2))
        high = share(members(at_level.where("score >= least and score < before"), 2))
        f3 = _also(f3, phrase_counts(texts, 3, lambda group: triples_of(known.value, grow.value, high.value)(group), n_words, least), 3)
        triples = written(_triples(f3, pairs).join(levels, "lang"))
        grow3 = share(members(triples.where("bound >= least"), 3))
        high3 = share(members(triples.where("score >= least"), 3))
        f4 = _also(f4, phrase_counts(texts, 4, lambda group: fours_of(known.value, grow3.value, high3.value)(group), n_words, least), 4)
        fours = written(_fours(f4, triples.where("bound >= least"), pairs))
        # What is missing for a score: counts of last three words, where all else allows the phrase.
        lacking = _with_rest(fours, f3, "a").where("score >= least and rest is null").select(*(F.col(f"w{k + 1}").alias(f"w{k}") for k in (1, 2, 3)))
        if lacking.limit(1).count():
            wanted = share(members(lacking.distinct(), 3))
            f3 = _also(f3, phrase_counts(texts, 3, lambda group: chosen_triples(wanted.value)(group), n_words, least), 3)
        scored = _with_rest(fours, f3, "rest").where("rest is not null")
        none = F.lit(None).cast("long")
        facts = ["lang", "w1", "w2", "w3", "w4", "a", "l", "r", "score"]
        twos = _swallowed(at_level.where("score >= least"), f3, 2).withColumn("w3", none).withColumn("w4", none)
        threes = _swallowed(triples.where("score >= least"), f4, 3).withColumn("w4", none)
        found = twos.select(*facts).unionByName(threes.select(*facts)).unionByName(scored.where("score >= least").select(*facts))
        found = written(found)
        # A language is settled when it has all it needs at its threshold, or nothing is below that.
        full = found.groupBy("lang").agg(F.count("*").alias("found"))
        state = written(levels.join(full, "lang", "left").select("lang", "least", ((F.col("least") == 0) | F.coalesce(F.col("found") >= top, F.lit(False))).alias("settled")))
        done.append(found.join(state.where("settled").select("lang"), "lang"))
        active = written(state.where("not settled").select("lang", F.col("least").alias("before")))
        for shared in (grow, high, grow3, high3):
            shared.unpersist()
        if not active.limit(1).count():
            break
        tried *= 4
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return _ranked(every, words, totals, top)


def _also(before: DataFrame | None, new: DataFrame, size: int) -> DataFrame:
    """Counts of two passes; a phrase that both counted has the same in both."""
    return new if before is None else written(before.unionByName(new).distinct())


def _triples(f3: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, w1..w3, a, l1, l2, l, r, score, bound)."""
    head = _renamed(pairs, 0, 2, lang="lang", l1="l", l2="a")
    tail = _renamed(pairs, 1, 2, r1="a", r2="r")
    both = f3.withColumnRenamed("f", "a").join(head, ["w1", "w2"]).join(tail, ["w2", "w3"])
    bound = F.least(F.expr(_score("a", "l1", "a")), F.expr(_score("a", "l2", "a")))
    return both.select("lang", "w1", "w2", "w3", "a", "l1", "l2", *_lowest(2), bound.alias("bound"))


def _fours(f4: DataFrame, triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, w1..w4, a, l1, l2, r2, l3, r3, least): phrases below expanded triples with the parts of their cuts, but for the rest of the first."""
    head = _renamed(triples, 0, 3, lang="lang", l1="l1", l2="l2", l3="a", least="least")
    tail = _renamed(pairs, 2, 2, r2="a", r3="r")
    return f4.withColumnRenamed("f", "a").join(head, ["w1", "w2", "w3"]).join(tail, ["w3", "w4"])


def _with_rest(fours: DataFrame, f3: DataFrame, otherwise: str) -> DataFrame:
    """The scores of `fours`; where the last three words are not counted, with `otherwise` as their count."""
    rest = _renamed(f3, 1, 3, rest="f")
    joined = fours.join(rest, ["w2", "w3", "w4"], "left").withColumn("r1", F.coalesce("rest", otherwise))
    return joined.select("lang", "w1", "w2", "w3", "w4", "a", "rest", "least", *_lowest(3))


def _ranked(found: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    for k in range(1, 5):
        found = found.join(words.select(F.col("w1").alias(f"w{k}"), F.col("word").alias(f"word{k}")), f"w{k}", "left")
    phrase = F.concat_ws(" ", *(f"word{k}" for k in range(1, 5)))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = found.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(shipped(spark).read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), split as (
  select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as words from pieces
), places as (
  select lang, words, size, unnest(range(1, len(words) - size + 2)) as spot from split, range(1, 5) as sizes(size) where len(words) >= size
), counts as (
  select lang, size, array_to_string(words[spot:spot + size - 1], ' ') as phrase, count(*) as f from places group by all
), candidates as (
  select lang, size, phrase, f as a, string_split(phrase, ' ') as words from counts where size > 1 and f >= 30
), cuts as (
  select c.lang, c.phrase, k, l.f as l, r.f as r, cast(2000000::hugeint * a // (l.f + r.f) as bigint) as score
  from (select *, unnest(range(1, size)) as k from candidates) c
  join counts l on l.lang = c.lang and l.phrase = array_to_string(c.words[1:k], ' ')
  join counts r on r.lang = c.lang and r.phrase = array_to_string(c.words[k + 1:], ' ')
), lowest as (
  select lang, phrase, l, r, score from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), kept as (
  select c.lang, c.phrase, c.a from candidates c where not exists (
    select 1 from candidates d where d.lang = c.lang and d.size > c.size and 100 * d.a >= 80 * c.a
      and contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), totals as (
  select lang, cast(sum(f) as bigint) as n from counts where size = 1 group by lang
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join lowest using (lang, phrase) join totals using (lang)
qualify rank <= 2000
"""
