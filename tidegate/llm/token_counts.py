"""Token counts by a map-side two-tier lookup.

Texts are cut into pre-tokens in numpy, by the character classes of the tokenizer's own library. The
token counts of frequent pre-tokens come from a compact hash table that is broadcast: open
addressing, 2**17 slots of 14 bytes, whatever the corpus. What it misses goes through a cache that
lives as long as its Python worker, and only what that misses is encoded by the library. No pre-token
is ever shuffled: every text is read once and gives one row.

Which pre-tokens are frequent is learnt from a bounded sample of whole texts. The sample decides what
is fast, never a count.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm.scratch import shipped, written_in_small_batches
from tidegate.llm.words import mix, powers, release

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
#: The frequent pre-tokens are those of about so many texts, of each its 2,048 most frequent.
SAMPLE_TEXTS = 1000
SAMPLE_PER_TEXT = 2048
TABLE_BITS = 17
TABLE_ENTRIES = 1 << 16
#: Code points worked on at once, and the bound of a worker's cache.
GROUP_CHARS = 1 << 19
CACHE_ENTRIES = 1 << 18
CACHED_CHARS = 64
U64 = np.uint64
LETTER, NUMBER, SIGN, SPACE, EDGE, UNKNOWN = range(6)
_EDGE = 0x110000
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
#: A text may be cut in front of white space that follows something else: no pre-token spans that.
_CUT = re.compile(r"(?<=\S)[ \n]")


class PreTokens:
    """Pre-tokens of texts: the byte-level pattern of contractions, letters, numbers, signs and white space.

    Classes of code points are asked of the library when they are first met, so its version of Unicode holds.
    """

    def __init__(self, pre_tokenizer):
        self.pre = pre_tokenizer
        self.classes = np.full(_EDGE + 1, UNKNOWN, np.uint8)
        self.classes[_EDGE] = EDGE
        self.lanes = [(np.random.default_rng(31 + k).integers(0, 1 << 63, _EDGE + 1, dtype=np.uint64) * U64(2) + U64(1)) for k in (0, 1)]

    def _class(self, code: int) -> int:
        joins = (("a", LETTER), ("1", NUMBER), ("!", SIGN))
        return next((k for x, k in joins if len(self.pre.pre_tokenize_str(x + chr(code))) == 1), SPACE)

    def kinds(self, codes: np.ndarray) -> np.ndarray:
        out = self.classes[codes]
        if (out == UNKNOWN).any():
            for code in np.unique(codes[out == UNKNOWN]).tolist():
                self.classes[code] = self._class(code)
            out = self.classes[codes]
        return out

    def cut(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(all texts joined, their code points, and start, end and text number of each pre-token)."""
        joined = "\0".join(texts) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int32)
        edges = np.cumsum([len(t) + 1 for t in texts]) - 1
        codes[edges] = _EDGE
        kind = self.kinds(codes)
        start = np.concatenate([[True], kind[1:] != kind[:-1]])
        start[edges] = False
        # White space in front of something else: its last character stands alone, or a blank joins what follows.
        follows = np.flatnonzero(start[1:] & (kind[1:] != SPACE) & (kind[:-1] == SPACE)) + 1
        start[follows - 1] = True
        start[follows[codes[follows - 1] == 0x20]] = False
        # Contractions: an apostrophe alone among signs and not behind a blank.
        quote = np.flatnonzero((codes == 0x27) & start)
        quote = quote[(kind[quote + 1] == LETTER) & (codes[quote] == 0x27)]
        one, two = codes[quote + 1], codes[np.minimum(quote + 2, len(codes) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for size, at in ((2, quote[short]), (3, quote[long & ~short])):
            start[at + 1] = False
            start[at + size] |= kind[at + size] == LETTER
        bounds = np.flatnonzero(start | (kind == EDGE))
        first = start[bounds]
        begin = bounds[:-1][first[:-1]]
        end = bounds[1:][first[:-1]]
        return joined, codes, begin, end, np.searchsorted(edges, begin)

    def hashes(self, codes: np.ndarray, begin: np.ndarray, end: np.ndarray, lane: int) -> np.ndarray:
        if not len(begin):
            return np.zeros(0, np.uint64)
        size = end - begin
        longest = 1 << int(size.max()).bit_length()
        at = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(at[-1]) - np.repeat(at[:-1], size)
        value = self.lanes[lane][codes[np.repeat(begin, size) + place]] * powers(_BASES[lane], longest)[place]
        return mix(np.add.reduceat(value, at[:-1]) + size.astype(np.uint64) * U64(_BASES[1 - lane]))


@dataclass
class LengthTable:
    """Token counts by pre-token hash: open addressing with linear probes; tokens 0 marks a free slot."""

    key: np.ndarray
    check: np.ndarray
    tokens: np.ndarray

    @classmethod
    def of(cls, key: np.ndarray, check: np.ndarray, tokens: np.ndarray, bits: int = TABLE_BITS) -> LengthTable:
        if len(key) > 1 << bits - 1:
            raise ValueError("the table would be more than half full")
        table = cls(np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.uint16))
        for k, c, n in zip(key.tolist(), check.tolist(), tokens.tolist()):
            slot = k >> 64 - bits
            while table.tokens[slot]:
                slot = (slot + 1) & (1 << bits) - 1
            table.key[slot], table.check[slot], table.tokens[slot] = k, c, n
        return table

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The token count of each pre-token, 0 where the table has none."""
        bits = len(self.key).bit_length() - 1
        out = np.zeros(len(key), np.int64)
        slot, left = (key >> U64(64 - bits)).astype(np.int64), np.arange(len(key))
        while len(left):
            met = (self.key[slot] == key[left]) & (self.check[slot] == check[left]) & (self.tokens[slot] > 0)
            out[left[met]] = self.tokens[slot[met]]
            on = ~met & (self.tokens[slot] > 0)
            slot, left = (slot[on] + 1) & (1 << bits) - 1, left[on]
        return out


class Counter:
    """Counts tokens of texts inside a worker: the table first, then the worker's cache, then the library."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.pre = PreTokens(self.library.pre_tokenizer)
        special = sorted((t["content"] for t in json.loads(definition)["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.cache: dict[str, int] = {}

    def stretches(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(stretches, the text of each, special strings of each text): cut at special strings, and long texts at safe places."""
        out, owner, special = [], [], np.zeros(len(texts), np.int64)
        for number, text in enumerate(texts):
            parts = [text]
            if self.special and self.special.search(text):
                parts = self.special.split(text)
                special[number] = len(parts) - 1
            for part in parts:
                at = 0
                while len(part) - at > GROUP_CHARS:
                    cut = _CUT.search(part, at + GROUP_CHARS // 2)
                    if cut is None:
                        break
                    out.append(part[at : cut.start()])
                    owner.append(number)
                    at = cut.start()
                out.append(part[at:])
                owner.append(number)
        return out, np.array(owner, np.int64), special

    def lookups(self, texts: list[str], table: LengthTable | None) -> Iterator[tuple[np.ndarray, ...]]:
        """(hash, check, tokens, text number) of the pre-tokens, for groups of stretches of bounded size."""
        parts, owner, _ = self.stretches(texts)
        size = np.cumsum([len(p) for p in parts])
        for group in np.split(np.arange(len(parts)), np.flatnonzero(np.diff(size // GROUP_CHARS)) + 1):
            if not len(group):
                continue
            joined, codes, begin, end, part = self.pre.cut([parts[k] for k in group])
            key = self.pre.hashes(codes, begin, end, 0)
            check = self.pre.hashes(codes, begin, end, 1).astype(np.uint32)
            tokens = table.find(key, check) if table else np.zeros(len(key), np.int64)
            missed = np.flatnonzero(tokens == 0)
            if len(missed):
                both = key[missed] ^ (check[missed].astype(np.uint64) << U64(32))
                _, first, back = np.unique(both, return_index=True, return_inverse=True)
                words = [joined[a:b] for a, b in zip(begin[missed[first]].tolist(), end[missed[first]].tolist())]
                tokens[missed] = np.array(self.encoded(words), np.int64)[back]
            yield key, check, tokens, owner[group][part]

    def encoded(self, words: list[str]) -> list[int]:
        new = [w for w in words if w not in self.cache]
        counts = dict(zip(new, (len(x.ids) for x in self.library.encode_batch_fast(new, add_special_tokens=False)))) if new else {}
        out = [counts[w] if w in counts else self.cache[w] for w in words]
        if len(self.cache) + len(counts) > CACHE_ENTRIES:
            self.cache.clear()
        self.cache.update((w, n) for w, n in counts.items() if len(w) <= CACHED_CHARS)
        return out

    def count(self, texts: list[str], table: LengthTable | None = None) -> np.ndarray:
        out = self.stretches(texts)[2]
        for _, _, tokens, text in self.lookups(texts, table):
            out += np.bincount(text, tokens, len(texts)).astype(np.int64)
        return out


_COUNTERS: dict[str, Counter] = {}


def counter(definition: str) -> Counter:
    """The worker's counter of this tokenizer, with its cache: a worker outlives its tasks."""
    name = hashlib.sha256(definition.encode()).hexdigest()
    if name not in _COUNTERS:
        _COUNTERS[name] = Counter(definition)
    return _COUNTERS[name]


def read_definition(path: str) -> str:
    """The tokenizer file's text, after a look whether its tokens can be counted pre-token by pre-token."""
    text = Path(path).read_text(encoding="utf-8")
    pieces = json.loads(text)
    pre = pieces.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    flags = any(t[f] for t in pieces["added_tokens"] for f in ("single_word", "lstrip", "rstrip"))
    if pieces.get("normalizer") or not plain or flags or pieces["model"].get("dropout"):
        raise ValueError("the tokenizer must cut texts by the byte-level pattern alone, without a normalizer")
    return text


def frequent_lengths(docs: DataFrame, definition: str, text_col: str = "text") -> LengthTable:
    """The table of the most frequent pre-tokens of a bounded sample; at most 2**16 of them, below 65,536 tokens each."""
    rows = docs.count()
    sample = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if rows > SAMPLE_TEXTS:
        sample = sample.sample(False, SAMPLE_TEXTS / rows, 11)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(definition)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = [x[:3] for x in count.lookups([text], None)]
                if found:
                    key, check, tokens = (np.concatenate(x) for x in zip(*found))
                    _, first, times = np.unique(key, return_index=True, return_counts=True)
                    top = np.argsort(-times, kind="stable")[:SAMPLE_PER_TEXT]
                    first, times = first[top], times[top]
                    fields = (key[first], check[first], np.minimum(tokens[first], 1 << 20).astype(np.uint32), times.astype(np.uint32))
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in fields], ["key", "check", "tokens", "times"])

    columns: list[list[np.ndarray]] = [[], [], [], []]
    for row in sample.mapInArrow(seen, "key binary, check binary, tokens binary, times binary").collect():
        for held, raw, kind in zip(columns, row, (np.uint64, np.uint32, np.uint32, np.uint32)):
            held.append(np.frombuffer(raw, kind))
    key, check, tokens, times = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in columns)
    key, first, back = np.unique(key, return_index=True, return_inverse=True)
    total = np.bincount(back, times, len(key)) if len(key) else np.zeros(0)
    fits = np.flatnonzero(tokens[first] < 1 << 16)
    top = fits[np.argsort(-total[fits], kind="stable")[:TABLE_ENTRIES]]
    return LengthTable.of(key[top], check[first[top]], tokens[first[top]])


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each row of `docs`.

    Counts are those of the library for `tokenizer`, a file of byte-level BPE: whole texts, without
    begin, end or added tokens; a special string inside a text is one token. A null text is empty and
    has no token. Repeated rows and rows without an id stay rows of their own; ids pass through as
    they are. Extra columns are ignored, whatever their names. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    definition = read_definition(tokenizer)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    shared = spark.sparkContext.broadcast((definition, frequent_lengths(docs, definition, text_col)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, table = shared.value
        count = counter(definition)
        for batch in batches:
            tokens = count.count(batch.column(1).to_pylist(), table)
            n_bytes = pc.cast(pc.binary_length(batch.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"])
        release()

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).mapInArrow(rows, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")
    return written_in_small_batches(count_tokens(docs, public_tokenizers.path(TOKENIZER)), 500)
