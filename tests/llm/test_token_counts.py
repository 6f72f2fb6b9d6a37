"""Token counts against the library itself."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fixtures_llm import documents, frame
from tidegate.llm import token_counts as T
from tidegate.llm.scratch import shipped

PATH = public_tokenizers.path(T.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def odd_texts(n, seed=5):
    rng = random.Random(seed)
    parts = ["'", "'s", "'re", "'ll", "'l", "'S", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "re", "Zoë", "1", "²", "٣", "!", "..", "<|endoftext|>", "<|", "字", "語", "́", "\U0001f600", "՘", "꟎", "\0", "é"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_pre_tokens_are_the_library_s(library):
    count = T.Counter(T.read_definition(PATH))
    texts = odd_texts(4000)
    joined, _, begin, end, text = count.pre.cut(texts)
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    got = [[] for _ in texts]
    for a, b, k in zip(begin, end, text):
        got[k].append((int(a - edges[k]), int(b - edges[k])))
    assert got == [[at for _, at in library.pre_tokenizer.pre_tokenize_str(t)] for t in texts]


def test_counts_are_the_library_s(library):
    texts = odd_texts(3000, seed=6)
    count = T.Counter(T.read_definition(PATH))
    plain = count.count(texts)
    assert plain.tolist() == [expected(library, t) for t in texts]
    key, check, tokens, _ = (np.concatenate(x) for x in zip(*count.lookups(texts, None)))
    _, first = np.unique(key, return_index=True)
    half = first[::2]
    table = T.LengthTable.of(key[half], check[half], tokens[half], 12)
    assert (table.find(key[half], check[half]) == tokens[half]).all()
    assert (table.find(key[half], check[half] ^ np.uint32(1)) == 0).all()
    assert count.count(texts, table).tolist() == plain.tolist()


def test_long_texts_and_a_full_cache(library, monkeypatch):
    monkeypatch.setattr(T, "GROUP_CHARS", 64)
    monkeypatch.setattr(T, "CACHE_ENTRIES", 20)
    count = T.Counter(T.read_definition(PATH))
    texts = ["some words  and\n\nothers's <|endoftext|>end " * 60, "x" * 5000, " " * 3000, "\n \t" * 700, ""]
    assert count.count(texts).tolist() == [expected(library, t) for t in texts]
    assert len(count.cache) <= 20


def test_operator(spark, library):
    docs = documents(shipped(spark))
    got = T.count_tokens(docs, PATH, limit=40)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    want = [(r.doc_id, len((r.text or "").encode()), n := expected(library, r.text), n > 40) for r in docs.collect()]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert T.count_tokens(docs.limit(0), PATH).count() == 0


def test_a_sample_changes_no_count(spark, library, monkeypatch):
    monkeypatch.setattr(T, "SAMPLE_TEXTS", 3)
    docs = frame(shipped(spark), [(k, t, None) for k, t in enumerate(odd_texts(300, seed=8))])
    got = {r.doc_id: r.n_tokens for r in T.count_tokens(docs, PATH).collect()}
    assert got == {r.doc_id: expected(library, r.text) for r in docs.collect()}


def test_query_on_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    out = T.op11_token_counts(spark, folder)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect()}
    assert got == {k: (len((t or "").encode()), n := expected(library, t), n > 1024) for k, t in docs.items()}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        T.read_definition(public_tokenizers.path("word_bpe_49k.json"))
