"""The registered queries over a folder of small tables, against plain Python of their contracts."""

from __future__ import annotations

import hashlib
import re
import zlib

import pytest

from fixtures_llm import documents
from test_contamination import brute as brute_contamination
from test_scans import brute as brute_licenses
from test_simhash_groups import brute_fingerprint, reach
from test_windows_and_bytes import brute_bytes, brute_windows, placed
from tidegate.llm import queries
from tidegate.llm.repeated_windows import keyed
from tidegate.llm.scratch import shipped


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Null ids, repeated rows, texts under one id, empty and null texts, extra columns; labels and items of them."""
    path = str(tmp_path_factory.mktemp("registered"))
    docs = documents(shipped(spark)).select("doc_id", "text", "lang", "source", "n_chars", "score", "tag")
    docs = docs.where("text is null or length(text) < 6000")
    other = docs.where("doc_id in (7, 14)").selectExpr("doc_id", "concat(text, ' mit license and more') as text", "lang", "source", "n_chars", "score", "tag")
    docs = docs.unionByName(other).unionByName(docs.where("doc_id = 21"))
    docs.write.parquet(f"{path}/documents.parquet")
    texts = [r.text for r in docs.where("doc_id in (14, 28)").collect()]
    items = [(1, " ".join(texts[0].split()[3:25]), "x"), (2, None, "x"), (3, "nothing of the kind", "x"), (4, "one", "x"), (None, " ".join(texts[1].split()[1:14]), "x")]
    spark.createDataFrame(items, "item_id long, text string, doc_id string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(r.doc_id, r.doc_id % 2, 0, "x") for r in docs.where("doc_id is not null").select("doc_id").distinct().collect()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def rows(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def run(spark, folder, name):
    out = queries.QUERIES[name](spark, folder)
    return dict(out.dtypes), out.collect()


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_op1(spark, folder, rows):
    types, got = run(spark, folder, "op1_quality")
    assert types == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    same([(r.doc_id, r.held_out) for r in got], [(i, i is None or zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_op2(spark, folder, rows):
    _, got = run(spark, folder, "op2_repeated_bytes")
    want = [(i, n, gone, spans, sha(left)) for i, n, gone, spans, left in brute_bytes([(i, t or "") for i, t in rows])]
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], want)


def test_op3(spark, folder, rows):
    _, got = run(spark, folder, "op3_language")
    same([(r.doc_id, r.held_out) for r in got], [(i, i is None or zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in rows])
    lettered = {i: any(c.isalpha() for c in t or "") for i, t in rows}
    for r in got:
        assert 0 <= r.score <= 1 and (r.lang_pred == "und" or r.lang_pred in ("en", "de", "es"))
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not lettered[r.doc_id])


def test_op4(spark, folder, rows):
    _, got = run(spark, folder, "op4_simhash_groups")
    prints = [brute_fingerprint(t) for _, t in rows]
    top = reach(len(prints), ((a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3))
    least = {}
    for k, (i, _) in zip(top, rows):
        if i is not None:
            least[k] = min(least.get(k, i), i)
    want = [(i, f"{p:016x}", least.get(k)) for k, (i, _), p in zip(top, rows, prints)]
    same([(r.doc_id, r.fingerprint, r.component_id) for r in got], want)


def test_op5(spark, folder):
    _, got = run(spark, folder, "op5_repeated_windows")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = [(i, n, gone, sha(kept.encode())) for i, n, gone, kept in brute_windows(placed(docs), 20)]
    same([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], want)


def test_op6(spark, folder, rows):
    _, got = run(spark, folder, "op6_secrets")
    assert {r.doc_id for r in got} <= {i for i, _ in rows}
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in got)


def test_op7(spark, folder, rows):
    _, got = run(spark, folder, "op7_licenses")
    same([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in got], [(i, *brute_licenses(t)) for i, t in rows])


def test_op8(spark, folder, rows):
    types, got = run(spark, folder, "op8_contamination")
    assert types["n_items"] == "bigint" and types["contaminated"] == "boolean"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = []
    for i, n_words, n_hit, found in brute_contamination(rows, items, 10):
        want.append((i, n_words, n_hit, len(found), sha(",".join(found).encode()), n_hit > 0))
    same([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got], want)


def test_op9(spark, folder, rows):
    _, got = run(spark, folder, "op9_mixing")
    assert len(got) == len(rows) and all(r.rate >= 0 for r in got)


def test_op10(spark, folder):
    _, got = run(spark, folder, "op10_fingerprints")
    docs = placed(spark.read.parquet(f"{folder}/documents.parquet"))
    tags = {(r.id, r.text): r.tag for r in keyed(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text").collect()}
    ordered = sorted(docs, key=lambda r: (r[0], tags[r[0], r[1]]))
    want = []
    for at, (_, text, i) in enumerate(ordered):
        after = ordered[(at + 1) % len(ordered)][1]
        half = len(text) // 2
        want.append((i, len(text), sha((text[: len(text) - half] + after[:half]).encode())))
    same([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], want)
    for r in got:
        assert re.fullmatch("[0-9a-f]{16}", r.fingerprint)
        near = 1 - (int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).bit_count() / 64
        assert r.near_edited == near and 0 <= r.near_next <= 1


def test_every_query_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    for name, query in queries.QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name
