"""The pipeline's stages, each on its own input."""

from __future__ import annotations

import pytest

import corpus_pipeline
from fixtures_llm import documents
from test_contamination import brute as brute_contamination
from test_simhash_groups import brute_fingerprint, reach
from tidegate.llm.scratch import shipped, written


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    shipped(spark)
    path = str(tmp_path_factory.mktemp("tables"))
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars").where("text is null or length(text) < 5000")
    docs.write.parquet(f"{path}/documents.parquet")
    text = docs.where("doc_id = 14").first().text
    items = [(1, text[10:110]), (2, None), (3, "nothing of the kind")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(r.doc_id, 1, 0) for r in docs.where("doc_id % 2 = 0").collect()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def key(row):
    return repr(tuple(row))


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, folder))
        seen[name] = (docs.collect(), out.collect(), docs.columns, out.columns)
        docs = out
    before, after, *columns = seen["language"]
    assert columns[0] == columns[1]
    assert sorted(map(key, after)) == sorted(key(r) for r in before if r.text and any(c.isalpha() for c in r.text))

    before, after, *columns = seen["near_duplicates"]
    assert columns[0] == columns[1]
    prints = [brute_fingerprint(r.text) for r in before]
    top = reach(len(prints), ((i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3))
    groups = {}
    for k, r in zip(top, before):
        groups.setdefault(k, []).append(r)
    heads = [min(g, key=lambda r: (r.doc_id is None, r.doc_id or 0)).doc_id for g in groups.values()]
    assert sorted(map(str, heads)) == sorted(str(r.doc_id) for r in after)

    before, after, *columns = seen["contamination"]
    assert columns[0] == columns[1]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = {r[0] for r in brute_contamination([(r.doc_id, r.text) for r in before], items, 10) if r[2]}
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in hit) and hit

    before, after, *columns = seen["secrets"]
    assert columns[0] == columns[1] and len(before) == len(after)

    before, after, *columns = seen["mixing"]
    assert set(columns[0]) < set(columns[1])
    assert {key(tuple(r)[:5]) for r in after} <= {key(r) for r in before}
    assert all(r.copies > 0 for r in after)


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 0
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_with_clashing_names_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name in ("score", "lang_pred", "_id", "_tag", "_path", "rule", "rate", "id", "fp", "posterior"):
        docs = docs.withColumn(name, corpus_pipeline.F.lit(f"own {name}"))
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        for name in ("score", "_id", "rule", "posterior"):
            assert {r[0] for r in out.select(name).collect()} == {f"own {name}"}
    last = corpus_pipeline.STAGES[4][1](spark, docs, folder)
    assert set(last.columns) == set(docs.columns) - {"posterior"} | {"domain", "copies", "posterior"}
