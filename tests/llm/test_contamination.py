"""Contamination against brute force."""

from __future__ import annotations

import re

from fixtures_llm import documents, frame
from tidegate.llm.contamination import drop_contaminated, mark_contaminated
from tidegate.llm.scratch import shipped


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size):
    windows = []
    for item, text in items:
        words = words_of(text)
        n = min(size, len(words))
        windows += [(item, words[k : k + n]) for k in range(len(words) - n + 1) if n]
    out = []
    for i, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item, window in windows:
            for k in range(len(words) - len(window) + 1):
                if words[k : k + len(window)] == window:
                    hit |= set(range(k, k + len(window)))
                    found |= {item} - {None}
        out.append((i, len(words), len(hit), tuple(sorted(map(str, found)))))
    return sorted(out, key=repr)


def items_of(spark, docs):
    texts = [r.text for r in docs.where("length(text) > 100 and length(text) < 1500").orderBy("doc_id", "text").limit(6).collect()]
    rows = [(k, t.upper()[5:120]) for k, t in enumerate(texts)] + [(90, "x"), (91, "### !!"), (92, None), (93, ""), (None, texts[0][30:110]), (0, texts[1][10:90]), (94, "one\tmore")]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def test_marks_and_drops(spark):
    docs = documents(shipped(spark)).where("text is null or length(text) < 3000")
    rows, items = items_of(spark, docs)
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], rows, 10)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in mark_contaminated(docs, items).collect()), key=repr)
    assert got == want
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 for r in want if r[2] == 0)


def test_window_at_either_end_and_repeated_words(spark):
    docs = frame(shipped(spark), [(1, "a a a a a b", "en"), (2, "b, A-a a", "en"), (3, "q " * 2000 + "a a b", "en")])
    rows = [(1, "a a b"), (2, "a a a")]
    got = {(r.doc_id, r.n_hit, tuple(r["items"])) for r in mark_contaminated(docs, spark.createDataFrame(rows, "item_id long, text string"), size=3).collect()}
    assert got == {(1, 6, ("1", "2")), (2, 3, ("2",)), (3, 3, ("1",))}


def test_empty_tables(spark):
    docs = documents(shipped(spark))
    _, items = items_of(spark, docs)
    assert mark_contaminated(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in mark_contaminated(docs, items.limit(0)).collect()} == {0}
