"""Collocations against a count of everything."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from fixtures_llm import SCHEMA
from tidegate.llm import collocations as C, words as W
from tidegate.llm.scratch import shipped

LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def brute(rows, top, least):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for size in (1, 2, 3, 4):
                counts[lang].update(words[k : k + size] for k in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            inside = lambda q: any(q[k : k + len(p)] == p for k in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= 80 * a and inside(q) for q, b in found.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def speech(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Über", "ß", "of", "OF", "the"] * 6
    fixed = ["new york city hall", "the king of spain", "a b a b a b", "over and over and over again", "Über alles geht"]
    out = []
    for k in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 5))))
        text = "".join(p + rng.choice([" ", ". ", ",", "  ", "\t", "\n", "! "]) for p in parts)
        out.append((rng.choice(["en", "en", "de", None]), text))
    return [*out, *out[:20], ("en", None), (None, ""), ("de", " .,\t\n"), ("en", "the king of spain " * 900), ("de", "x" * 3000), ("", "lonely words")]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, "s", 1, "x", None, 1, "s", 2, "f") for k, (lang, t) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("seed,top,least", [(1, 2000, 5), (2, 10, 4), (3, 3, 8), (4, 40, 3)])
def test_against_brute_force(spark, seed, top, least):
    rows = speech(seed)
    got = C.collocations(frame(shipped(spark), rows).repartition(4), top=top, least=least)
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *((c, "bigint") for c in ("a", "l", "r", "n", "score"))]
    assert sorted(map(tuple, got.collect())) == brute(rows, top, least)


def test_several_rounds_and_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(C, "FIRST_PAIRS", 1)
    monkeypatch.setattr(C, "RAW_ROWS", 500)
    monkeypatch.setattr(C, "HELD_ROWS", 800)
    monkeypatch.setattr(C, "HELD_WORDS", 30)
    counted = []
    real = C.phrase_counts
    monkeypatch.setattr(C, "phrase_counts", lambda texts, size, *a: counted.append(size) or real(texts, size, *a))
    rows = speech(7, 400)
    got = C.collocations(frame(shipped(spark), rows).repartition(4), top=25, least=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 25, 3)
    assert counted.count(4) > 1


def test_bounds_leave_part_of_the_frontier(spark, monkeypatch):
    """Fewer triples are counted than there are."""
    sizes = {}
    real = C.phrase_counts

    def counting(texts, size, *a):
        out = real(texts, size, *a)
        sizes[size] = sizes.get(size, 0) + out.count()
        return out

    monkeypatch.setattr(C, "phrase_counts", counting)
    rows = speech(3, 400)
    got = C.collocations(frame(shipped(spark), rows), top=2, least=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, 3)
    few = dict(sizes)
    sizes.clear()
    C.collocations(frame(spark, rows), top=2000, least=3).count()
    assert few[3] < sizes[3]


def test_long_texts_are_cut_at_piece_ends():
    import numpy as np

    raw = ("one two three. four five, six " * 200 + "seven " * 300 + "! end").encode()
    data = np.frombuffer(raw, np.uint8)
    whole = W.Texts(0, data, np.array([0]), np.array([len(data)]))
    cut = list(C.stretches(whole, 100))
    assert b"".join(t.data.tobytes() for t in cut) == raw and len(cut) > 50
    assert all(t.data.tobytes()[-1:] in b".,!" for t in cut[:-1])
    langs = np.zeros(1, np.uint64)
    at_once, apart = C.spoken(whole, langs), [C.spoken(t, langs) for t in cut]
    assert (np.concatenate([s.word for s in apart]) == at_once.word).all()
    assert sum(len(set(s.run.tolist())) for s in apart) == len(set(at_once.run.tolist()))


def test_empty_table_and_sql_twin(spark):
    assert C.collocations(frame(shipped(spark), speech(1)).limit(0)).count() == 0
    rows = speech(5, 900)
    docs = frame(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    got = sorted(map(tuple, C.collocations(docs).collect()))
    assert got == sorted(con.sql(C.ORACLE_SQL).fetchall()) and got
