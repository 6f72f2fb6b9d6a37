"""The trie of conversations against a plain walk over all prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from tidegate.llm import conversation_trie as C
from tidegate.llm.scratch import shipped

SCHEMA = "conv_id long, turn long, role string, text string, depth int, least string, k1 string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (c % 20 if c >= 0 else -(-c % 20))
        made[c] = tuple(own.get(donor, [])[:h] + turns[h:])
    return made


def brute(rows):
    made = rebuilt(rows)
    members, words = defaultdict(list), {(): 0}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                words[turns[:d]] = len(re.findall(r"[^\x20\x09-\x0D]+", turns[d - 1][1]))
    out = []
    for node, convs in members.items():
        under = [m for m in members if m[: len(node)] == node]
        parent = min(members[node[:-1]]) if node else None
        children = sum(len(m) == len(node) + 1 for m in under)
        leaves = sum(all(not (len(x) == len(m) + 1 and x[:-1] == m) for x in under) for m in under)
        saved = sum((len(members[m]) - 1) * words[m] for m in under)
        ends = ",".join(map(str, sorted(c for c in convs if made[c] == node)))
        out.append((min(convs), len(node), parent, len(convs), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def talk(seed, convs=70, most=6):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 200), convs):
        for t in range(rng.randint(1, most)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "user", None]), rng.choice(["hi", "hi there", "", None, " a\tb\x0bc  d", "ümläut x"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = talk(seed)
    rows += [rows[0], rows[0], (None, 1, "user", "lost"), (400, None, None, None), (401, 1, "user", "w " * 30_000)]
    got = C.conversation_trie(frame(shipped(spark), rows).repartition(5))
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows)))


def test_long_conversations_copies_and_small_tries(spark, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT_TURNS", 4)
    monkeypatch.setattr(C, "TRIE_PREFIXES", 7)
    rng = random.Random(9)
    base = [("user", f"word {rng.randint(0, 3)} more") for _ in range(23)]
    rows = []
    for c in range(0, 900, 20):  # copies, and prefixes that end at every depth
        length = len(base) if c % 40 else rng.randint(1, len(base))
        rows += [(c, k, *base[k]) for k in range(length)]
    rows += [(c, k, "user", rng.choice("ab")) for c in range(1, 300, 7) for k in range(rng.randint(1, 12))]
    got = C.conversation_trie(frame(shipped(spark), rows).repartition(3))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows)))


def test_a_conversation_over_several_partitions(spark, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT_TURNS", 64)
    rows = [(7, k % 40 or None, "user", f"{k % 90}") for k in range(400)] + talk(4, 12)
    got = C.conversation_trie(frame(shipped(spark), rows))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows)))


def test_empty_and_turnless(spark):
    assert C.conversation_trie(frame(shipped(spark), []).limit(0)).count() == 0
    short = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(short, 1, "user", "gone")]
    got = C.conversation_trie(frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows))) and len(got) == 1


def test_fat_binary_search_visits_few_nodes(monkeypatch):
    probes = []

    class Counted(dict):
        def get(self, key, default=None):
            probes.append(key)
            return super().get(key, default)

    trie = C.ZFastTrie(1)
    trie.handles = Counted()
    chain = [k.to_bytes(16, "big") for k in range(1025)]
    for end in range(1, 1025, 2):  # every second prefix is a node
        trie.insert_batch([((chain[: end + 1], list(range(end + 1)), 0), [1], end)])
    probes.clear()
    assert trie.high[trie.locate(chain, trie.roots[chain[0]])] == 1023
    assert len(probes) <= 11


def test_sql_twin(spark):
    rows = [r for r in talk(5, 40) if r[0] is None or r[0] >= 0]
    docs = frame(shipped(spark), rows)
    con = duckdb.connect()
    con.register("conversations", docs.toPandas())
    got = sorted(map(repr, map(tuple, C.conversation_trie(docs).collect())))
    assert got == sorted(map(repr, con.sql(C.ORACLE_SQL).fetchall()))
