"""License and secret scans."""

from __future__ import annotations

import re

from fixtures_llm import documents, frame
from tidegate.llm import secret_findings as F, secrets as S
from tidegate.llm.license_rules import rules
from tidegate.llm.repeated_windows import keyed
from tidegate.llm.licenses import scan_licenses
from tidegate.llm.scratch import shipped
from tidegate.llm.secrets import redact, scan_secrets

LICENSED = [
    "Released under the MIT License.", "MIT License mit license, MIT LICENSE", "Apache License, Version 2.0, or General-Public License",
    "licensed under the GNU General Public License, version 3 or later", "Creative Commons Attribution-ShareAlike 4.0", "see CC BY-NC-SA 3.0 text",
    "SPDX-License-Identifier: GPL-2.0-only", "the license of drivers", "mit", "license " * 3000, "All rights reserved. " + "pad " * 500 + "BSD license",
    "permission is hereby granted, free of charge, to any person obtaining a copy", "", None, "apache  licence", "general public license general public license",
]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    """Base columns, and labels of all rules around each keyword, by Python's regular expressions."""
    words = words_of(text)
    base = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        base += [(k, label) for k in range(len(words)) if words[k : k + len(parts)] == parts]
    found = set()
    for at, word in enumerate(words):
        lo = max(at - 14, 0)
        window = " ".join(words[lo : lo + 36])
        for rule in rules():
            if rule.keyword == word and (m := re.search(f"(?:^| )({rule.pattern})(?= |$)", window)):
                start = lo + len(window[: m.start(1)].split())
                found.add((start, start + len(m[1].split()), rule.rank, rule.label, rule.name, rule.weight))
    left = [
        d for d in found
        if not any(
            o[2] >= d[2] and o[0] <= d[0] and o[1] >= d[1] and (o[0], -o[1], -o[2], o[4]) < (d[0], -d[1], -d[2], d[4])
            for o in found
        )
    ]
    labels = sorted({d[3] for d in left} | {x for _, x in base})
    score = max([0.0, *(d[5] for d in left), *(0.9 for _ in base)])
    return (
        len(words), len(base), min((k for k, _ in base), default=None), max((k for k, _ in base), default=None),
        ",".join(sorted({x for _, x in base})), ",".join(labels), score,
    )


def test_licenses_against_brute_force(spark):
    rows = [(i, t, "en") for i, t in enumerate(LICENSED)] + [(0, LICENSED[0], "en"), (0, LICENSED[3], "en"), (None, LICENSED[2], "en")]
    docs = frame(shipped(spark), rows)
    got = sorted(tuple(r)[:8] for r in scan_licenses(docs).fillna(-1, ["doc_id"]).collect() if r.doc_id != 9)
    want = sorted((-1 if i is None else i, *brute(t)) for i, t, _ in rows if i != 9)
    assert got == want
    heavy = scan_licenses(docs.where("doc_id = 9")).collect()[0]
    assert heavy.n_words == 3000 and heavy.n_base == 0 and heavy.labels == ""


def test_license_rules_and_odd_rows(spark):
    assert len(rules()) >= 300 and len({r.name for r in rules()}) == len(rules())
    assert all(re.search(r.keyword, r.pattern.replace("[cs]", "s")) for r in rules())
    docs = documents(shipped(spark))
    assert scan_licenses(docs).count() == docs.count()
    assert scan_licenses(docs.limit(0)).count() == 0


def secret_rows():
    rows = []
    for i in range(120):
        digest = f"{(i * 7919 + 12345) * 104729:015x}{i * 31:05x}"
        kind = i % 6
        rows.append((i, (
            f"some words password={digest} here", f'use token = "{digest}{digest}" now', f"write to ann{i}.x@mail{i}.example.com please",
            f"at 10.20.{i}.7 and 555-01{i:02d}", f"key AKIA{digest.upper()[:16]:0<16} there", f"card 4929 4929{i:012d} end",
        )[kind], "en"))
    return rows


def test_secrets_are_found_and_others_left(spark):
    docs = frame(shipped(spark), secret_rows())
    found = scan_secrets(docs).cache()
    kept = {r.doc_id for r in found.where("kept").collect()}
    assert {i for i in range(120) if i % 6 in (0, 1, 4)} == kept
    clean = redact(docs, found)
    assert clean.columns == docs.columns and clean.count() == 120
    for r in clean.collect():
        assert ("[secret]" in r.text) == (r.doc_id in kept)
        assert not re.search(r"AKIA[0-9A-Z]{16}", r.text)


def test_forest_on_held_out_findings(spark):
    """Trained on the even draws of each kind, judged on the odd ones; and on kinds it has never seen."""
    docs = documents(shipped(spark))
    prose = S.learn_prose(docs)
    assert len(prose.words) > 100 and len(prose.follows) == len(S.ALPHABET) ** 2
    found = S.written(S.labelled_findings(spark, prose))
    assert found.select("doc_id").distinct().count() >= 500
    judged = S.judge(found.where("draw % 2 = 1"), S.fit_forest(found.where("draw % 2 = 0"))).collect()
    right = sum(r.kept and r.label == 1 for r in judged)
    assert right / sum(r.kept for r in judged) >= 0.9
    assert right / sum(r.label for r in judged) >= 0.9
    kinds = len(F.KINDS)
    unseen = [k for k in range(kinds) if k % 5 == 2]
    forest = S.fit_forest(found.where(~(found.doc_id % kinds).isin(unseen)))
    judged = S.judge(found.where((found.doc_id % kinds).isin(unseen)), forest).collect()
    assert sum(r.kept == (r.label == 1) for r in judged) / len(judged) >= 0.75


def test_prose_is_learnt_from_all_texts(spark):
    """A table of several thousand rows: words that four of them have each are all in the dictionary."""
    letters = "abcdefghij"
    named = ["word" + "".join(letters[int(c)] for c in f"{i:04d}") for i in range(1500)]
    docs = frame(shipped(spark), [(i, f"{named[i % 1500]} {i}", "en") for i in range(6000)] + [(6000, None, "en")])
    assert set(S.learn_prose(docs).words) == set(named)


def test_redaction_keeps_to_the_place(spark):
    texts = [
        "passwd planter says the planters plant", " \n x = exchange12  exchange12\ty", "a secret b [secret] c", "", None, "one  two\tthree ",
        "ключ=значение123 ключ", "tail token=abc", "quote's \\ back",
    ]
    cuts = [(0, 1, 0, "planter"), (1, 2, 0, "exchange12"), (2, 1, 0, "secret"), (2, 3, 1, "secret"), (5, 0, 0, "one"), (5, 2, 3, "ee"), (6, 0, 5, "значение"), (6, 0, 9, "ение123"), (7, 1, 6, "abc"), (8, 0, 5, "'s")]
    cuts = [(k, w, texts[k].split()[w].find(s) if k != 6 else at, s) for k, w, at, s in cuts]
    docs = frame(shipped(spark), [(k, t, "en") for k, t in enumerate(texts)])
    keys = {r.doc_id: r for r in keyed(docs, "doc_id", "text").collect()}
    found = spark.createDataFrame([(keys[k].id, keys[k].tag, w, at, s, True) for k, w, at, s in cuts], "id long, tag long, word int, at int, secret string, kept boolean")
    got = {r.doc_id: r.text for r in redact(docs, found).collect()}
    assert got == {
        0: "passwd [secret] says the planters plant", 1: " \n x = [secret]  exchange12\ty", 2: "a [secret] b [[secret]] c", 3: "", 4: None,
        5: "[secret]  two\tthr[secret] ", 6: "ключ=[secret] ключ", 7: "tail token=[secret]", 8: "quote[secret] \\ back",
    }


def test_secrets_odd_rows(spark):
    docs = documents(shipped(spark))
    found = scan_secrets(docs)
    assert redact(docs, found).count() == docs.count()
    assert scan_secrets(docs.limit(0)).count() == 0
    one = frame(spark, [(1, "password=abc123def456", "en"), (1, "password=abc123def456", "en"), (None, "token=abc123def456", "en")])
    assert redact(one, scan_secrets(one)).where("contains(text, '[secret]')").count() == 3
    assert scan_secrets(one.drop("source")).count() == 3


def test_all_secrets_of_one_word(spark):
    aws, other, github = "AKIA" + "Q7X2" * 4, "ASIA" + "Z9K4" * 4, "ghp_" + "a1B2c3" * 6
    words = [f'{{"a":"{aws}","b":"{github}"}}', f"k1={aws},k2={other}", f"http://x.y/?token=hunter22x&key=1&password=s3cr3t99&b={github}", f"{aws}=f00dbabe12345678c"]
    docs = frame(shipped(spark), [*secret_rows(), *((1000 + k, f"see {w} there", "en") for k, w in enumerate(words))])
    found = scan_secrets(docs).cache()
    got = {}
    for r in found.where("doc_id >= 1000").collect():
        assert words[r.doc_id - 1000][r["at"] :].startswith(r.secret)
        got.setdefault(r.doc_id - 1000, set()).add(r.secret)
    assert {aws, github} <= got[0] and {aws, other} <= got[1] and {"hunter22x", "s3cr3t99", github} <= got[2]
    assert aws in got[3] and any("f00dbabe12345678c" in s for s in got[3])
    left = {r.doc_id: r.text for r in redact(docs, found).where("doc_id >= 1000").collect()}
    assert not any(s in t for s in (aws, other, github) for t in left.values())


def test_values_behind_a_name_and_a_space(spark):
    texts = ["my password: Xy7k2Lm9 ok", "set password = s3cr3t99 now", 'use secret: "hunterxyz" then', "passwd correcthorse", "password: abc"]
    docs = frame(shipped(spark), [*secret_rows(), *((1000 + k, t, "en") for k, t in enumerate(texts))])
    got = {(r.doc_id - 1000, r.secret) for r in scan_secrets(docs).where("doc_id >= 1000").collect()}
    assert got == {(0, "Xy7k2Lm9"), (1, "s3cr3t99"), (2, "hunterxyz"), (3, "correcthorse")}


def test_every_mention_of_a_license_in_a_window(spark):
    texts = [
        "GNU Lesser General Public License version 3 or the GNU General Public License version 3",
        "GNU General Public License version 2 or later and the GNU General Public License version 2 here",
        "Apache License 2.0 MIT License Apache License 2.0",
    ]
    docs = frame(shipped(spark), [(k, t, "en") for k, t in enumerate(texts)])
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert {"lgpl-3.0", "gpl-3.0"} <= set(got[0].labels.split(","))
    assert [f.start for f in got[1].found if f.label.startswith("gpl-2.0")] == [0, 10]
    assert [(f.start, f.label) for f in got[2].found] == [(0, "apache-2.0"), (4, "mit"), (6, "apache-2.0")]
