"""Language, quality and mixing: gradients, held-out accuracy, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from fixtures_llm import documents, frame, prose
from tidegate.llm import language, mixing, quality, scratch
from tidegate.llm.scratch import shipped


def test_language_gradients():
    rng = np.random.default_rng(0)
    net = language.fresh(["a", "b", "c"])
    net = language.Network(*(w.astype(np.float64) for w in net.weights()), net.languages)
    symbols = rng.integers(97, 110, (6, 5)).astype(np.int16)
    symbols[4:, 2] = language.PAD
    label = rng.integers(0, 3, 5)
    _, grads = language.gradients(net, symbols, label)
    for w, g in zip(net.weights(), grads):
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w.shape)
            at = (*at[:2], int(rng.integers(97, 110))) if w.shape[-1] == 257 else at
            kept, losses = w[at], []
            for step in (1e-3, -1e-3):
                w[at] = kept + step
                losses.append(language.gradients(net, symbols, label)[0])
            w[at] = kept
            assert g[at] == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=1e-5)


def test_language_positions_and_pool():
    net = language.fresh(["a", "b"])
    texts = pa.array(["hello world " * 30, "", "é", None, "x" * 64, "y" * 65])
    p = language.document_probabilities(net, texts)
    assert p[[0, 2, 4, 5]].sum(axis=1) == pytest.approx(1, abs=1e-5)
    assert (p[[1, 3]] == 0).all()
    whole = language.document_probabilities(net, pa.array(["hello world " * 30]))
    assert p[0] == pytest.approx(whole[0], abs=1e-6)


def test_language_on_held_out_rows(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, ("en", "de", "es")[i % 3], 40), ("en", "de", "es")[i % 3]) for i in range(240)]
    docs = frame(shipped(spark), rows)
    net = language.fit(docs.where("doc_id < 180"))
    got = language.identify(docs.where("doc_id >= 180"), net)
    assert got.where("lang = lang_pred").count() >= 57
    assert got.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]


def test_language_odd_rows(spark):
    docs = documents(shipped(spark))
    net = language.fit(docs)
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in language.identify(docs, net).collect()}
    for (_, text), (label, score) in got.items():
        letters = text is not None and any(c.isalpha() for c in text)
        assert (label != "und") == letters
        assert 0 <= score <= 1 and (letters or score == 0)
    assert language.identify(docs.limit(0), net).count() == 0
    assert language.fit(docs.where("lang is null")) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}


def test_risk_gradient_and_the_turn_below_zero():
    rng = np.random.default_rng(2)
    p, u = rng.normal(1, 1, (40, 5)), rng.normal(0, 1, (60, 5))
    weights = [rng.normal(0, 1, (5, quality.HIDDEN)), np.zeros(quality.HIDDEN), rng.normal(0, 1, (quality.HIDDEN, 1)), np.zeros(1)]
    _, grads = quality.non_negative_risk(weights, p, u, 0.3)
    for w, g in zip(weights, grads):
        at = tuple(rng.integers(0, s) for s in w.shape)
        kept, losses = w[at], []
        for step in (1e-5, -1e-5):
            w[at] = kept + step
            losses.append(quality.non_negative_risk(weights, p, u, 0.3)[0])
        w[at] = kept
        assert g[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-4)
    # Unlabelled rows all look negative and positives do not: the bracket falls below zero.
    weights = [np.eye(5, quality.HIDDEN), np.zeros(quality.HIDDEN), np.full((quality.HIDDEN, 1), 4.0), np.full(1, -2.0)]
    p, u = np.abs(p), -np.abs(u) - 1
    risk, turned = quality.non_negative_risk(weights, p, u, 0.9)
    assert risk == pytest.approx(0.9 * np.logaddexp(0, -quality._forward(weights, p)[1]).mean())
    z_p, z_u = (quality._forward(weights, x)[1] for x in (p, u))
    assert turned[3][0] == pytest.approx(0.9 * quality._sigmoid(z_p).mean() - quality._sigmoid(z_u).mean())


def test_prior_and_held_out_quality():
    rng = np.random.default_rng(3)
    good, bad = (lambda n: rng.normal(1, 0.6, (n, 8))), (lambda n: rng.normal(-1, 0.6, (n, 8)))
    scorer = quality.fit(good(1500), np.concatenate([good(1400), bad(600)]))
    assert scorer.prior == pytest.approx(0.7, abs=0.12)
    assert (scorer.score(good(500)) >= 0.5).mean() > 0.95
    assert (scorer.score(bad(500)) < 0.5).mean() > 0.95


def test_quality_features_of_texts_do_not_depend_on_neighbours():
    texts = ["Good day, this is fine.", None, "", "SHOUT!! SHOUT!!", "é", "a a a a b"]
    together = quality.features(pa.array(texts))
    for k, text in enumerate(texts):
        assert together[k] == pytest.approx(quality.features(pa.array([text], pa.string()))[0], abs=1e-6)
    assert not together[1].any() and not together[2].any()


def test_quality_odd_rows(spark):
    docs = documents(shipped(spark))
    ids = docs.select("doc_id").where("doc_id % 2 = 0")
    scorer = quality.fit_on(docs, ids, ids)
    got = quality.score_texts(docs, scorer)
    assert got.count() == docs.count() and all(0 <= r.score <= 1 for r in got.collect())
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert quality.fit_on(docs, ids.limit(0), ids) is None
    assert quality.score_texts(docs.limit(0), scorer).count() == 0
    assert {r.score for r in quality.score_texts(docs, None).collect()} == {0.5}


def test_rates_match_targets_and_brute_force(spark):
    rng = np.random.default_rng(6)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    tokens = rng.integers(0, 500, 300)
    members = shipped(spark).createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p)], "n_tokens long, posterior array<double>")
    for shares in ([0.5, 0.3, 0.2], [0.02, 0.03, 0.95]):
        steps = mixing.fit_rates(members, shares)
        rate = steps.rates(p)[0]
        assert (rate >= 0).all()
        assert (tokens * rate) @ p / tokens.sum() == pytest.approx(shares, abs=2e-3)
        got = sorted(r.rate for r in mixing.with_rates(members, steps).collect())
        assert got == pytest.approx(sorted(rate))
    assert mixing.fit_rates(members.limit(0), [0.5, 0.3, 0.2]).pulls == []


def nearest_totals(p, tokens, target, weight, sweeps=4000):
    """Domain totals nearest to the target at rates of zero or more, by coordinate descent over the documents."""
    columns = (p * tokens[:, None]) * np.sqrt(weight)
    left = np.sqrt(weight) * target - columns.sum(axis=0)
    rate, size = np.ones(len(p)), (columns**2).sum(axis=1)
    for _ in range(sweeps):
        for k in np.flatnonzero(size):
            new = max(rate[k] + columns[k] @ left / size[k], 0.0)
            left -= (new - rate[k]) * columns[k]
            rate[k] = new
    return target - left / np.sqrt(weight)


@pytest.mark.parametrize("shares", [[0.5, 0.3, 0.2], [0.9, 0.09, 0.01], [0.0, 0.0, 1.0]])
def test_rates_reach_what_an_independent_solver_reaches(spark, shares):
    """Also where the targets are out of reach: no document is sure to be of one domain."""
    rng = np.random.default_rng(12)
    p = rng.dirichlet([2.0, 2.0, 2.0], 40)
    tokens = rng.integers(1, 500, 40)
    members = shipped(spark).createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p)], "n_tokens long, posterior array<double>")
    rate = mixing.fit_rates(members, shares, steps=400).rates(p)[0]  # the operator's own bound is mixing.STEPS
    now = tokens @ p
    target = np.array(shares) * now.sum()
    weight = 1 / now
    miss = lambda reached: float((reached - target) @ (weight * (reached - target))) / target.sum()
    assert (rate >= 0).all()
    assert miss((tokens * rate) @ p) <= miss(nearest_totals(p, tokens, target, weight)) + 1e-3


def test_the_sample_is_of_rows_and_copies_are_one(spark, monkeypatch):
    monkeypatch.setattr(quality, "POSITIVE_ROWS", 30)
    monkeypatch.setattr(quality, "UNLABELLED_ROWS", 30)
    texts = [(1, "the same text", "en")] * 500 + [(1, f"another text {k}", "en") for k in range(100)]
    texts += [(2, "far away", "en")] * 400 + [(k, f"words {k}", "en") for k in range(3, 90)]
    docs = frame(shipped(spark), texts).repartition(4)
    ids = spark.createDataFrame([(1,)], "doc_id long")
    sample = quality.training_rows(docs, ids, ids).collect()
    assert [sum(r.positive is want for r in sample) for want in (True, False)] == [30, 30]
    assert len({(r.id, r.tag) for r in sample}) == 60


def test_mixing_documents(spark):
    rng = random.Random(8)
    marks = {"clean": "", "toxic": " vile", "junk": " @@##"}
    rows, labels = [], []
    for i in range(300):
        domain = ("clean", "clean", "toxic", "junk")[i % 4]
        text = prose(rng, "en", 30)
        rows.append((i, text.upper() + "!!" if domain == "junk" else text + marks[domain], "en"))
        labels.append((i, domain))
    rows += [(None, None, None), (None, rows[0][1], "en"), (900, "", "en"), rows[4]]
    docs = frame(shipped(spark), rows).withColumn("rate", mixing.F.lit("old"))
    labelled = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, domain string")
    out = mixing.mix(docs, labelled, {"clean": 0.9, "junk": 0.05, "toxic": 0.05}, keep_text=True)
    got = out.collect()
    assert len(got) == len(rows) and set(docs.columns) <= set(out.columns)
    right = [r.domain == labels[r.doc_id][1] for r in got if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 3 == 0]
    assert np.mean(right) > 0.95
    p, tokens = np.array([r.posterior for r in got]), np.array([r.n_tokens for r in got])
    assert (tokens * [r.rate for r in got]) @ p / tokens.sum() == pytest.approx([0.9, 0.05, 0.05], abs=2e-3)
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    even = mixing.mix(docs, labelled.limit(0), {"a": 0.5, "b": 0.5}).collect()
    assert {tuple(r.posterior) for r in even} == {(0.5, 0.5)}
    assert mixing.mix(docs.limit(0), labelled, {"clean": 1.0}).count() == 0


def test_language_sample_among_copies_and_many_languages(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(language, "SAMPLE_ROWS", 40)
    monkeypatch.setattr(language, "train", lambda symbols, label, languages: seen.update(n=np.bincount(label) // language.SAMPLE_STRETCHES, names=languages))
    rows = shipped(spark).range(1000).selectExpr("concat('some text no ', id) as text", "'aa' as lang")
    copies = spark.range(30000).selectExpr("'one text' as text", "'aa' as lang")
    few = spark.range(8000).selectExpr("concat('few ', id % 50) as text", "'bb' as lang")
    many = spark.range(70).selectExpr("'a word' as text", "concat('l', id) as lang")
    language.fit(rows.union(copies).union(few).union(many))
    n = dict(zip(seen["names"], seen["n"].tolist()))
    assert len(n) == 72 and n["aa"] == 40 and n["bb"] == 40


def test_mixing_moves_whole_texts_in_small_batches(spark, monkeypatch):
    seen, real = [], scratch.written

    def noted(df):
        seen.append(int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return real(df)

    monkeypatch.setattr(scratch, "written", noted)
    docs = frame(shipped(spark), [(k, f"some words {k}", "en") for k in range(20)])
    labelled = spark.createDataFrame([(k, "clean" if k % 2 else "junk") for k in range(20)], "doc_id long, domain string")
    assert mixing.mix(docs, labelled, {"clean": 0.5, "junk": 0.5}, keep_text=True).count() == 20
    assert seen == [mixing.TEXTS_AT_ONCE]
