"""Language identification, toxicity and importance resampling: held-out accuracy."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import importance, language, toxicity
from ledgerline.sources import read_parquet

SMALL = "/root/testdata/sf0.01"


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(40):
        firsts = np.concatenate([[0], np.cumsum(rng.integers(0, 7, 5))])
        scores = rng.normal(size=(firsts[-1], 3)) * 3
        path = language.viterbi(scores, firsts, 1.5)
        for a, b in itertools.pairwise(firsts):

            def value(states, a=a):
                return sum(scores[a + i, s] for i, s in enumerate(states)) - 1.5 * sum(
                    x != y for x, y in itertools.pairwise(states)
                )

            best = max(map(value, itertools.product(range(3), repeat=b - a)))
            assert value(path[a:b]) == pytest.approx(best)


def test_languages_held_out(spark):
    docs = read_parquet(spark, f"{SMALL}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    found = language.identify_languages(docs).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out]
    assert np.mean(held) > 0.98


def test_spans_of_mixed_text(docs_of):
    english, greek, french = "the cat and the dog went to the house", "αυτό είναι ένα σπίτι", "le chat et le chien dans la maison"
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(english, "en"), (greek, "el"), (french, "fr")] * 20)]
    text = f"{english}. {greek} 12 {french}!"
    found = language.identify_languages(docs_of([*rows, (900, text, None)])).where("doc_id = 900").first()
    assert [(text[s.start : s.end], s.lang) for s in found.spans] == [(english, "en"), (greek, "el"), (french, "fr")]


def test_language_of_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    found = language.identify_languages(docs).collect()
    assert len(found) == len(odd_rows)
    assert {(r.lang_pred, r.score) for r in found if r.doc_id in (2, 3, 4)} == {("und", 0.0)}
    nothing = language.identify_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language.identify_languages(docs_of([])).count() == 0


def test_toxicity_held_out(spark):
    docs = read_parquet(spark, "/root/testdata/sf0.1/documents.parquet")
    labels = read_parquet(spark, "/root/testdata/sf0.1/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    found = toxicity.score_toxicity(docs, labels).collect()
    held = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in held]) > 0.94
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in found)


def test_toxicity_of_odd_rows(spark, docs_of, odd_rows):
    labels = spark.createDataFrame([(1, 1), (5, 1), (6, 0), (7, None), (None, 1)], "doc_id bigint, toxic int")
    found = toxicity.score_toxicity(docs_of(odd_rows), labels).collect()
    assert len(found) == len(odd_rows) and len({r.score for r in found if r.doc_id in (2, 3, 4)}) == 1
    none = toxicity.score_toxicity(docs_of(odd_rows), labels.limit(0)).collect()
    assert all(r.score < 1e-6 and r.predicted == 0 for r in none)
    assert toxicity.score_toxicity(docs_of([]), labels).count() == 0


def test_toxicity_without_a_training_document(spark, docs_of):
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id bigint, toxic int")
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0]
    for rows in ([(i, "some words") for i in held], [(None, "some words"), (None, None)]):
        found = toxicity.score_toxicity(docs_of(rows), labels).collect()
        assert len(found) == len(rows) and all(r.score < 1e-6 and r.predicted == 0 for r in found)


def test_positive_unlabelled_risk_separates():
    rng = np.random.default_rng(0)
    noise = lambda: rng.integers(100, 5000, 30)
    positive = [np.unique(np.append(noise(), 7)) for _ in range(200)]
    unlabelled = [np.unique(np.append(noise(), 7) if i % 10 == 0 else noise()) for i in range(1000)]
    weights = toxicity.nnpu_weights(positive, unlabelled, 0.1)
    assert weights[7] + weights[-1] > 0 > weights[-1]


def test_boundary_equals_trying_every_cut():
    rng = np.random.default_rng(3)
    for _ in range(50):
        positive = np.round(rng.normal(2, 1, rng.integers(1, 60)), 1)
        every = np.round(rng.normal(0, 1.5, rng.integers(1, 300)), 1)
        cuts, recall = toxicity._cuts(positive)
        halves = [toxicity._histogram(cuts, half) for half in np.array_split(every, 2)]
        merged = sum(n for n, _ in halves), np.maximum(*[top for _, top in halves])
        tried = [(np.mean(positive >= c) ** 2 / max(np.mean(every >= c), 1 / len(every)), -c) for c in cuts]
        best = -max((round(value, 12), cut) for value, cut in tried)[1]
        below = every[every < best]
        assert toxicity.boundary(cuts, recall, *merged) == pytest.approx((best + (below.max() if len(below) else best)) / 2)


def test_word_counts_and_useful_words(spark, docs_of):
    rng = random.Random(4)
    vocabulary = [f"w{chr(97 + i)}" for i in range(26)]
    texts = [" ".join(rng.choices(vocabulary[: 1 + i % 26], k=rng.randint(0, 30))) for i in range(300)]
    frame = docs_of(list(enumerate(texts))).repartition(5).select("text")
    rows = frame.mapInArrow(toxicity._document_counts, "bucket bigint, n bigint").groupBy("bucket").sum("n").collect()
    counts = {r[0]: r[1] for r in rows}
    assert counts.pop(-1) == 300
    expected = {w: sum(w in text.split() for text in texts) for w in vocabulary}
    assert sorted(counts.values()) == sorted(n for n in expected.values() if n)
    seen = np.array([0, 0, 1000, 1000, 100_000, 50])
    inside = np.array([3, 4, 30, 10, 990, 0])
    # 1,000 positives of a million texts: 0, 0, 1, 1, 100 and 0.05 expected.
    assert list(toxicity.useful_words(inside, 1000, seen, 1_000_000)) == [1, 2, 3, 4]


def test_gradient_of_the_risk_lowers_it():
    """One step on a whole small batch equals the numeric gradient's first Adam step."""
    positive = [np.array([1, 2]), np.array([2]), np.array([2, 3])]
    unlabelled = [np.array([1]), np.array([3]), np.array([2, 3]), np.array([1, 3])]
    prior = 0.3

    def risk(weights, bias):
        margin = lambda rows: np.array([bias + weights[r].sum() for r in rows])
        p, u = margin(positive), margin(unlabelled)
        clean = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        return prior * np.logaddexp(0, -p).mean() + clean if clean >= 0 else -clean

    one = toxicity.nnpu_weights(positive, unlabelled, prior, epochs=1, batches=1, rate=0.01, decay=0.0, deviations=0.0)
    start, e = np.zeros(4), 1e-6
    for word in (1, 2, 3):
        moved = start.copy()
        moved[word] = e
        slope = (risk(moved, -2.0) - risk(start, -2.0)) / e
        assert one[word] == pytest.approx(-0.01 * np.sign(slope), abs=1e-4)


def test_kth_largest(spark):
    values = [5, -3, 2**62, -(2**62), 0, 5, 5, -(2**63), 2**63 - 1]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    for k in range(1, len(values) + 1):
        assert importance.kth_largest(rows, "v", k) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(rows, "v", len(values) + 1) is None


def test_order_of_doubles_is_kept():
    keys = np.array([-np.inf, -2.5, -1e-300, 0.0, 1e-300, 3.0, np.inf])
    assert (np.diff(importance.ordered_bits(keys)) > 0).all()


def test_importance_sample(spark):
    docs, labels = read_parquet(spark, f"{SMALL}/documents.parquet"), read_parquet(spark, f"{SMALL}/labels.parquet")
    found = importance.importance_sample(docs, labels).collect()
    keys = sorted((r.sample_key for r in found), reverse=True)
    assert {r.selected for r in found if r.sample_key >= keys[len(found) // 2 - 1]} == {True}
    assert sum(r.selected for r in found) == len(found) // 2
    good = {r.doc_id: r.quality for r in labels.collect()}
    kept = {q: np.mean([r.selected for r in found if good.get(r.doc_id) == q]) for q in (0, 1)}
    assert kept[1] > kept[0] + 0.5
    assert {r.doc_id for r in importance.importance_sample(docs, labels).where("selected").collect()} == {
        r.doc_id for r in found if r.selected
    }


def test_log_weights_equal_counting(docs_of, spark):
    rows = [(1, "a b c"), (2, "a b"), (3, "x y z x"), (4, "")]
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id bigint, quality int")
    grams = {i: t.split() + [" ".join(p) for p in itertools.pairwise(t.split())] for i, t in rows}
    raw, target = [g for gs in grams.values() for g in gs], grams[1]
    n = importance.BUCKETS

    def ratio(g):
        return np.log((target.count(g) + 1) / (len(target) + n)) - np.log((raw.count(g) + 1) / (len(raw) + n))

    for r in importance.importance_sample(docs_of(rows), labels).collect():
        assert r.log_weight == pytest.approx(sum(map(ratio, grams[r.doc_id])))


def test_bucket_counts_move_buckets_not_texts(spark, docs_of, odd_rows, plan_of):
    good = spark.createDataFrame([(1,), (5,), (5,), (6,), (None,), (99,)], "doc_id bigint")
    found = importance.bucket_counts(docs_of(odd_rows).select("doc_id", "text"), good)
    plan = plan_of(found)
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan  # the same plan for few and many ids
    assert plan.index("ShuffledHashJoin") < plan.index("hashpartitioning(doc_id") < plan.rindex("MapInArrow")
    raw, target = np.zeros(importance.BUCKETS, int), np.zeros(importance.BUCKETS, int)
    for i, text in odd_rows:
        buckets, _ = importance.hashed_ngrams([(text or "").encode()])
        np.add.at(raw, buckets, 1)
        np.add.at(target, buckets, int(i in (1, 5, 6)))
    rows = found.collect()
    assert sorted(r.bucket for r in rows) == list(range(importance.BUCKETS))
    assert all((r.raw, r.target) == (raw[r.bucket], target[r.bucket]) for r in rows)
    assert raw.sum() > target.sum() > 0


def test_importance_of_odd_rows(spark, docs_of, odd_rows):
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    found = importance.importance_sample(docs_of(odd_rows), labels, fraction=1.0).collect()
    assert len(found) == len(odd_rows) and all(r.selected for r in found)
    assert {r.log_weight for r in found if r.doc_id in (2, 3, 4)} == {0.0}
    assert importance.importance_sample(docs_of([]), labels).count() == 0
