"""Benchmark leaks, exact top-k search and token counts against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from ledgerline.llm import decontamination, metric_tree, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def multiset(words):
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def leaks_by_force(rows, items):
    found = {}
    for i, text in rows:
        words = (text or "").lower().split()
        for j, item in items:
            own = (item or "").lower().split()
            wanted, best, count = multiset(own), None, 0
            for start in range(len(words) - len(own) + 1 if own else 0):
                here = multiset(words[start : start + len(own)])
                shared, total = sum((here & wanted).values()), sum((here | wanted).values())
                if 100 * shared >= 80 * total:
                    count += 1
                    if best is None or shared / total > best[0]:
                        best = (shared / total, start)
            if best:
                found[i, j] = (best[1], len(own), best[0], count)
    return found


def test_leaks_equal_brute_force(spark, docs_of):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(n))) for i, n in enumerate([3, 5, 6, 20, 20, 45, 90, 1])]
    items += [(50, None), (51, ""), (52, "rare " * 30), (None, "no id")]
    rows = []
    for i in range(60):
        body = [rnd.choice(words) for _ in range(rnd.randint(0, 120))]
        item = items[rnd.randrange(8)][1].split()
        if i % 3 and len(item) > 10:
            item[rnd.randrange(len(item))] = "changed"
        at = rnd.randint(0, len(body))
        rows.append((i, " ".join(body[:at] + (item if i % 2 else []) + body[at:])))
    rows += [(100, "a " + "rare " * 80), (101, None), (102, ""), (None, items[3][1])]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.find_leaks(docs_of(rows), frame).collect()
    expected = leaks_by_force([r for r in rows if r[0] is not None], [x for x in items if x[0] is not None])
    assert {(r.doc_id, r.item_id): (r.start, r.n_words, r.similarity, r.n_windows) for r in found} == expected


def test_documents_shorter_than_an_item_leak(spark, docs_of):
    item = [f"w{i}" for i in range(45)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "some other words that are here")], "item_id bigint, text string")
    rows = [(1, " ".join(item[:-1])), (2, " ".join(item[4:])), (3, " ".join(item[:30])), (4, "w0 w1 w2"), (5, " ".join(item))]
    found = {(r.doc_id, r.item_id): (r.start, r.n_words, r.similarity, r.n_windows) for r in decontamination.find_leaks(docs_of(rows), items).collect()}
    assert found == {(1, 1): (0, 44, 40 / 41, 1), (2, 1): (0, 41, 37 / 41, 1), (5, 1): (0, 45, 1.0, 1)}


def test_a_crowded_bitmap_changes_nothing(spark, docs_of, monkeypatch):
    assert decontamination.filter_size(0) == 1 << 20 and decontamination.filter_size(1 << 40) == 1 << 28
    assert all(32 * n <= decontamination.filter_size(n) <= 64 * n for n in (40_000, 1 << 20, 5_000_001, 1 << 23))
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(n))) for i, n in enumerate([3, 12, 25, 25, 40])]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(30)) + " " + items[i % 5][1]) for i in range(20)]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    for limits in ((8, 8), (64, 64), (1 << 20, 1 << 28)):  # the first two are full or nearly so
        monkeypatch.setattr(decontamination, "FILTER_BITS", limits)
        found = decontamination.find_leaks(docs_of(rows), frame).collect()
        assert {(r.doc_id, r.item_id): (r.start, r.n_words, r.similarity, r.n_windows) for r in found} == leaks_by_force(rows, items)


def test_leaks_of_odd_tables(spark, docs_of, odd_rows):
    items = spark.createDataFrame([(1, "the cat sat on the mat")], "item_id bigint, text string")
    assert [(r.doc_id, r.start) for r in decontamination.find_leaks(docs_of(odd_rows), items).collect()] == [(1, 0)]
    assert decontamination.find_leaks(docs_of(odd_rows), items.limit(0)).count() == 0
    assert decontamination.find_leaks(docs_of([]), items).count() == 0


def top_by_force(rows, k, every):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault(i, [math.floor(64 * float(np.float32(x))) for x in v])
    out = {}
    for q, a in usable.items():
        if q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable.items() if i != q and len(b) == len(a)]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(metric_tree, "SHARD_ROWS", 150)
    monkeypatch.setattr(metric_tree, "BLOCK_QUERIES", 20)
    monkeypatch.setattr(metric_tree, "REGION_ROWS", 50)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] * (i % 5) + rng.normal(size=8) / 5]) for i in range(400)]
    rows += [(400 + i, [0.5] * 8) for i in range(150)]  # copies, so ties
    rows += [(1000, None), (1020, []), (1040, [1.0, None]), (1060, [float("nan")] * 8), (1080, [float("inf")] * 8)]
    rows += [(1100, [1.0, 2.0]), (1120, [3.0, -1.0]), (None, [1.0] * 8), (0, rows[0][1])]
    frame = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], "vec_id bigint, embedding array<float>, shard int, rank string")
    found = metric_tree.top_inner_products(frame).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = {q: best for q, best in top_by_force(rows, 20, 20).items() if best}
    assert got == expected
    assert metric_tree.top_inner_products(frame.limit(0)).count() == 0


def test_queries_skip_regions_and_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(metric_tree, "REGION_ROWS", 20)
    monkeypatch.setattr(metric_tree, "SHARD_ROWS", 100)
    monkeypatch.setattr(metric_tree, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    rows = [(i, [float(x) for x in centres[i % 30] + rng.normal(size=16) / 40]) for i in range(1200)]
    rows += [(1200 + i, rows[0][1]) for i in range(600)]  # a third of all rows in one region
    rows += [(1800, [1.0, 2.0, 3.0]), (1820, [2.0, 1.0, 0.0])]  # no pivot need have this length
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {}
    for r in metric_tree.top_inner_products(frame).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == top_by_force(rows, 20, 20)

    once = frame.mapInArrow(metric_tree._quantised(64.0), "vec_id bigint, dim int, norm double, vector binary").where("dim = 16")
    routes, _, pages = metric_tree.routed_queries(once, 1800, 20, 20)
    shards, queries = pages.select("dim", "region", "part").distinct().count(), 90
    assert shards > 30
    assert queries + routes.count() < queries * shards / 3


def test_trees_of_deep_shards_are_exact(monkeypatch):
    monkeypatch.setattr(metric_tree, "PAGE", 64)  # several levels
    rng = np.random.default_rng(8)
    vectors = np.floor(64 * rng.normal(size=(3000, 6)))
    vectors[1000:1600] = vectors[0]
    import pandas as pd

    pages = pd.DataFrame(metric_tree.build_tree(np.arange(3000), vectors))
    tree = metric_tree.Tree(pages, 6)
    assert (pages.parent < pages.node).all() and sum(map(len, pages["ids"])) == 3000
    for q in range(0, 3000, 250):
        ids, scores = tree.top(vectors[q], q, 20)
        exact = sorted(((-float(v @ vectors[q]), i) for i, v in enumerate(vectors) if i != q))[:20]
        assert [(-s, i) for s, i in zip(scores, ids, strict=True)] == exact


def count_by_force(word, scores):
    text, longest = token_counts.MARK + word, max(map(len, scores))
    low = min(scores.values()) - 1
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        n = len(text[end - 1].encode())
        options = [(best[end - 1][0] + n * low, best[end - 1][1] - n)]
        for start in range(max(0, end - longest), end):
            if text[start:end] in scores:
                options.append((best[start][0] + scores[text[start:end]], best[start][1] - 1))
        best.append(max(options))
    return -best[-1][1]


def test_token_counts_equal_brute_force(docs_of, odd_rows, monkeypatch):
    monkeypatch.setattr(token_counts, "NODES", 40)  # the trie starts afresh many times
    scores = token_counts.unigram_scores(open(MODEL, "rb").read())
    rows = [*odd_rows, (20, "internationalisation internationally über 日本語 x1y2z3"), (21, "a" * 300)]
    found = token_counts.count_tokens(docs_of(rows), MODEL).collect()
    expected = sorted((len((t or "").split()), sum(count_by_force(w, scores) for w in (t or "").split())) for _, t in rows if _ != 6)
    assert sorted((r.n_pretokens, r.n_tokens) for r in found if r.doc_id != 6) == expected
    long = next(r for r in found if r.doc_id == 6)
    assert long.n_tokens == 60_000 * count_by_force("word", scores)
    assert token_counts.count_tokens(docs_of([]), MODEL).count() == 0


def test_shared_prefixes_are_scored_once():
    trie = token_counts.PrefixTrie({"▁a": -1.0, "ab": -1.5, "b": -2.0, "▁": -3.0})
    trie.add("abab")
    nodes = len(trie.best)
    trie.add("abba")
    assert len(trie.best) == nodes + 2 and trie.counts["abab"] == 3


def test_long_words_and_crowded_documents_leave_the_trie_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "NODES", 2_000)
    monkeypatch.setattr(token_counts, "_PART", 16)
    scores = token_counts.unigram_scores(open(MODEL, "rb").read())
    rnd = random.Random(8)
    alphabet = "abcdeinorst▁é日😀"
    words = ["".join(rnd.choices(alphabet, k=rnd.choice((1, 5, 30, 254, 255, 256, 257, 600)))) for _ in range(120)]
    trie, largest = token_counts.PrefixTrie(scores), 0
    for first in range(0, len(words), 40):
        part = words[first : first + 40] * 2
        assert trie.total(part) == sum(count_by_force(w, scores) for w in part)
        largest = max(largest, len(trie.best))
    assert largest <= 2_000 + 16 * token_counts.LONG
    trie.clear()
    assert trie.total(["x" * 300_000]) > 0 and len(trie.best) == 1


def test_scores_beyond_64_bits_are_refused(spark):
    fits = spark.createDataFrame([(i, [float(i), 1e7]) for i in range(30)], "vec_id bigint, embedding array<double>")
    assert metric_tree.top_inner_products(fits).count() == 40
    for large in (1e12, 1e200):
        frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [large, 0.0])], "vec_id bigint, embedding array<double>")
        with pytest.raises(ValueError, match="64 bits"):
            metric_tree.top_inner_products(frame)
