from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from test_near_duplicates import components_by_force

from ledgerline.llm import jaccard_join as jj


def family(rnd, words, size, length, edits):
    """Texts of one family: a chain in which each has a few words of an earlier one replaced."""
    texts = [[rnd.choice(words) for _ in range(length)]]
    while len(texts) < size:
        text = list(rnd.choice(texts))
        for _ in range(rnd.randint(0, edits)):
            text[rnd.randrange(length)] = rnd.choice(words)
        texts.append(text)
    return [" ".join(t) for t in texts]


def documents(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = family(rnd, words, 70, 150, 4) + family(rnd, words, 30, 60, 2) + family(rnd, words, 40, 30, 1)
    passage = " ".join(rnd.choice(words) for _ in range(80))
    texts += [f"{passage} {' '.join(rnd.choice(words) for _ in range(rnd.randint(0, 12)))}" for _ in range(60)]
    texts += [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    texts += ["Short text", "short\tTEXT", "short", None, "", "  \n"]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "block", "n", "percent"), [(1, 64, 3, 90), (2, 4, 3, 90), (3, 4, 4, 80)])
def test_components_equal_brute_force(docs_of, monkeypatch, seed, block, n, percent):
    monkeypatch.setattr(jj, "BLOCK", block)
    monkeypatch.setattr(jj, "SLICE", 10)
    rows = documents(seed)
    found = jj.jaccard_components(docs_of(rows), shingle_words=n, percent=percent).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components_by_force(rows, n, percent)


def test_merge_skip_equals_counting():
    rnd = random.Random(8)
    for _ in range(300):
        lists = [sorted(rnd.sample(range(30), rnd.randint(1, 20))) for _ in range(rnd.randint(1, 9))]
        parts = [(values, rnd.randint(0, 2), len(values) - rnd.randint(0, 2)) for values in lists]
        seen = Counter(x for values, a, b in parts for x in values[a:b])
        enough = rnd.randint(1, 6)
        assert dict(jj.merge_skip(parts, enough)) == {x: c for x, c in seen.items() if c >= enough}


def test_search_equals_counting():
    rnd = random.Random(5)
    base = list(range(60))
    sets = []
    for _ in range(120):
        kept = rnd.sample(base, rnd.randint(40, 60))
        sets.append(sorted(kept + [rnd.randint(100, 400) for _ in range(rnd.randint(0, 6))]))
    sets = [np.unique(s) for s in sets]
    sizes = [len(s) for s in sets]
    for percent in (70, 90, 100):
        index = jj.InvertedLists(sets, sizes, percent)
        for s in sets:
            shared = [len(np.intersect1d(s, o)) for o in sets]
            expected = {i for i, c in enumerate(shared) if 100 * c >= percent * (len(s) + sizes[i] - c)}
            assert set(index.search(s, len(s))) == expected


def test_ids_that_repeat_with_other_texts(docs_of):
    rnd = random.Random(6)
    a, b = ([f"{c}{rnd.randrange(10**6)}" for _ in range(200)] for c in "ab")
    rows = [(5, " ".join(a)), (5, " ".join(b)), (8, " ".join([*a, "x"])), (9, " ".join([*b, "x"])), (7, "other words here")]
    found = jj.jaccard_components(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(5, 5), (5, 5), (7, 7), (8, 5), (9, 5)]


def test_odd_rows(docs_of, odd_rows):
    found = jj.jaccard_components(docs_of(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    assert all(r.component_id == r.doc_id for r in found)
    assert {r.doc_id: r.n_shingles for r in found if r.doc_id} == {1: 10, 2: 0, 3: 0, 4: 0, 5: 1, 6: 1, 7: 3}
    assert jj.jaccard_components(docs_of([])).count() == 0
