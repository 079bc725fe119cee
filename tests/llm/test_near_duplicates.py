from __future__ import annotations

import random

import numpy as np

from ledgerline.llm import near_duplicates as nd
from ledgerline.llm.components import connected_components


def shingle_set(text, n):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split() if w]
    if len(words) >= n:
        return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def components_by_force(rows, n, percent):
    sets = {i: shingle_set(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {i: (len(sets[i]), top(i)) for i in sets}


def test_groups_equal_brute_force(docs_of):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows, base = [], [rnd.choice(words) for _ in range(60)]
    for i in range(60):  # a chain of edits, with copies
        base = list(base)
        if i % 3:
            base[rnd.randrange(60)] = rnd.choice(words)
        rows.append((i, " ".join(base)))
    for i in range(60, 120):
        rows.append((i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30)))))
    rows += [(200, "Short text"), (201, "short\tTEXT"), (202, "short"), (203, None), (204, "")]
    rnd.shuffle(rows)
    for n in (4, 5):
        found = nd.near_duplicate_groups(docs_of(rows), shingle_words=n).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components_by_force(rows, n, 80)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_odd_rows(docs_of, odd_rows):
    found = nd.near_duplicate_groups(docs_of(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    assert all(r.kept and r.component_id == r.doc_id for r in found)
    assert {r.doc_id: r.n_shingles for r in found if r.doc_id} == {1: 8, 2: 0, 3: 0, 4: 0, 5: 1, 6: 1, 7: 1}
    assert nd.near_duplicate_groups(docs_of([])).count() == 0


def test_estimate_is_close_and_corrected_for_chance(spark):
    rnd = np.random.default_rng(1)
    for share in (0.0, 0.5, 0.8, 1.0):
        shared, own = int(2000 * share), 2000 - int(2000 * share)
        pool = rnd.integers(0, 2**63, 4000).astype(np.uint64)
        a, b = pool[: shared + own // 2], np.concatenate([pool[:shared], pool[2000 : 2000 + own // 2]])
        values, bounds = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        packed = nd.signatures(nd.minima(values, bounds)).view(np.int64).tolist()
        frame = spark.createDataFrame([tuple(packed)], "a array<bigint>, b array<bigint>")
        found = frame.select(nd.estimate(frame.a, frame.b)).first()[0]
        true = shared / (shared + 2 * (own // 2))
        assert abs(found - true) < 0.2 and found >= nd.lowest_estimate(true)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    odd = [(7, 7), (None, 3), (140, 139), (139, 140)]
    links = spark.createDataFrame(chain + star + odd, "a bigint, b bigint")
    found = {r.node: r.component for r in connected_components(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 141), 100)}
    assert connected_components(links.limit(0)).count() == 0


def test_ids_that_repeat_with_other_texts(docs_of):
    rnd = random.Random(6)
    a, b = ([f"{c}{rnd.randrange(10**6)}" for _ in range(200)] for c in "ab")
    rows = [(5, " ".join(a)), (5, " ".join(b)), (8, " ".join([*a, "x"])), (9, " ".join([*b, "x"])), (7, "some other words here now")]
    found = nd.near_duplicate_groups(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == [
        (5, 5, True), (5, 5, True), (7, 7, True), (8, 5, False), (9, 5, False),
    ]


def test_buckets_without_any_link_are_measured(docs_of, monkeypatch):
    """A hot bucket whose members share half their text: no leader pair is a candidate, and blocks are used."""
    monkeypatch.setattr(nd, "LARGE_BUCKET", 5)
    monkeypatch.setattr(nd, "BLOCK", 8)
    monkeypatch.setattr(nd, "lowest_estimate", lambda similarity: 2.0)
    rnd = random.Random(2)
    half = " ".join(f"h{rnd.randrange(10**6)}" for _ in range(120))
    rows = [(i, f"{half} {' '.join(f'w{rnd.randrange(10**6)}' for _ in range(40))}") for i in range(40)]
    rows += [(100 + i, f"{text} end") for i, text in rows[:3]]
    found = nd.near_duplicate_groups(docs_of(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components_by_force(rows, 5, 80)
