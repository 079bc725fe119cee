from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from ledgerline.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error string, parts int, dim int, _v int"


@pytest.fixture
def vectors_of(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, label, "c", "e", 1, 2, 3) for i, v, label in rows], SCHEMA)

    return build


def by_force(rows, dim, rounds=2, entries=64):
    usable = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    bounds = vc.part_bounds(dim)
    books = [[v[a:b] for _, v, _ in usable[:entries]] for a, b in bounds]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for (a, b), book in zip(bounds, books, strict=True):
            members = {}
            for _, v, _ in usable:
                members.setdefault(nearest(v[a:b], book)[1], []).append(v[a:b])
            for k, parts in members.items():
                book[k] = [sum(c) // len(parts) for c in zip(*parts, strict=True)]
    out, totals = [], {}
    for i, v, label in usable:
        found = [nearest(v[a:b], book) for (a, b), book in zip(bounds, books, strict=True)]
        error = sum(d for d, _ in found)
        totals[label] = totals.get(label, 0) + error
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), error))
    text = ",".join(str(x) for book in books for e in book for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((*r, totals[r[1]], sha) for r in out), key=repr)


@pytest.mark.parametrize("dim", [16, 64, 40])
def test_codes_equal_brute_force(vectors_of, dim):
    random = np.random.default_rng(dim)
    centres = random.normal(0, 0.2, (9, dim))
    rows = [
        (int(i), [float(x) for x in centres[i % 9] + random.normal(0, 0.05, dim)], int(i % 4) if i % 5 else None)
        for i in random.permutation(400)
    ]
    rows += [(900 + i, rows[0][1], 1) for i in range(40)]  # copies tie at every entry
    rows += [(1, rows[5][1], 2), (None, rows[6][1], 3)]
    found = vc.compress_vectors(vectors_of(rows))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == by_force(rows, dim)


def test_cells_keep_every_nearest_entry(monkeypatch):
    random = np.random.default_rng(3)
    monkeypatch.setattr(vc, "MEMO_CELLS", 50)
    for width in (1, 3, 200):
        book = random.integers(-300, 300, (64, 4))
        book[10] = book[3]  # equal entries: the lower index wins
        points = np.concatenate([random.integers(-400, 400, (3000, 4)), book])
        memory = vc.CellMemory(book)
        memory.width = width
        apart = ((points[:, None] - book[None]) ** 2).sum(axis=2)
        for _ in range(2):
            codes, errors = memory.nearest(points)
            assert (codes == apart.argmin(axis=1)).all() and (errors == apart.min(axis=1)).all()


def test_odd_vectors(vectors_of):
    good = [0.1 * (k % 7) for k in range(32)]
    rows = [
        (1, good, 1), (1, good, None), (2, None, 1), (3, [*good[:-1], None], 1), (4, [*good[:-1], float("nan")], 1),
        (5, [*good[:-1], float("inf")], 1), (6, [], 2), (None, good, None),
    ]
    found = vc.compress_vectors(vectors_of(rows)).collect()
    assert sorted((r.vec_id or 0, r.code, r.error) for r in found) == [
        (0, "00" * 16, 0), (1, "00" * 16, 0), (1, "00" * 16, 0), (6, "00" * 16, 0),
    ]
    assert vc.compress_vectors(vectors_of([])).collect() == []
    with pytest.raises(ValueError, match="64-bit"):
        vc.compress_vectors(vectors_of([(1, [1e30] * 16, 1)]))
