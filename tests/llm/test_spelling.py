from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from ledgerline.llm import spelling


def one_edit(word, other):
    if len(word) == len(other):
        return sum(a != b for a, b in zip(word, other, strict=True)) == 1
    short, long = sorted((word, other), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_force(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode("utf-8"))
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    forms, near = {}, {}
    for word in counts:
        near[word] = [o for o in counts if one_edit(word, o)]
        best = min(near[word], key=lambda o: (-counts[o], o), default=None)
        forms[word] = best if best and counts[best] >= 2 * counts[word] else None
    out = {}
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        out[word] = (n, len(near[word]), forms[word], counts.get(forms[word]), root)
    return out


def varied_texts(seed, letters):
    """Few letters, so that words collide, bigrams repeat within words and chains of forms arise."""
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(4, 9))) for _ in range(40)]
    rows = []
    for i in range(250):
        words = []
        for _ in range(30):
            word = base[min(int(rnd.expovariate(0.15)), 39)]
            while rnd.random() < 0.35:
                k, c = rnd.randrange(len(word) + 1), rnd.choice(letters)
                word = rnd.choice([word[:k] + c + word[k:], word[:k] + word[k + 1 :], word[:k] + c + word[k + 1 :]]) or "a"
            words.append(word.upper() if rnd.random() < 0.1 else word)
        rows.append((i, rnd.choice([" ", ", ", "-", "1"]).join(words)))
    return rows


@pytest.mark.parametrize(("seed", "letters"), [(1, "ab"), (2, "abcé"), (3, "aeinrstÿÉ")])
def test_words_equal_brute_force(docs_of, seed, letters):
    rows = varied_texts(seed, letters)
    found = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(docs_of(rows)).collect()}
    expected = by_force(rows)
    assert found == expected
    assert any(v[4] not in (w, v[2]) for w, v in expected.items())  # some chain has two steps


def test_pivots_are_the_cheapest_disjoint_grams():
    rnd = random.Random(3)
    for _ in range(500):
        places = sorted(rnd.sample(range(12), rnd.randint(3, 7)))
        costs = [rnd.randint(1, 9) for _ in places]
        chosen = spelling.pivots(places, costs)
        price = dict(zip(places, costs, strict=True))
        best = min(price[a] + price[b] for a in places for b in places if a + 2 <= b)
        assert chosen[0] + 2 <= chosen[1] and sum(price[p] for p in chosen) == best


def test_every_near_word_stands_under_an_asked_key():
    rnd = random.Random(9)
    for _ in range(3000):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(5, 9)))
        k, c = rnd.randrange(len(word)), rnd.choice("abcd")
        other = rnd.choice([word[:k] + c + word[k:], word[:k] + word[k + 1 :], word[:k] + c + word[k + 1 :], word + c])
        if len(other) < 5 or other == word:
            continue
        lengths = {x + y: rnd.randint(1, 50) for x in "abcd" for y in "abcd"}
        met = False
        for one, two in ((word, other), (other, word)):
            held = spelling.held_keys(two, spelling.gram_prefix(two, lengths)[1])
            met |= any(
                key in held and two.startswith(start) and two.endswith(end)
                for key, start, end in spelling.asked_keys(one, *spelling.gram_prefix(one, lengths)[0])
            )
        assert met


def test_counts_are_handed_on_in_parts(docs_of, monkeypatch):
    rows = varied_texts(4, "abc")
    monkeypatch.setattr(spelling, "FLUSH", 10)
    monkeypatch.setattr(spelling, "LONG_TEXT", 50)
    found = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(docs_of(rows)).collect()}
    assert found == by_force(rows)


def test_odd_rows(docs_of, odd_rows):
    rows = [*odd_rows, *[(None, "colour color"), (50, "colour colour color"), (51, "COLOUR colour×x color color")]]
    found = spelling.spelling_variants(docs_of(rows))
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found.collect()} == by_force(rows)
    assert spelling.spelling_variants(docs_of([])).collect() == []
