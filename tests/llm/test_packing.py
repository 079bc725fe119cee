from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def sequences_one_by_one(lengths, capacity):
    """Best-fit decreasing, a piece at a time, looking at every open sequence."""
    room = []
    for length in sorted(lengths, reverse=True):
        fitting = [(r, i) for i, r in enumerate(room) if r >= length]
        if fitting:
            room[min(fitting)[1]] -= length
        else:
            room.append(capacity - length)
    return len(room)


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_placing_piece_by_piece(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([1, 10, 37, 100])
    lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 150))]
    runs, sequences = packing.best_fit_decreasing(Counter(lengths), capacity)
    assert sequences == sequences_one_by_one(lengths, capacity)
    used = Counter()
    placed = Counter()
    for run in runs:
        for rank in range(run.first, run.last):
            at = rank - run.first
            sequence, offset = run.sequence + at // run.each, run.offset + at % run.each * run.length
            placed[run.length] += 1
            for token in range(offset, offset + run.length):
                used[sequence, token] += 1
    assert placed == Counter(lengths) and set(used.values()) <= {1}
    assert max((t for _, t in used), default=0) < capacity


def test_a_piece_that_fits_nowhere_is_refused():
    with pytest.raises(ValueError, match="does not fit"):
        packing.best_fit_decreasing({11: 1}, 10)


def test_ids_equal_those_of_the_tokenizer(monkeypatch):
    definition = open(PATH, encoding="utf-8").read()
    tokenizer = Tokenizer.from_str(definition)
    rnd = random.Random(3)
    parts = ["a", "B", "é", "É", " ", "\n", "\t", "'s", ".", ",", "!!", "12", "İ", "Σ", "ς", "<|endoftext|>", "<|EndOfText|>",
             "ß", "́", "\xa0", "\x85", "日本", "º", "Å", "😀", "a.b", "\r\n", "​", "ﬁ", "the,", "x" * 80]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 50))) for _ in range(1500)]
    for limit in (packing.CACHED_WORDS, 300):  # the small memory forgets words in between
        monkeypatch.setattr(packing, "CACHED_WORDS", limit)
        found = [ids for k in range(0, len(texts), 50) for ids in packing.token_bytes(texts[k : k + 50], definition)]
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_documents_come_back_whole(docs_of, odd_rows):
    packed = packing.pack_documents(docs_of(odd_rows), PATH, max_tokens=512).toPandas()
    tokenizer = Tokenizer.from_file(PATH)
    expected = Counter()
    for _, text in odd_rows:
        expected[tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (0,)] += 1
    rebuilt = Counter()
    for row in packed[packed.length < 512].itertuples():  # every document here ends in a short piece
        if row.piece == 0:
            rebuilt[tuple(np.frombuffer(row.ids, "<u4").tolist())] += 1
    long = packed[packed.doc_id == 6].sort_values("piece")
    assert list(long.start) == [512 * i for i in range(len(long))]
    rebuilt[tuple(np.frombuffer(b"".join(long.ids), "<u4").tolist())] += 1
    assert rebuilt == expected
    assert all(zlib.crc32(row.ids) == row.ids_crc32 and len(row.ids) == 4 * row.length for row in packed.itertuples())
    for _, group in packed.sort_values("offset").groupby("sequence_id"):
        assert list(group.offset) == [0, *group.length.cumsum()[:-1]] and group.length.sum() <= 512
    assert packed.sequence_id.nunique() == sequences_one_by_one(list(packed.length), 512)


def test_pieces_without_ids_are_the_same(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    whole = packing.pack_documents(docs, PATH, max_tokens=512).drop("ids", "sequence_id", "offset")
    light = packing.pack_documents(docs, PATH, max_tokens=512, with_ids=False)
    assert "ids" not in light.columns
    assert sorted(map(str, light.drop("sequence_id", "offset").collect())) == sorted(map(str, whole.collect()))


def test_no_documents(docs_of):
    assert packing.pack_documents(docs_of([]), PATH).count() == 0
