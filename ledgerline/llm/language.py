"""Languages of mixed-language text: scripts, word scores and Viterbi.

A word is a run of letters. The script of its first letter narrows the languages
to those that were seen in that script. Character n-grams score the word for each
of them, and Viterbi finds the most likely language of every word, where each
change costs a penalty; runs of one language are spans. The document's language
is the one with the most letters.

Texts are handled as arrays of code points, a batch at a time.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.words import mixed

UNDETERMINED = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
CHUNK_CHARS = 1 << 20
_POINTS = 0x110000
_random = np.random.Generator(np.random.PCG64(99))
_PLACE = _random.integers(0, 2**64, 8, dtype=np.uint64) | np.uint64(1)

#: First code points of stretches that belong to one script (others: 0).
SCRIPTS = [
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1780, "khmer"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2E80, "han"), (0x3040, "kana"), (0x3130, "hangul"), (0x3400, "han"), (0xAC00, "hangul"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0x20000, "han"),
]


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: is a letter or mark; its lower case; its script's number."""
    letter = np.zeros(_POINTS, dtype=bool)
    lower = np.arange(_POINTS, dtype=np.uint32)
    for point in range(_POINTS):
        char = chr(point)
        if unicodedata.category(char)[0] in "LM":
            letter[point] = True
            small = char.lower()
            lower[point] = ord(small) if len(small) == 1 else point
    names = sorted({name for _, name in SCRIPTS})
    script = np.zeros(_POINTS, dtype=np.uint8)
    for first, name in SCRIPTS:
        script[first:] = names.index(name) + 1
    return letter, lower, script


def letter_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts (each followed by a line break), starts and ends of
    words in them, and where each text begins.
    """
    data = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = _tables()[0][data]
    edges = np.flatnonzero(np.diff(word))
    places = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(text) + 1 for text in texts], out=places[1:])
    return data, edges[0::2], edges[1::2], places


def ngram_buckets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words, with the word each belongs to.

    Words get a border on both sides, which n-grams may hold at an end only.
    """
    lengths = ends - starts
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    owner = np.repeat(np.arange(len(starts)), lengths)
    row = np.ones(lengths.sum() + len(starts) + 1, dtype=np.uint64)
    at = np.arange(len(inside)) + owner + 1
    row[at] = _tables()[1][data[np.repeat(starts, lengths) + inside]]
    border = np.ones(len(row), dtype=bool)
    border[at] = False
    word = np.cumsum(border) - 1  # of a letter; a border belongs to the word before it
    word[border] -= 1
    buckets, owners = [], []
    for n in ORDERS:
        if len(row) < n:
            continue
        hashed = np.full(len(row) - n + 1, n, dtype=np.uint64)
        ok = np.ones(len(hashed), dtype=bool)
        for k in range(n):
            hashed += row[k : k + len(hashed)] * _PLACE[k]
            if 0 < k < n - 1 or n == 1:
                ok &= ~border[k : k + len(hashed)]
        if n == 2:
            ok &= ~(border[:-1] & border[1:])
        last = word[n - 1 :]
        ok &= last >= 0
        buckets.append((mixed(hashed[ok]) >> np.uint64(48)).astype(np.int64))
        owners.append(last[ok])
    return np.concatenate(buckets), np.concatenate(owners)


def _sliced(texts: list[str], order: list[int]) -> Iterator[list[int]]:
    """Row numbers in slices of about ``CHUNK_CHARS``."""
    held, size = [], 0
    for row in order:
        if held and size + len(texts[row]) > CHUNK_CHARS:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(texts[row])
    if held:
        yield held


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, bucket, n) for the whole task; scripts are buckets below 0."""
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            own = [row for row, other in enumerate(langs) if other == lang]
            total = found.setdefault(lang, np.zeros(BUCKETS + 256, np.int64))
            for rows in _sliced(texts, own):
                data, starts, ends, _ = letter_runs([texts[row] for row in rows])
                if len(starts):
                    buckets, _ = ngram_buckets(data, starts, ends)
                    total[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(_tables()[2][data[starts]], minlength=256)
    for lang, total in found.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(np.where(at < BUCKETS, at, BUCKETS - 1 - at)), pa.array(total[at])],
            names=["lang", "bucket", "n"],
        )


class Model:
    """Log probabilities of buckets and the scripts of each language."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray, script_share: float) -> None:
        self.langs = langs
        sums = counts.sum(axis=0, keepdims=True)
        scores = np.log((counts + 0.5) / (sums + 0.5 * BUCKETS))
        # Only differences between languages matter.
        middle = scores.mean(axis=1, keepdims=True) if langs else 0.0
        self.scores = (scores - middle).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=0, keepdims=True), 1)
        allowed = share >= script_share
        self.allowed = allowed | ~allowed.any(axis=1, keepdims=True)  # an unseen script narrows nothing

    def word_scores(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        buckets, owner = ngram_buckets(data, starts, ends)
        out = np.stack(
            [np.bincount(owner, self.scores[buckets, k], minlength=len(starts)) for k in range(len(self.langs))], axis=1
        )
        out[~self.allowed[_tables()[2][data[starts]]]] = -1e6
        return out


def viterbi(scores: np.ndarray, firsts: np.ndarray, penalty: float) -> np.ndarray:
    """Best state of every word; ``firsts``: where each text's words begin, and the end.

    All texts advance together, longest first, one word a step.
    """
    counts = np.diff(firsts)
    order = np.argsort(-counts, kind="stable")
    begins, counts = firsts[:-1][order], counts[order]
    path = np.zeros(len(scores), dtype=np.int64)
    if not len(scores):
        return path
    back = np.empty(scores.shape, dtype=np.int16)
    states = np.arange(scores.shape[1])
    active = np.searchsorted(-counts, -np.arange(1, counts[0] + 1), side="right")  # texts with a t-th word
    best = scores[begins[: active[0]]].copy()
    final = np.zeros(len(counts), dtype=np.int64)
    for t in range(1, counts[0]):
        n = active[t]
        if n < len(best):
            final[n : len(best)] = best[n:].argmax(axis=1)
            best = best[:n]
        top = best.argmax(axis=1)
        moved = best[np.arange(n), top] - penalty
        stay = best >= moved[:, None]
        at = begins[:n] + t
        back[at] = np.where(stay, states, top[:, None])
        best = np.where(stay, best, moved[:, None]) + scores[at]
    final[: len(best)] = best.argmax(axis=1)
    state = final
    for t in range(counts[0] - 1, -1, -1):
        n = active[t]
        at = begins[:n] + t
        path[at] = state[:n]
        if t:
            state[:n] = back[at, state[:n]]
    return path


def _spans(model, penalty: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, m = np.array(model.value.langs, dtype=object), model.value
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            # Texts of like length together, so that they end together.
            for rows in _sliced(texts, sorted(range(len(texts)), key=lambda row: -len(texts[row]))):
                data, starts, ends, places = letter_runs([texts[row] for row in rows])
                firsts = np.searchsorted(starts, places)
                path = viterbi(m.word_scores(data, starts, ends), firsts, penalty) if len(starts) and len(langs) else np.zeros(0, int)
                owner = np.repeat(np.arange(len(rows)), np.diff(firsts))[: len(path)]  # none without languages
                letters = np.zeros((len(rows), max(len(langs), 1)))
                if len(path):
                    np.add.at(letters, (owner, path), ends - starts)
                total = letters.sum(axis=1)
                top = letters.argmax(axis=1)
                name = [langs[k] if n else UNDETERMINED for k, n in zip(top, total, strict=True)]
                score = np.where(total > 0, letters.max(axis=1) / np.maximum(total, 1), 0.0)
                new = np.ones(len(path), dtype=bool)
                new[1:] = (path[1:] != path[:-1]) | (owner[1:] != owner[:-1])
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(path))[: len(head)] - 1
                bounds = np.searchsorted(owner[head], np.arange(len(rows) + 1))
                spans = pa.StructArray.from_arrays(
                    [
                        pa.array(starts[head] - places[owner[head]] if len(head) else [], pa.int64()),
                        pa.array(ends[tail] - places[owner[head]] if len(head) else [], pa.int64()),
                        pa.array(langs[path[head]].tolist() if len(head) else [], pa.string()),
                    ],
                    names=["start", "end", "lang"],
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(name, pa.string()), pa.array(score),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), spans)],
                    names=["doc_id", "lang_pred", "score", "spans"],
                )

    return run


def held_out(id_column: str = "doc_id") -> Column:
    """Documents that are never learned from: a quarter, by checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(
    docs: DataFrame,
    *,
    penalty: float = 12.0,
    script_share: float = 0.01,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, spans``.

    Learns n-gram counts from all documents with a language outside the held-out
    quarter. ``spans`` is an array of (start, end, lang) in code points, from the first
    to the last letter of a run of words. ``lang_pred`` has the most letters, ``score``
    is its share of them. A language is a candidate for a script from
    ``script_share`` of its words on. The model has one row of counts for each bucket and
    language, whatever the corpus size.

    Null texts and texts without a letter get ``und``, score 0 and no spans; so does
    every text if there is nothing to learn from. Null ids are predicted, not held
    out, and not learned from; repeated rows count each. An empty table gives an
    empty result. Other columns are not looked at.
    """
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    known = docs.where(~held_out(id_column)).where(
        F.col(id_column).isNotNull() & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()
    )
    sums = (
        known.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"))
        .mapInArrow(_counts, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    langs = sorted(sums.lang.unique())
    counts, scripts = np.zeros((BUCKETS, len(langs))), np.zeros((256, len(langs)))
    column = sums.lang.map({lang: k for k, lang in enumerate(langs)}).to_numpy(dtype=np.int64)
    bucket, n = sums.bucket.to_numpy(dtype=np.int64), sums.n.to_numpy(dtype=np.float64)
    plain = bucket >= 0
    counts[bucket[plain], column[plain]] = n[plain]
    scripts[-1 - bucket[~plain], column[~plain]] = n[~plain]
    model = docs.sparkSession.sparkContext.broadcast(Model(langs, counts, scripts, script_share))
    found = source.mapInArrow(
        _spans(model, penalty),
        "doc_id bigint, lang_pred string, score double, spans array<struct<start: bigint, end: bigint, lang: string>>",
    )
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "spans")
