"""Word and shingle hashing over Arrow batches, as array operations.

Texts are handled as UTF-8 bytes. A word is a run of bytes other than space and
0x09-0x0D, with A-Z lower-cased. Words become 64-bit hashes and shingles are
combined from those, so no Python object exists per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts are gathered up to this size; a longer text is alone

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _random.integers(0, 2**64, 1024, dtype=np.uint64) | np.uint64(1)
_WORD = _random.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes between words: white space, or anything but letters.
WHITE_SPACE = _SPACE
LETTERS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of a column as bytes, null as empty: (first row, texts)."""
    texts = column.cast(pa.binary()) if pa.types.is_string(column.type) else column.cast(pa.large_binary())
    first, size, held = 0, 0, []
    for row, text in enumerate(texts.to_pylist()):
        text = text or b""
        if held and size + len(text) > CHUNK_BYTES:
            yield first, held
            first, size, held = row, 0, []
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def word_spans(
    texts: list[bytes], between: np.ndarray = WHITE_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts (each followed by a line break), word starts and ends
    in them, and for each text the index of its first word (one more at the end).
    """
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = ~between[data]
    edges = np.flatnonzero(np.diff(word))
    starts, ends = edges[0::2], edges[1::2]
    places = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(text) + 1 for text in texts], out=places[1:])
    return data, starts, ends, np.searchsorted(starts, places)


def hashed_words(texts: list[bytes], between: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and the first word of each text."""
    data, starts, ends, bounds = word_spans(texts, between)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), bounds
    lengths = ends - starts
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    letters = _LOWER[data[np.repeat(starts, lengths) + inside]]
    terms = _BYTE[letters] * _PLACE[inside & 1023]
    sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
    return mixed(sums + lengths.astype(np.uint64) * _WORD[63]), bounds


def shingles(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` words within a text, and the first one of each
    text. A text of fewer words gives one shingle, its whole sequence; a text
    without words gives none.
    """
    counts = np.diff(bounds)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    firsts = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=firsts[1:])
    total = int(firsts[-1])
    if not total:
        return np.zeros(0, dtype=np.uint64), firsts
    at = np.arange(total) + np.repeat(bounds[:-1] - firsts[:-1], sizes)
    width = np.repeat(np.minimum(counts, n), sizes)
    out = width.astype(np.uint64) * _WORD[62]
    last = len(words) - 1
    for j in range(n):
        term = words[np.minimum(at + j, last)] * _WORD[j]
        out += term if counts.min() >= n else np.where(j < width, term, np.uint64(0))
    return mixed(out), firsts


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed bigint, bit for bit."""
    return values.view(np.int64)
