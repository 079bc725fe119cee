"""Benchmark passages in documents, found by SimHash over item-sized windows.

Every item gets a SimHash of its word shingles, and so does a document's window
of as many words, at every place where it can matter: a window that shares too few
shingles with all items together cannot reach the similarity with any one of
them, and a bitmap of the items' shingles, sized by their number, tells. A document that is
shorter than an item but could still be similar to it is one window, the whole of it.
Windows and items meet through multi-index Hamming blocks: if two fingerprints differ in at most
``RADIUS`` bits, then in at least one of ``BLOCKS`` blocks they differ in at most
``RADIUS // BLOCKS``, so looking up each block with all values that near finds
every pair within the radius. Candidates are then confirmed by the exact weighted
similarity of their shingle multisets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words
from ledgerline.workspace import freeze

RADIUS = 19  # bits of 64; at similarity 0.8 about 9.7 differ, with a deviation of 2.9
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
BITS_A_SHINGLE = 32
FILTER_BITS = (1 << 20, 1 << 28)  # smallest and largest bitmap of item shingles: 128 KB and 32 MB

_MASKS = np.array(
    [0] + [sum(1 << i for i in c) for k in range(1, RADIUS // BLOCKS + 1) for c in combinations(range(BLOCK_BITS), k)],
    dtype=np.int32,
)


def simhash(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """SimHash of each run of shingle hashes (firsts: where runs begin, and the end).

    A shingle counts as often as it occurs, so its number is its weight.
    """
    out = np.zeros(len(firsts) - 1, dtype=np.uint64)
    sizes = np.diff(firsts)
    some = sizes > 0
    if not some.any():
        return out
    for bit in range(64):
        ones = np.add.reduceat((values >> np.uint64(bit)) & np.uint64(1), firsts[:-1][some])
        out[some] |= (2 * ones > sizes[some].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return out


def filter_size(shingles: int) -> int:
    """Bits of the bitmap: a power of two, 32 to 64 for each item shingle within the limits.

    At 32 bits 0.4 % of the shingles that no item has pass. Beyond 8 million item shingles the
    bitmap stays at 32 MB and more pass (1.4 % at 16 million, 16 % at 64 million): more windows are
    looked up then, the result is the same.
    """
    wanted = 1 << max(0, shingles * BITS_A_SHINGLE - 1).bit_length()
    return min(max(wanted, FILTER_BITS[0]), FILTER_BITS[1])


def _places(values: np.ndarray, bits: int) -> np.ndarray:
    """Two places in a bitmap of so many bits for each shingle."""
    mask = np.uint64(bits - 1)
    return np.stack([values & mask, (values >> np.uint64(32)) & mask]).astype(np.int64)


def _item_rows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in words.chunks(batch.column(1)):
                hashed, bounds = words.hashed_words(texts)
                values, firsts = words.shingles(hashed, bounds, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(np.diff(bounds)),
                        pa.array(words.signed(simhash(values, firsts))),
                        pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(words.signed(values))),
                    ],
                    names=["item_id", "n_words", "item_print", "item_shingles"],
                )

    return run


def _window_rows(n: int, percent: int, bitmap, lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            for first, texts in words.chunks(batch.column(1)):
                hashed, bounds = words.hashed_words(texts)
                found = {"row": [], "n_words": [], "start": [], "words": [], "print": [], "shingles": []}
                for width in range(1, n):  # items shorter than a shingle are one shingle
                    if width in lengths.value:
                        _windows(hashed, bounds, width, width, percent, table, [width], found)
                _windows(hashed, bounds, n, n, percent, table, [x for x in lengths.value if x >= n], found)
                sizes = [len(x) for x in found["shingles"]]
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = np.concatenate([*found["shingles"], np.zeros(0, np.uint64)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([first + row for row in found["row"]], pa.int64())),
                        pa.array(found["n_words"], pa.int64()),
                        pa.array(found["start"], pa.int64()),
                        pa.array(found["words"], pa.int64()),
                        pa.array(words.signed(np.array(found["print"], np.uint64)), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(words.signed(flat), pa.int64())),
                    ],
                    names=["doc_id", "n_words", "start", "words", "print", "shingles"],
                )

    return run


def _windows(hashed, bounds, n, shortest, percent, table, lengths, found) -> None:
    """Append the windows of the given lengths that could be similar to an item."""
    values, firsts = words.shingles(hashed, bounds, n)
    if not len(values) or not lengths:
        return
    first, second = _places(values, 8 * len(table))
    known = (table[first >> 3] >> (first & 7)) & (table[second >> 3] >> (second & 7)) & 1
    before = np.concatenate([[0], np.cumsum(known)])
    hot = np.flatnonzero(known)
    owner = np.searchsorted(firsts, hot, side="right") - 1
    counts = np.diff(bounds)
    for length in lengths if len(hot) else []:
        size = length - n + 1  # shingles of the window
        _whole_texts(values, firsts, counts, before, n, percent, length, found)
        # intersection / union >= percent / 100 with both of this size
        need = -(-2 * size * percent // (100 + percent))
        # A window holds `need` known shingles only if it begins at most size - 1 before one.
        begins = (hot[:, None] - np.arange(size)[None, :]).ravel() if size <= 64 else None
        if begins is None:
            begins = np.concatenate([np.arange(max(0, h - size + 1), h + 1) for h in hot])
            text = np.repeat(owner, [h - max(0, h - size + 1) + 1 for h in hot])
        else:
            text = np.repeat(owner, size)
        ok = (begins >= firsts[text]) & (begins + size <= firsts[text + 1]) & (counts[text] >= length)
        begins, text = begins[ok], text[ok]
        begins, at = np.unique(begins, return_index=True)
        text = text[at]
        ok = before[begins + size] - before[begins] >= need
        begins, text = begins[ok], text[ok]
        if not len(begins):
            continue
        index = begins[:, None] + np.arange(size)[None, :]
        prints = simhash(values[index].ravel(), np.arange(len(begins) + 1) * size)
        found["row"] += text.tolist()
        found["n_words"] += [length] * len(begins)
        found["start"] += (begins - firsts[text]).tolist()
        found["words"] += [length] * len(begins)
        found["print"] += prints.tolist()
        found["shingles"] += list(values[index])


def _whole_texts(values, firsts, counts, before, n, percent, length, found) -> None:
    """Append the texts shorter than an item's length that could be similar to the item."""
    sizes = np.diff(firsts)
    size = length - n + 1
    need = -(-(sizes + size) * percent // (100 + percent))
    held = before[firsts[1:]] - before[firsts[:-1]]
    for text in np.flatnonzero((counts >= n) & (counts < length) & (held >= need)).tolist():
        shingles = values[firsts[text] : firsts[text + 1]]
        found["row"].append(text)
        found["n_words"].append(length)
        found["start"].append(0)
        found["words"].append(int(counts[text]))
        found["print"] += simhash(shingles, np.array([0, len(shingles)])).tolist()
        found["shingles"].append(shingles)


def _filter_bits(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits, dtype=bool)
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            seen[_places(values, bits).ravel()] = True
        packed = np.packbits(seen, bitorder="little")
        yield pa.RecordBatch.from_arrays([pa.array([packed.tobytes()], pa.binary())], names=["bits"])

    return run


def _blocks(print_: Column) -> Column:
    """(block number, its bits) of a fingerprint."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(print_, i * BLOCK_BITS).bitwiseAND(F.lit(2**BLOCK_BITS - 1)).cast("int").alias("bits"),
            )
            for i in range(BLOCKS)
        ]
    )


def _weighted_similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of smaller counts over sum of larger counts of the two shingle multisets."""
    for batch in batches:
        out = []
        for a, b in zip(batch.column("shingles").to_pylist(), batch.column("item_shingles").to_pylist(), strict=True):
            values, counts = np.unique(np.array(a, np.int64), return_counts=True)
            others, more = np.unique(np.array(b, np.int64), return_counts=True)
            _, i, j = np.intersect1d(values, others, assume_unique=True, return_indices=True)
            shared = int(np.minimum(counts[i], more[j]).sum())
            out.append((shared, len(a) + len(b) - shared))
        shared, union = zip(*out, strict=True) if out else ((), ())
        columns = [batch.column(c) for c in ("doc_id", "item_id", "start", "n_words")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(shared, pa.int64()), pa.array(union, pa.int64())],
            names=["doc_id", "item_id", "start", "n_words", "shared", "total"],
        )


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    shingle_words: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Passages of documents that are benchmark items.

    One row per document and item: ``doc_id, item_id, start, n_words, similarity,
    n_windows``: the most similar window (the first of equals), its first word
    (from 0) and length in words, and how many windows reach ``percent`` hundredths.

    Words are runs of characters other than white space, with A-Z lower-cased.
    Items of fewer words than a shingle has are one shingle. A document of fewer words
    than an item is compared with it as a whole, and ``n_words`` is its own length. Null, empty and
    wordless texts match nothing, null ids take no part, repeated rows change only
    ``n_windows``, and an empty table on either side gives an empty result. Other
    columns are not looked at.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    wanted = items.select(F.col(item_id_column).cast("bigint").alias("item_id"), F.col(item_text_column).alias("text"))
    known = freeze(
        wanted.where("item_id IS NOT NULL").mapInArrow(
            _item_rows(shingle_words), "item_id bigint, n_words bigint, item_print bigint, item_shingles array<bigint>"
        ).where("n_words > 0"),
        "items",
    )
    # Bounded: distinct item lengths, and a bitmap of bounded size from each of at most 8 tasks.
    lengths = sorted(r[0] for r in known.select("n_words").distinct().collect())
    bits = filter_size(known.agg(F.sum(F.size("item_shingles"))).first()[0] or 0)
    parts = known.select("item_shingles").coalesce(8).mapInArrow(_filter_bits(bits), "bits binary")
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():
        bitmap |= np.frombuffer(row["bits"], np.uint8)
    share = spark.sparkContext.broadcast
    windows = freeze(
        source.where("doc_id IS NOT NULL").mapInArrow(
            _window_rows(shingle_words, percent, share(bitmap.tobytes()), share(lengths)),
            "doc_id bigint, n_words bigint, start bigint, words bigint, print bigint, shingles array<bigint>",
        ),
        "windows",
    )
    masks = F.array(*[F.lit(int(m)) for m in _MASKS])
    index = known.select("item_id", "n_words", F.inline(_blocks(F.col("item_print"))))
    near = index.select("item_id", "n_words", "block", F.col("bits"), F.explode(masks).alias("_mask")).select(
        "item_id", "n_words", "block", F.col("bits").bitwiseXOR(F.col("_mask")).alias("bits")
    )
    probes = windows.select("doc_id", "start", "n_words", "print", F.inline(_blocks(F.col("print"))))
    met = (
        # The index grows with the benchmark, and Spark cannot tell by how much it is exploded.
        probes.join(near.hint("merge"), ["n_words", "block", "bits"])
        .select("doc_id", "start", "n_words", "print", "item_id").distinct()
        .join(known.select("item_id", "item_print", "item_shingles"), "item_id")
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    )
    both = met.join(windows.select("doc_id", "start", "n_words", "words", "shingles"), ["doc_id", "start", "n_words"])
    checked = both.select("doc_id", "item_id", "start", F.col("words").alias("n_words"), "shingles", "item_shingles").mapInArrow(
        _weighted_similarity, "doc_id bigint, item_id bigint, start bigint, n_words bigint, shared bigint, total bigint"
    )
    close = checked.where(F.col("shared") * 100 >= F.col("total") * percent).withColumn(
        "similarity", F.col("shared") / F.col("total")
    )
    return (
        close.groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("_s"), "n_words")).alias("_best"), F.count("*").alias("n_windows"))
        .select("doc_id", "item_id", (-F.col("_best._s")).alias("start"), "_best.n_words", "_best.similarity", "n_windows")
    )
