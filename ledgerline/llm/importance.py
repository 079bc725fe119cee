"""Quality selection by importance resampling.

Two generative models over hashed word n-grams, one of target texts and one of
all raw texts, give each document a log weight: how much likelier its n-grams are
under the target. Adding Gumbel noise and taking the k largest keys draws k
documents without replacement with probabilities in proportion to the weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words
from ledgerline.workspace import freeze

BUCKETS = 10_000
_DIGIT = 16  # bits decided in each pass of the selection


def hashed_ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, grouped by text, and how many each text has."""
    hashed, bounds = words.hashed_words(texts)
    pairs, firsts = words.shingles(hashed, bounds, 2)
    counts = np.diff(bounds)
    real = np.repeat(counts >= 2, np.diff(firsts))  # a single word is no pair
    owner = np.concatenate(
        [np.repeat(np.arange(len(texts)), counts), np.repeat(np.arange(len(texts)), np.diff(firsts))[real]]
    )
    buckets = (np.concatenate([hashed, pairs[real]]) % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, owner


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, buckets): two bytes for each word and word pair, in ascending order."""
    for batch in batches:
        for first, texts in words.chunks(batch.column(1)):
            buckets, owner = hashed_ngrams(texts)
            packed = (np.sort(owner * BUCKETS + buckets) % BUCKETS).astype("<u2").tobytes()
            ends = 2 * np.cumsum(np.bincount(owner, minlength=len(texts)))
            grams = [packed[start:end] for start, end in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(texts)), pa.array(grams, pa.binary())], names=["doc_id", "grams"]
            )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(is target, buckets) to one row per bucket for the whole task."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        marked, grams = np.array(batch.column(0).to_pylist(), dtype=bool), batch.column(1).to_pylist()
        buckets = np.frombuffer(b"".join(grams), "<u2")
        raw += np.bincount(buckets, minlength=BUCKETS)
        target += np.bincount(buckets[np.repeat(marked, [len(g) // 2 for g in grams])], minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(BUCKETS)), pa.array(raw), pa.array(target)], names=["bucket", "raw", "target"]
    )


def bucket_counts(source: DataFrame, good: DataFrame) -> DataFrame:
    """``bucket, raw, target``: how often each bucket occurs in all texts, and in those whose id is in ``good``.

    Not the texts but their buckets meet the ids, by a shuffle at any size: what moves stays in proportion to
    the texts, and a task holds the ids of its partition only.
    """
    grams = source.mapInArrow(_packed, "doc_id bigint, grams binary")
    chosen = good.distinct().withColumn("_target", F.lit(True)).hint("shuffle_hash")
    marked = grams.join(chosen, "doc_id", "left").select(F.coalesce("_target", F.lit(False)).alias("_target"), "grams")
    sums = marked.mapInArrow(_counts, "bucket bigint, raw bigint, target bigint").groupBy("bucket")
    return sums.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def ordered_bits(keys: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles."""
    bits = keys.astype(np.float64).view(np.int64)
    return np.where(bits >= 0, bits, bits ^ np.int64(0x7FFFFFFFFFFFFFFF))


def _keys(ratios, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        for batch in batches:
            ids = np.array([i or 0 for i in batch.column(0).to_pylist()], dtype=np.int64)
            hashed = words.mixed(ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
            noise = -np.log(-np.log(((hashed >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52))
            for first, texts in words.chunks(batch.column(1)):
                buckets, owner = hashed_ngrams(texts)
                weight = np.bincount(owner, table[buckets], minlength=len(texts)).astype(np.float64)  # also without words
                key = weight + noise[first : first + len(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(weight), pa.array(key), pa.array(ordered_bits(key))],
                    names=["doc_id", "log_weight", "sample_key", "order_key"],
                )

    return run


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The ``k``-th largest value of a bigint column, exactly.

    A radix selection: each pass counts the rows by the next 16 bits among those
    that share the bits found so far, so at most 65,536 counts reach the driver.
    """
    low, high = -(2**63), 2**63 - 1
    for shift in (48, 32, 16, 0):
        bucket = F.shiftright(column, shift)
        counts = rows.where(F.col(column).between(low, high)).groupBy(bucket.alias("b")).count().collect()
        for row in sorted(counts, key=lambda r: -r["b"]):
            if k <= row["count"]:
                low = row["b"] << shift
                high = low + (1 << shift) - 1
                break
            k -= row["count"]
        else:
            return None
    return low


def importance_sample(
    docs: DataFrame,
    labels: DataFrame,
    *,
    fraction: float = 0.5,
    seed: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DataFrame:
    """One row per document: ``doc_id, log_weight, sample_key, selected``.

    The target model is learned from all documents with label 1, the raw model from all documents.
    ``selected`` marks the ``fraction`` of the rows with the largest keys; rows that
    tie with the last one, which only repeats of an id do, are selected too.
    The noise depends on id and ``seed``, so a rerun draws the same sample.

    Null and empty texts have log weight 0. A null id draws the noise of id 0. Without
    any label 1 all log weights are 0. An empty table gives an empty result. Other
    columns are not looked at.
    """
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    good = labels.where(F.col(label_column).cast("int") == 1).select(F.col(id_column).cast("bigint").alias("doc_id"))
    sums = bucket_counts(source, good).collect()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in sums:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    ratios = np.zeros(BUCKETS)
    if target.sum():
        ratios = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    table = docs.sparkSession.sparkContext.broadcast(ratios)
    keyed = freeze(
        source.mapInArrow(_keys(table, seed), "doc_id bigint, log_weight double, sample_key double, order_key bigint"),
        "sample-keys",
    )
    wanted = math.ceil(keyed.count() * fraction)
    last = kth_largest(keyed, "order_key", wanted) if wanted else None
    selected = F.col("order_key") >= F.lit(last) if last is not None else F.lit(False)
    return keyed.select("doc_id", "log_weight", "sample_key", selected.alias("selected"))
