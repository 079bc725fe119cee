"""Near-duplicate documents by b-bit MinHash, with exact confirmation.

1. Each document becomes a set of distinct word shingles, ``HASHES`` minima, one
   key per band of minima, and a signature that keeps only the lowest bits of the
   minima, packed in 64-bit numbers.
2. Documents with equal sets form a class; from here on its number stands
   for it, so thousands of copies cost one row.
3. Representatives that share a band key are candidates. The number of equal
   lanes of two signatures, counted with ``bit_count`` and corrected for lanes
   that agree by chance, estimates their similarity. Pairs clearly below the
   limit are discarded.
4. Pairs that remain are confirmed on the full sets.

A bucket is not expanded into all its pairs. In a few rounds each bucket has a
leader, and every member is confirmed against the leader that it seems most
similar to; most members get their component from that. Afterwards only members
of one bucket that still have different components are compared, small buckets by
pairs, large ones in blocks of bounded size, so no link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words
from ledgerline.llm.components import connected_components
from ledgerline.workspace import freeze

HASHES = 128
ROWS = 4  # minima per band: 32 bands; a pair at 0.8 shares none with probability 5e-8
BITS = 2  # kept of each minimum
LANES = 64 // BITS
PACKED = HASHES // LANES
LEADER_ROUNDS = 2
LARGE_BUCKET = 64  # members from which a bucket is compared in blocks
BLOCK = 256  # members in a block

_random = np.random.Generator(np.random.PCG64(771))
_FACTORS = _random.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 2**32, HASHES, dtype=np.uint32)
_BAND = _random.integers(0, 2**64, HASHES // ROWS, dtype=np.uint64)
_ROW = _random.integers(0, 2**64, ROWS, dtype=np.uint64) | np.uint64(1)


def distinct_shingles(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and the first of each text."""
    values, firsts = words.shingles(*words.hashed_words(texts), n)
    sets = [np.unique(values[a:b]) for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
    bounds = np.zeros(len(sets) + 1, dtype=np.int64)
    np.cumsum([len(s) for s in sets], out=bounds[1:])
    return np.concatenate(sets) if sets else values, bounds


def minima(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``HASHES`` minima for each non-empty set, one row per set."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    firsts = bounds[:-1]
    out = np.empty((HASHES, len(firsts)), dtype=np.uint32)
    for k in range(HASHES):
        out[k] = np.minimum.reduceat(short * _FACTORS[k] + _SHIFTS[k], firsts)
    return out.T


def signatures(least: np.ndarray) -> np.ndarray:
    """Lowest ``BITS`` bits of the minima, ``LANES`` of them in each number."""
    # A minimum is a small number, but its lowest bits are as good as random.
    low = (least & np.uint32(2**BITS - 1)).astype(np.uint64).reshape(len(least), PACKED, LANES)
    return (low << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key per band; the number of the band is part of it."""
    rows = least.astype(np.uint64).reshape(len(least), HASHES // ROWS, ROWS)
    return words.mixed(words.mixed(rows * _ROW + np.uint64(1)).sum(axis=2, dtype=np.uint64) + _BAND)


def fingerprints(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two numbers that tell the sets apart, zeros for empty ones: one column for each set."""
    some = np.flatnonzero(np.diff(bounds))
    out = np.zeros((2, len(bounds) - 1), np.uint64)
    if len(some):
        firsts = bounds[:-1][some]
        out[0, some] = np.add.reduceat(words.mixed(values), firsts)
        out[1, some] = np.add.reduceat(words.mixed(values ^ np.uint64(0x5851F42D4C957F2D)), firsts)
    return out


def _sketches(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in words.chunks(batch.column(1)):
                values, bounds = distinct_shingles(texts, n)
                sizes = np.diff(bounds)
                some = np.flatnonzero(sizes)
                sums = fingerprints(values, bounds)
                bands = np.zeros((len(sizes), HASHES // ROWS), np.uint64)
                packed = np.zeros((len(sizes), PACKED), np.uint64)
                if len(some):
                    least = minima(values, np.append(bounds[:-1][some], len(values)))
                    bands[some], packed[some] = band_keys(least), signatures(least)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(sizes),
                        pa.array(words.signed(sums[0])),
                        pa.array(words.signed(sums[1])),
                        _lists(bands),
                        _lists(packed),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "signature"],
                )

    return run


def _lists(rows: np.ndarray) -> pa.Array:
    flat = pa.array(words.signed(rows.reshape(-1)))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), flat)


def _full_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in words.chunks(batch.column(1)):
                values, bounds = distinct_shingles(texts, n)
                sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(words.signed(values)))
                sums = [pa.array(words.signed(x)) for x in fingerprints(values, bounds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), *sums, sets], names=["doc_id", "set_a", "set_b", "shingles"]
                )

    return run


def lowest_estimate(similarity: float, deviations: float = 5.0) -> float:
    """The estimate below which a pair at ``similarity`` falls with chance under 3e-7."""
    chance = 2.0**-BITS
    agree = chance + (1 - chance) * similarity
    return similarity - deviations * math.sqrt(agree * (1 - agree) / HASHES) / (1 - chance)


def estimate(a: Column, b: Column) -> Column:
    """Column: similarity from two signatures, corrected for chance agreement.

    A lane differs if either of its bits does; folding both bits onto the lower one
    leaves one bit per differing lane to count.
    """
    mask = F.lit(0x5555555555555555).cast("bigint")
    differing = F.lit(0)
    for i in range(PACKED):
        bits = a[i].bitwiseXOR(b[i])
        differing += F.bit_count(bits.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseAND(mask))
    chance = 2.0**-BITS
    return (1 - differing / HASHES - chance) / (1 - chance)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("_b"))
    shared = F.size(F.array_intersect("_a", "_b"))
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .select("a", "b", shared.alias("_shared"), (F.size("_a") + F.size("_b") - shared).alias("_all"))
        .where(F.col("_shared").cast("bigint") * 100 >= F.col("_all").cast("bigint") * percent)
        .select("a", "b")
    )


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    sets = [*left, *right]
    sizes = [len(s) for s in sets]
    values, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = seen > 1
    place = np.cumsum(several) - 1
    row = np.repeat(np.arange(len(sets)), sizes)[several[column]]
    column = place[column[several[column]]]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    step = 4096
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(several.sum()), step):
        a, b = np.searchsorted(column, [first, first + step])
        table = np.zeros((len(sets), step), dtype=np.float32)
        table[row[a:b], column[a:b] - first] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out.astype(np.int64)


def _block_links(percent: int):
    """Links between components within two blocks of a bucket, enough to join them."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        p, q = int(frame.p.iloc[0]), int(frame.q.iloc[0])
        left = frame[frame.own == p]
        right = left if p == q else frame[frame.own == q]
        root: dict[int, int] = {}

        def top(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            a, b = list(left.shingles), list(right.shingles)
            shared = _shared_counts(a, b)
            total = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :] - shared
            apart = left.component.to_numpy()[:, None] != right.component.to_numpy()[None, :]
            for i, j in zip(*np.nonzero(apart & (100 * shared >= percent * total)), strict=True):
                low, high = top(int(left.component.iloc[i])), top(int(right.component.iloc[j]))
                if low != high:
                    root[max(low, high)] = min(low, high)
                    out.append((int(left.rep.iloc[i]), int(right.rep.iloc[j])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def near_duplicate_groups(
    docs: DataFrame,
    *,
    shingle_words: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked if the Jaccard similarity of their shingle sets is at
    least ``percent`` hundredths. ``component_id`` is the smallest id reachable
    over links; ``kept`` marks the document with that id. Words are runs of
    characters other than space and 0x09-0x0D, with A-Z lower-cased; a text of fewer
    words than a shingle has is one shingle.

    Null, empty and wordless texts have ``n_shingles`` 0 and are linked with
    nothing. Rows that repeat an id are told apart by their sets and all keep
    their row. A null id takes part with a component of its own and is kept. An empty
    table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    sketches = freeze(
        source.mapInArrow(
            _sketches(shingle_words),
            "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, signature array<bigint>",
        ),
        "sketches",
    )
    usable = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Numbered once, in a stored table: an id may repeat with different sets.
    classes = freeze(
        usable.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("doc_id"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "classes",
    )
    standing = freeze(
        usable.join(classes, ["set_a", "set_b", "doc_id"]).select("rep", "bands", "signature").dropDuplicates(["rep"]),
        "representatives",
    )
    keyed = standing.select("rep", F.explode("bands").alias("key"))
    shared = freeze(
        keyed.groupBy("key").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high"), F.count("*").alias("members"))
        .where("_low < _high").select("key", "members"),
        "shared-buckets",
    )
    members = freeze(keyed.join(shared, "key").join(standing.select("rep", "signature"), "rep"), "members")
    labels = freeze(members.select("rep").distinct().withColumn("component", F.col("rep")), "labels")
    lowest = lowest_estimate(percent / 100)
    sets = None

    def full_sets(reps: DataFrame) -> DataFrame:
        """Shingle sets that cover the given representatives (a column ``rep``)."""
        nonlocal sets
        wanted = reps.distinct()
        if sets is not None:
            wanted = wanted.join(sets.select("rep"), "rep", "left_anti")
        wanted = freeze(classes.join(wanted, "rep"), "wanted")
        texts = source.join(wanted.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
        full = texts.mapInArrow(_full_sets(shingle_words), "doc_id bigint, set_a bigint, set_b bigint, shingles array<bigint>")
        more = full.join(wanted, ["doc_id", "set_a", "set_b"]).select("rep", "shingles").dropDuplicates(["rep"])
        more = freeze(more, "full-sets")
        sets = more if sets is None else sets.unionByName(more)
        return sets

    def merged(links: DataFrame) -> DataFrame:
        """Labels after joining the components of linked representatives (a, b)."""
        near = links.join(labels.toDF("a", "_a"), "a").join(labels.toDF("b", "_b"), "b")
        over = freeze(connected_components(near.select(F.col("_a").alias("a"), F.col("_b").alias("b"))), "groups")
        return freeze(
            labels.join(over.toDF("component", "_over"), "component", "left").select(
                "rep", F.coalesce("_over", "component").alias("component")
            ),
            "labels",
        )

    def confirmed(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("rep"))
        return _confirmed(pairs, full_sets(ends), percent)

    def undecided(rows: DataFrame) -> DataFrame:
        """Members of buckets that still hold more than one component."""
        placed = freeze(rows.drop("component").join(labels, "rep"), "placed")
        mixed = freeze(
            placed.groupBy("key")
            .agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("members"))
            .where("_low < _high").select("key", "members"),
            "mixed-buckets",
        )
        return freeze(placed.drop("members").join(mixed, "key"), "undecided")

    open_ = members.select("*", F.col("rep").alias("component"))
    for turn in range(LEADER_ROUNDS):
        # Another leader in each bucket and round: a member meets up to one per band.
        chosen = F.min_by(F.struct("rep", "component", "signature"), F.xxhash64("rep", "key", F.lit(turn)))
        leaders = freeze(open_.groupBy("key").agg(chosen.alias("leader")), "leaders")
        met = (
            open_.join(leaders, "key").where(F.col("component") != F.col("leader.component"))
            .select(F.col("leader.rep").alias("a"), F.col("rep").alias("b"),
                    estimate(F.col("leader.signature"), F.col("signature")).alias("_estimate"))
            .where(F.col("_estimate") >= lowest)
        )
        best = met.groupBy("b").agg(F.max(F.struct("_estimate", F.col("a"))).alias("_best"))
        pairs = freeze(best.select(F.col("_best.a").alias("a"), "b"), "pairs")
        if not pairs.limit(1).count():
            break
        labels = merged(confirmed(pairs))
        open_ = undecided(open_)

    # What is left: pairs within a bucket that the leaders did not bring together. In
    # small buckets, at most LARGE_BUCKET for each member:
    small = open_.where(F.col("members") <= LARGE_BUCKET)
    x, y = small.alias("x"), small.alias("y")
    rest = freeze(
        x.join(
            y,
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.component") < F.col("y.component"))
            & (estimate(F.col("x.signature"), F.col("y.signature")) >= lowest),
        )
        .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        .distinct(),
        "pairs",
    )
    # In large buckets block by block, on the full sets and without emitting pairs:
    large = freeze(open_.where(F.col("members") > LARGE_BUCKET).select("key", "rep", "component", "members"), "large")
    links = confirmed(rest) if rest.limit(1).count() else None
    if large.limit(1).count():
        blocks = F.ceil(F.col("members") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
        dealt = large.select(
            "key", "rep", "component", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
        ).select("key", "rep", "component", "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
        blocked = dealt.join(full_sets(large.select("rep")), "rep")
        found = blocked.groupBy("key", "p", "q").applyInPandas(_block_links(percent), "a bigint, b bigint")
        links = found if links is None else links.unionByName(found)
    if links is not None:
        labels = merged(freeze(links, "links"))

    placed = freeze(
        classes.join(labels, "rep", "left").select("set_a", "set_b", "doc_id", F.coalesce("component", "rep").alias("_number")),
        "placed-classes",
    )
    least = placed.groupBy("_number").agg(F.min("doc_id").alias("_component"))
    named = freeze(placed.join(least, "_number").select("set_a", "set_b", "_component"), "class-labels")
    component = F.when(F.col("n_shingles") > 0, F.col("_component"))
    return (
        sketches.select("doc_id", "n_shingles", "set_a", "set_b")
        .join(named, ["set_a", "set_b"], "left")
        .select("doc_id", "n_shingles", F.coalesce(component, "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
