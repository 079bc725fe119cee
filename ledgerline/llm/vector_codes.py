"""Compact codes of vectors by one trained codebook for each part (product quantisation).

Components become integers and every vector is cut into ``PARTS`` consecutive parts.
Each part position has a codebook of up to ``ENTRIES`` entries, trained by rounds of
assignment and averaging over all rows. Assignment finds the nearest entry exactly,
with memoised grid cells:

1. A part falls in a coarse cell, a box of integer points; the cell is the hash key.
2. For each new cell the least and the largest squared distance from the box to every
   entry are worked out. An entry whose least distance exceeds the smallest largest
   distance is dominated across the whole box and can be nearest nowhere in it; the
   other entries are remembered for the cell.
3. Only the remembered entries are evaluated for the parts in the cell.

Tasks return sums and counts for each entry, so a round shuffles a bounded number of
rows for each task whatever the number of vectors; the codebooks, whose size does not
depend on the rows, are the only thing the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.workspace import freeze

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
CHUNK = 4096  # rows evaluated at a time
MEMO_CELLS = 1 << 14  # cells remembered for a part in a task; a full memory starts anew

#: One codebook for each part, entries by components.
Codebooks = list[np.ndarray]


def part_bounds(dim: int) -> list[tuple[int, int]]:
    """Start and end of each part; the first ones are longer if ``dim`` is no multiple of ``PARTS``."""
    ends = np.cumsum([dim // PARTS + (k < dim % PARTS) for k in range(PARTS)])
    return [(int(end - dim // PARTS - (k < dim % PARTS)), int(end)) for k, end in enumerate(ends)]


class CellMemory:
    """Entries of one codebook that can be nearest in a coarse cell, worked out once a cell."""

    def __init__(self, book: np.ndarray) -> None:
        self.book = book
        self.width = _cell_width(book)
        self.known: dict[bytes, np.ndarray] = {}

    def _candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        low = (cells * self.width)[:, None, :]
        high = low + (self.width - 1)
        entries = self.book[None, :, :]
        outside = np.maximum(np.maximum(low - entries, entries - high), 0)
        least = (outside**2).sum(axis=2)
        largest = (np.maximum(np.abs(entries - low), np.abs(entries - high)) ** 2).sum(axis=2)
        # An entry at exactly the limit may tie, so it stays.
        able = least <= largest.min(axis=1)[:, None]
        return [np.flatnonzero(row) for row in able]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each point, ties to the lower index, and the squared distance."""
        if not points.shape[1]:
            return np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        cells = np.ascontiguousarray(points // self.width)
        keys, first, owner = np.unique(
            cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel(), return_index=True, return_inverse=True
        )
        keys = [key.tobytes() for key in keys]
        new = [i for i, key in enumerate(keys) if key not in self.known]
        if len(self.known) + len(new) > MEMO_CELLS:
            self.known = {}
            new = list(range(len(keys)))
        for i, able in zip(new, self._candidates(cells[first[new]]) if new else (), strict=True):
            self.known[keys[i]] = able
        able = [self.known[key] for key in keys]
        sizes = np.array([len(a) for a in able])
        starts = np.cumsum(sizes) - sizes
        flat = np.concatenate(able)

        counts = sizes[owner]
        firsts = np.cumsum(counts) - counts
        row = np.repeat(np.arange(len(points)), counts)
        entry = flat[np.repeat(starts[owner] - firsts, counts) + np.arange(len(row))]
        distance = ((points[row] - self.book[entry]) ** 2).sum(axis=1)
        best = np.minimum.reduceat(distance, firsts)
        # Candidates of a point are in ascending order, so its first hit is the lowest.
        hits = np.flatnonzero(distance == best[row])
        _, leading = np.unique(row[hits], return_index=True)
        return entry[hits[leading]], best


def _cell_width(book: np.ndarray) -> int:
    """Width of a cell: the typical distance of neighbouring entries along one component."""
    if len(book) < 2 or not book.shape[1]:
        return 1
    apart = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(apart, np.iinfo(np.int64).max)
    return max(1, int(np.sqrt(np.median(apart.min(axis=1)) / book.shape[1])))


def assign(vectors: np.ndarray, memories: list[CellMemory]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances), each of shape rows by ``PARTS``."""
    codes = np.empty((len(vectors), PARTS), np.int64)
    errors = np.empty((len(vectors), PARTS), np.int64)
    for k, (a, b) in enumerate(part_bounds(vectors.shape[1])):
        for first in range(0, len(vectors), CHUNK):
            part = slice(first, first + CHUNK)
            codes[part, k], errors[part, k] = memories[k].nearest(vectors[part, a:b])
    return codes, errors


def _by_length(batches: Iterator[pa.RecordBatch], books: dict[int, Codebooks]) -> Iterator[tuple]:
    """(batch, rows, vectors, memories) of the rows of one length in each batch."""
    memories = {dim: [CellMemory(book) for book in own] for dim, own in books.items()}
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("parts"))
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(sizes):
            rows = np.flatnonzero(sizes == dim)
            flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
            yield batch, rows, flat.reshape(len(rows), dim), memories[int(dim)]


def _entry_sums(books: dict[int, Codebooks]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {dim: [np.zeros(book.shape, np.int64) for book in own] for dim, own in books.items()}
        counts = {dim: [np.zeros(len(book), np.int64) for book in own] for dim, own in books.items()}
        for _, _, vectors, memories in _by_length(batches, books):
            dim = vectors.shape[1]
            codes, _ = assign(vectors, memories)
            for k, (a, b) in enumerate(part_bounds(dim)):
                np.add.at(sums[dim][k], codes[:, k], vectors[:, a:b])
                counts[dim][k] += np.bincount(codes[:, k], minlength=len(counts[dim][k]))
        out = [
            (dim, k, e, int(counts[dim][k][e]), sums[dim][k][e].tolist())
            for dim in books
            for k in range(PARTS)
            for e in np.flatnonzero(counts[dim][k]).tolist()
        ]
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["dim", "part", "entry", "n", "sums"]
        )

    return run


def _coded(books: dict[int, Codebooks], digests: dict[int, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, vectors, memories in _by_length(batches, books):
            codes, errors = assign(vectors, memories)
            packed = codes.astype(np.uint8).tobytes().hex()
            width = 2 * PARTS
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column(0),
                    kept.column(1),
                    pa.array([packed[i * width : (i + 1) * width] for i in range(len(rows))], pa.string()),
                    pa.array(errors.sum(axis=1)),
                    pa.array([digests[vectors.shape[1]]] * len(rows), pa.string()),
                ],
                names=["vec_id", "label", "code", "error", "codebooks_sha256"],
            )

    return run


def _trained(rows: DataFrame, books: dict[int, Codebooks]) -> dict[int, Codebooks]:
    """Codebooks after one round: each entry the floor of the mean of its parts; unused ones stay."""
    schema = "dim int, part int, entry int, n bigint, sums array<bigint>"
    placed = rows.mapInArrow(_entry_sums(books), schema).select("dim", "part", "entry", "n", F.posexplode("sums"))
    totals = placed.groupBy("dim", "part", "entry", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("total")
    )
    out = {dim: [book.copy() for book in own] for dim, own in books.items()}
    for row in totals.collect():  # at most ENTRIES rows for each component
        out[row.dim][row.part][row.entry, row.pos] = int(row.total) // row.n
    return out


def digest(books: Codebooks) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress_vectors(
    vectors: DataFrame,
    *,
    rounds: int = ROUNDS,
    entries: int = ENTRIES,
    scale: float = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str | None = "label",
) -> DataFrame:
    """One row per usable vector: ``vec_id, label, code, error, label_error, codebooks_sha256``.

    Components become ``floor(scale * x)``. The codebook of a part starts as that part of
    the vectors with the ``entries`` smallest ids (at most 256) and is trained in ``rounds`` rounds over all
    rows. ``code`` holds the nearest entries' numbers, two hex digits for each part; ``error`` is the
    squared distance summed over parts; ``label_error`` is the sum of ``error`` over
    rows of equal label, null labels together.

    Vectors that are null or hold a null or non-finite component are left out. Rows that repeat
    an id all count and all stay; among the first entries ties of ids are broken by the
    components, and null ids come last. Vectors of different lengths get codebooks of
    their own, so lengths should be few; a length that is no multiple of ``PARTS`` has longer
    first parts, and an empty vector has code 0 and error 0. Components so large that
    squared distances could leave 64 bits raise a ``ValueError``. An empty table gives an empty
    result. Other columns are not looked at.
    """
    label = F.col(label_column) if label_column else F.lit(None).cast("string")
    usable = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"), label.alias("label"),
        F.col(vector_column).cast("array<double>").alias("_v"),
    ).where(F.col("_v").isNotNull() & F.forall("_v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
    rows = freeze(
        usable.select("vec_id", "label", F.transform("_v", lambda x: F.floor(x * float(scale)).cast("bigint")).alias("parts")),
        "vector-integers",
    )
    size = F.size("parts")
    lengths = rows.groupBy(size.alias("dim")).agg(
        F.max(F.aggregate("parts", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x.cast("double"))))).alias("largest")
    )
    books: dict[int, Codebooks] = {}
    for row in lengths.collect():
        if row.dim and row.dim * (2 * row.largest + 2) ** 2 >= 2.0**63:
            raise ValueError(f"components up to {row.largest:.0f} in vectors of {row.dim} leave 64-bit squared distances")
        first = rows.where(size == row.dim).orderBy(F.asc_nulls_last("vec_id"), "parts").limit(entries).collect()
        start = np.array([list(r.parts) for r in first], np.int64).reshape(len(first), row.dim)
        books[row.dim] = [np.ascontiguousarray(start[:, a:b]) for a, b in part_bounds(row.dim)]
    for _ in range(rounds):
        books = _trained(rows, books)
    kind = dict(rows.dtypes)["label"]
    coded = freeze(
        rows.mapInArrow(
            _coded(books, {dim: digest(own) for dim, own in books.items()}),
            f"vec_id bigint, label {kind}, code string, error bigint, codebooks_sha256 string",
        ),
        "vector-codes",
    )
    totals = coded.groupBy(F.col("label").alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error")
    )
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "label", "code", "error", "label_error", "codebooks_sha256"
    )
