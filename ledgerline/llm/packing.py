"""Best-fit-decreasing packing of tokenised documents into fixed-size sequences.

Best-fit decreasing takes pieces from the longest to the shortest and puts each
into the open sequence with the least room that still holds it. Which piece of
a given length comes first makes no difference, so the plan depends only on how
many pieces each length has: at most ``max_tokens`` counts, whatever the corpus
size. ``best_fit_decreasing`` runs the method on those counts. Its segment tree
covers the possible remaining capacities and finds the tightest open sequence in
logarithmic time; a run of equal pieces that would meet the same answer is placed
by one such search. Spark then gives every piece its rank within its length and
looks up the place that the plan holds for it. No document passes the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from ledgerline.workspace import freeze

SEPARATOR = 0
SLICE_CHARS = 3 << 20  # texts are split into words about this much at a time
CACHED_WORDS = 200_000  # spellings a worker remembers, once for those in use and once for those before
CACHED_CHARS = 48  # longer words are encoded each time


class Run(NamedTuple):
    """Pieces of one length, ranks ``first`` up to ``last``, ``each`` per sequence."""

    length: int
    first: int
    last: int
    each: int
    sequence: int
    offset: int


class Capacities:
    """Segment tree over remaining capacities: which of them has an open sequence."""

    def __init__(self, most: int) -> None:
        self.width = 1 << most.bit_length()
        self.any = bytearray(2 * self.width)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(most + 1)]

    def _mark(self, room: int) -> None:
        node = self.width + room
        self.any[node] = bool(self.groups[room])
        while node > 1:
            node >>= 1
            self.any[node] = self.any[2 * node] | self.any[2 * node + 1]

    def put(self, room: int, first: int, count: int) -> None:
        """Sequences ``first`` to ``first + count - 1`` have ``room`` left."""
        if count:
            self.groups[room].append((first, count))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        group = self.groups[room].pop()
        self._mark(room)
        return group

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` that is open."""
        node = self.width + length
        if self.any[node]:
            return length
        while node > 1:
            if not node & 1 and self.any[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node + (not self.any[2 * node])
                return node - self.width
            node >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Plan for ``counts[length]`` pieces of each length: runs, number of sequences.

    After a piece of some length has gone to the tightest sequence, the next
    equal piece goes to the same one while it has room (it has become tighter
    still), then to the next sequence with the same room.
    """
    open_, runs, sequences = Capacities(capacity), [], 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit {capacity}")
        rank, left = 0, counts[length]
        while left:
            room = open_.tightest(length)
            if room is None:
                room = capacity
                each = room // length
                first, count = sequences, -(-left // each)
                sequences += count
            else:
                each = room // length
                first, count = open_.take(room)
            placed = min(left, each * count)
            full, rest = divmod(placed, each)
            runs.append(Run(length, rank, rank + placed, each, first, capacity - room))
            open_.put(room - each * length, first, full)
            if rest:
                open_.put(room - rest * length, first + full, 1)
            open_.put(room, first + full + bool(rest), count - full - bool(rest))
            rank, left = rank + placed, left - placed
    return runs, sequences


_loaded: dict[int, _WordEncoder] = {}


def _byte_letters() -> dict[int, str]:
    """Characters that byte-level vocabularies use for bytes: printable ones stand
    for themselves, the others follow from code point 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class _WordEncoder:
    """Ids of single spellings, remembered. One per process and definition."""

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.letters = _byte_letters()
        self.marks = {mark: self._whole([mark])[0] for mark in ".,"}
        # A special token that may stand between words that are encoded together.
        special = [(i, t) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.between = special[0][0] if special else None
        self.border = special[0][1].content if special else None
        # Words of letters may go to the model directly, if it gives the same ids.
        probe = ["the", "über", "ciónñ", "x", "antidisestablishment"]
        self.direct = [self._letters(w) for w in probe] == self._whole(probe)

    def _letters(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(word)])

    def _whole(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(f.ids, dtype="<u4").tobytes() for f in found]

    def _together(self, words: list[str]) -> list[bytes]:
        """Words without special tokens, in one call."""
        ids = np.array(self.tokenizer.encode(self.border.join(words), add_special_tokens=False).ids, dtype="<u4")
        cuts = (4 * np.flatnonzero(ids == self.between)).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *[c + 4 for c in cuts]], [*cuts, len(raw)], strict=True)]

    def remembered(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words. When the memory is full, words not used since it was last full are forgotten."""
        if len(self.seen) + len(words) > CACHED_WORDS:
            self.seen, self.older = {}, self.seen
        seen, older = self.seen, self.older
        found = [seen.get(word) for word in words]
        missing = []
        for i, ids in enumerate(found):
            if ids is None:
                ids = older.get(words[i])
                if ids is None:
                    missing.append(i)
                else:
                    found[i] = seen[words[i]] = ids
        for i, ids in zip(missing, self.encode([words[i] for i in missing]), strict=True):
            found[i] = ids
            if len(words[i]) <= CACHED_CHARS:
                seen[words[i]] = ids
        return found

    def encode(self, words: list[str]) -> list[bytes]:
        out: dict[str, bytes] = {}
        rest, odd = [], []
        for word in words:
            mark = word[-1:] if word[-1:] in (".", ",") else ""
            core = word[:-1] if mark else word
            if self.direct and core.isalpha() and core.islower() and _is_latin1(core):
                out[word] = self._letters(core) + (self.marks[mark] if mark else b"")
            elif self.border and "<|" not in word:
                rest.append(word)
            else:
                odd.append(word)
        for first in range(0, len(rest), 4096):
            part = rest[first : first + 4096]
            out.update(zip(part, self._together(part), strict=True))
        out.update(zip(odd, self._whole(odd), strict=True))
        return [out[word] for word in words]


def _is_latin1(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _word_encoder(definition: str) -> _WordEncoder:
    key = hash(definition)
    if key not in _loaded:
        _loaded[key] = _WordEncoder(definition)
    return _loaded[key]


def _spelling(text: str) -> str:
    """Lower case where this cannot change the ids: the vocabulary is lower case,
    but special tokens are found before lower-casing, and outside Latin-1 the rules
    of libraries differ.
    """
    return text.lower() if "<|" not in text and _is_latin1(text) else text


def token_ids(texts: list[str], definition: str, separator: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts as one array, each text with the separator behind it if there is one, and their bounds.

    No token spans a space or a line break, so the stretches between them are
    encoded once per distinct spelling; splitting them and putting the ids together is done for
    whole arrays.
    """
    encoder = _word_encoder(definition)
    column = pc.replace_substring(pa.array([_spelling(t) for t in texts], pa.large_string()), "\n", " ")
    split = pc.split_pattern(column, " ")
    words = split.values.dictionary_encode()
    spelt = encoder.remembered(words.dictionary.to_pylist())
    if separator is not None:
        spelt.append(separator.to_bytes(4, "little"))
    known = np.frombuffer(b"".join(spelt), dtype="<u4")
    sizes = np.fromiter(map(len, spelt), np.int64, len(spelt)) // 4
    starts = np.cumsum(sizes) - sizes

    ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
    place = words.indices.to_numpy()
    if separator is not None:
        place = np.insert(place, ends, len(spelt) - 1)
        ends = ends + np.arange(1, len(ends) + 1)
    counts = sizes[place]
    after = np.cumsum(counts)
    at = np.repeat(starts[place] - (after - counts), counts)
    at += np.arange(len(at))
    bounds = np.zeros(len(texts) + 1, np.int64)
    bounds[1:] = np.concatenate([[0], after])[ends]
    return known[at], bounds


def token_bytes(texts: list[str], definition: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers."""
    ids, bounds = token_ids(texts, definition)
    return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _pieces(definition, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, used = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            texts, first = batch.column(1).to_pylist(), 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last] or "") <= SLICE_CHARS):
                    size += len(texts[last] or "")
                    last += 1
                ids, bounds = token_ids([t or "" for t in texts[first:last]], definition.value, SEPARATOR)
                counts = -(-np.diff(bounds) // capacity)
                row = np.repeat(np.arange(last - first), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                begin = bounds[row] + piece * capacity
                end = np.minimum(begin + capacity, bounds[row + 1])
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                rank = np.empty(len(row), np.int64)
                for i, length in enumerate((end - begin).tolist()):
                    rank[i] = used[length]
                    used[length] += 1
                columns = {
                    "doc_id": batch.column(0).slice(first, last - first).take(pa.array(row)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(begin - bounds[row]),
                    "length": pa.array(end - begin),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "_part": pa.array(np.full(len(row), part, np.int64)),
                    "_rank": pa.array(rank),
                }
                if with_ids:
                    cuts = pa.array(4 * np.append(begin, end[-1:]), pa.int32())
                    columns["ids"] = pa.Array.from_buffers(
                        pa.binary(), len(row), [None, cuts.buffers()[1], pa.py_buffer(raw)]
                    )
                yield pa.RecordBatch.from_pydict(columns)
                first = last

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    max_tokens: int = 2048,
    with_ids: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Documents as pieces placed in sequences of at most ``max_tokens`` tokens.

    ``tokenizer`` is the path of a ``tokenizers`` definition; the driver reads it
    and ships it. A document is its ids and one separator id. Longer documents
    are cut into pieces of ``max_tokens``; only the last piece may be shorter.

    Returns ``doc_id, piece, start, length, ids`` (binary, unsigned 32-bit little
    endian)``, ids_crc32, sequence_id, offset``. The pieces are stored once. Without
    ``with_ids`` the ids are worked out and their checksums returned, but they are neither stored nor returned.

    A null text counts as empty and is packed as its separator alone. Repeated
    rows and repeated or null ids are packed row by row. An empty table gives an
    empty result. Other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = StructType(
        [
            StructField("doc_id", source.schema["doc_id"].dataType),
            StructField("piece", IntegerType()),
            StructField("start", LongType()),
            StructField("length", LongType()),
            StructField("ids_crc32", LongType()),
            StructField("_part", LongType()),
            StructField("_rank", LongType()),
            *([StructField("ids", BinaryType())] if with_ids else []),
        ]
    )
    pieces = freeze(source.mapInArrow(_pieces(definition, max_tokens, with_ids), schema), "pieces")
    per_part = freeze(pieces.groupBy("length", "_part").agg(F.count("*").alias("pieces")), "piece-counts")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("pieces").alias("n")).collect()}
    runs, _ = best_fit_decreasing(counts, max_tokens)
    plan = spark.createDataFrame(
        runs or [Run(0, 0, 0, 1, 0, 0)],
        "length bigint, first bigint, last bigint, each bigint, sequence bigint, base bigint",
    )
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select(
        "length", "_part", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("_before")
    )
    ranked = pieces.join(before, ["length", "_part"]).withColumn("_at", F.col("_before") + F.col("_rank"))
    # The plan's size depends on max_tokens alone, never on the corpus.
    p, q = ranked.alias("p"), F.broadcast(plan).alias("q")
    inside = F.col("_at") - F.col("q.first")
    return p.join(
        q,
        (F.col("p.length") == F.col("q.length"))
        & (F.col("_at") >= F.col("q.first"))
        & (F.col("_at") < F.col("q.last")),
    ).select(
        "doc_id",
        "piece",
        "start",
        F.col("p.length").alias("length"),
        *(["ids"] if with_ids else []),
        "ids_crc32",
        (F.col("q.sequence") + F.floor(inside / F.col("q.each")).cast("bigint")).alias("sequence_id"),
        (F.col("q.base") + inside % F.col("q.each") * F.col("p.length")).alias("offset"),
    )
