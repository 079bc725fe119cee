"""Spelling variants: words one edit apart, each led to its most frequent neighbour.

Near words are found by pivotal grams:

1. The bigrams of a word are put in one common order, rarest first. Its gram prefix are the
   first ``EDITS * 2 + 1`` occurrences, with all others of the last one's gram; its pivots are ``EDITS + 1`` disjoint
   occurrences among the first ones, chosen by dynamic programming so that they are rare together.
2. One edit touches at most one of two disjoint pivots. If two words are near, a pivot of one of them, the one whose
   prefix ends earlier in the order, is whole in the other, and the other's prefix reaches as
   far. So pivots are looked up in an index of all prefixes, and nothing else need be.
3. Position limits: letters on the other side of a whole pivot from the edit stay where they are, counted
   from the start or from the end. With two pivots the edit is left of, within or right of the first, or the
   second; each case says which letters of the word are untouched, and the index keys hold those around a
   gram, so that a rare bigram at a common place is no large group. Lengths differ by one at most, which is
   part of the key too.
4. What the look-up finds must have the untouched letters and is verified by the edit distance.

The number of bigrams is bounded by the alphabet, so their counts fit in any task. Everything else is
joined and grouped by word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import roots
from ledgerline.workspace import freeze

EDITS = 1
GRAM = 2
LEAST_LENGTH = 5
LEAST_COUNT = 3
DELETED_OF = 97  # a run loses a code point in documents where its checksum is a multiple
FLUSH = 200_000  # words that a task counts before it hands them on
LONG_TEXT = 1 << 22  # bytes from which the runs of a text are not listed at once

#: Fixed by the data contract: A-Z only are lower-cased, before this is applied.
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)


def misspelt(doc_id: int | None, run: str) -> str:
    """The word that a run stands for in a document: in some it lacks one code point."""
    checksum = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if checksum % DELETED_OF:
        return run
    place = checksum % len(run)
    return run[:place] + run[place + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial word counts of a task, handed on whenever there are many."""

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    counts: Counter = Counter()
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            data = text.as_py()
            if not data:
                continue
            data = data.lower().decode()  # bytes know A-Z only
            runs = _RUN.findall(data) if len(data) < LONG_TEXT else (m.group() for m in _RUN.finditer(data))
            for run, n in Counter(runs).items():
                word = misspelt(doc_id, run)
                if len(word) >= LEAST_LENGTH:
                    counts[word] += n
            if len(counts) >= FLUSH:
                yield rows(counts)
                counts = Counter()
    yield rows(counts)


def pivots(places: list[int], costs: list[int]) -> list[int]:
    """The ``EDITS + 1`` of these ascending places that are disjoint as grams and cost least together.

    Dynamic programming over (grams chosen, places looked at); the first of equal choices stays.
    """
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] * (len(places) + 1)]
    for chosen in range(1, EDITS + 2):
        row: list[tuple[int, tuple[int, ...]] | None] = [None]
        for i, place in enumerate(places):
            before = sum(p <= place - GRAM for p in places[:i])
            rest = best[chosen - 1][before if chosen > 1 else 0]
            with_it = rest and (rest[0] + costs[i], (*rest[1], place))
            without = row[i]
            row.append(with_it if without is None or (with_it and with_it[0] < without[0]) else without)
        best.append(row)
    return list(best[-1][-1][1])


def gram_prefix(word: str, lengths: dict[str, int]) -> tuple[list[int], list[int]]:
    """Places of the word's pivots and of its gram prefix."""
    grams = [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]
    order = sorted(range(len(grams)), key=lambda i: (lengths[grams[i]], grams[i], i))
    first = order[: EDITS * GRAM + 1]
    prefix = first + [i for i in order[len(first) :] if grams[i] == grams[first[-1]]]
    ascending = sorted(first)
    return pivots(ascending, [lengths[grams[i]] for i in ascending]), prefix


def held_keys(word: str, prefix: list[int]) -> list[str]:
    """Index keys of a word: each gram of its prefix with all letters on one side, alone or with the far end letter."""
    out = []
    for i in prefix:
        left, right = word[: i + GRAM], word[i:]
        out += [f"{left}<", f"{left}<{word[-1]}", f">{right}", f"{word[0]}>{right}"]
    return out


def asked_keys(word: str, first: int, second: int) -> list[tuple[str, str, str]]:
    """Keys under which every near word stands, for each place of the edit, with the untouched start and end."""
    after, last = first + GRAM, second + GRAM
    out = [
        (f"{word[:last]}<", word[:last], ""),  # right of the second pivot
        (f">{word[first:]}", "", word[first:]),  # left of the first
    ]
    within_first = f"{word[0]}>{word[second:]}" if first else f">{word[second:]}"
    out.append((within_first, word[:first], word[after:]))
    if last < len(word):  # between the pivots or within the second
        out.append((f"{word[:after]}<{word[-1]}", word[:after], word[last:]))
    else:
        out.append((f"{word[:after]}<{word[-1]}", word[:after], word[second:]))
        out.append((f"{word[:after]}<", word[:second], ""))
    return out


def _index_rows(lengths: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for word, n in zip(words, counts, strict=True):
                chosen, prefix = gram_prefix(word, lengths)
                out += [(word, n, len(word), key, None, None) for key in held_keys(word, prefix)]
                out += [(word, n, len(word), *asked) for asked in asked_keys(word, *chosen)]
            columns = zip(*out, strict=True) if out else [[]] * 6
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["word", "n", "size", "key", "start", "end"],
            )

    return run


def _grams(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.char_length(word) - GRAM + 1), lambda i: F.substring(word, i, F.lit(GRAM)))


def near_words(vocabulary: DataFrame) -> DataFrame:
    """Pairs of words exactly one edit apart, both ways: ``word, other, other_n``.

    ``vocabulary`` holds distinct words of at least ``LEAST_LENGTH`` code points with their counts
    (word, n) and is read several times, so it should be a stored table.
    """
    grams = vocabulary.select(F.explode(F.array_distinct(_grams(F.col("word")))).alias("gram"))
    lengths = {row.gram: row["count"] for row in grams.groupBy("gram").count().collect()}
    index = freeze(
        vocabulary.select("word", "n").mapInArrow(
            _index_rows(lengths), "word string, n bigint, size int, key string, start string, end string"
        ),
        "gram-index",
    )
    # Joined by a hash of key and length: what it confuses does not pass the verification.
    sizes = F.explode(F.array([F.col("size") + d for d in range(-EDITS, EDITS + 1)]))
    asking = index.where("start IS NOT NULL").select("*", sizes.alias("_size")).select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), "start", "end", F.xxhash64("key", "_size").alias("key")
    )
    held = index.where("start IS NULL").select(
        F.col("word").alias("b"), F.col("n").alias("b_n"), F.xxhash64("key", "size").alias("key")
    )
    found = (
        asking.join(held, "key")
        .where(F.col("b").startswith(F.col("start")) & F.col("b").endswith(F.col("end")) & (F.col("a") != F.col("b")))
        .where(F.levenshtein("a", "b", EDITS) == EDITS)
        .select("a", "a_n", "b", "b_n")
    )
    both = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    ))
    return found.select(both.alias("_p")).select("_p.*").distinct()


def spelling_variants(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per word: ``word, n, n_near, form, form_n, root``.

    Words come from maximal runs of ``A-Z``, ``a-z`` and U+00C0 to U+00FF, A-Z lower-cased; in documents
    where the checksum of ``<doc_id>:<run>`` is a multiple of ``DELETED_OF`` the run lacks one code point
    (``misspelt``). Words have at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences.
    ``form`` is the near word of largest count, the first in code-point order of several, if it is at
    least twice as frequent, else null; ``root`` is the end of the chain of forms.

    Null and empty texts have no words; a null id counts as an empty one in the checksum. Repeated rows count each
    time. An empty table gives an empty result. Other columns are not looked at.
    """
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    counts = source.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = freeze(counts.where(F.col("n") >= LEAST_COUNT), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("_n"), F.col("other").alias("other")))
    near = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_best"))
    led = -F.col("_best._n") >= 2 * F.col("n")
    words = freeze(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(led, F.col("_best.other")).alias("form"), F.when(led, -F.col("_best._n")).alias("form_n"),
        ),
        "words",
    )
    # A form is more frequent than its word, so chains end.
    ends = roots(words.where("form IS NOT NULL").select(F.col("word").alias("node"), F.col("form").alias("parent")))
    return words.join(ends.withColumnRenamed("node", "word"), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
