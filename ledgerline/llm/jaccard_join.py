"""Documents linked by the Jaccard similarity of their word shingles, by T-occurrence search.

1. Documents with equal shingle sets form a class; one node stands for it from here on.
2. Two linked sets share at least ``need`` shingles, ``percent`` hundredths of either, so among the
   ``size - need + k`` first of each in any common order they share at least ``k``. A first
   pass takes the order of the hashes and shuffles only these prefixes, a fifth of the shingles at 90 %; nodes with
   fewer than ``k`` repeated shingles in them have no partner and are done.
3. For the nodes that stay, all shingles are counted, and the common order becomes the
   one of inverted-list length, shortest first. Shingles of one node only cannot be
   shared; nodes with fewer than ``need`` others are done too.
4. Every node has a home, a shingle of its new prefix that related nodes choose too. Searches meet in homes: residents,
   in blocks of bounded size, are indexed by inverted lists, and visitors, in slices of
   bounded size, search them. A search heap-merges its short lists, skipping ahead
   where a document cannot reach the overlap any more, binary-probes the long ones for the documents
   found, and keeps those that reach the required overlap (DivideSkip).
5. Links join nodes to components in three rounds. First nodes search some residents of their own
   home, then some of the home of one leader for each shared prefix shingle, and at
   last, for prefix shingles that still hold several components, every block of every
   home that holds another component. The last round is exhaustive for what is still apart, so
   no link between components is lost; nodes that are already together are not compared
   again, so a large family of copies costs no pairs.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words
from ledgerline.llm.components import connected_components
from ledgerline.workspace import freeze, release

BLOCK = 256  # residents that are indexed together
BLOCK_SHINGLES = 1 << 18  # and their shingles, but for a single longer set
SLICE = 1024  # visitors that search an index in one task
EXTRA = 10  # hundredths of a set by which the first pass lengthens its prefixes (k above)
LENGTH_STEPS = 32  # steps in which list lengths are told apart, for each doubling
PROBE_COST = 0.02  # weight of a binary probe against a step of the merge


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and the first of each text."""
    values, firsts = words.shingles(*words.hashed_words(texts), n)
    sets = [np.unique(values[a:b]) for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
    bounds = np.zeros(len(sets) + 1, dtype=np.int64)
    np.cumsum([len(s) for s in sets], out=bounds[1:])
    return np.concatenate(sets) if sets else values, bounds


def least_overlap(size: int | np.ndarray, percent: int):
    """Shingles that a set of this size shares with any partner."""
    return -(-percent * size // 100)


def extra_overlap(size):
    """The ``k`` of a set of this size, as a number, an array or a column; larger sets have no smaller one."""
    return (EXTRA * size + 100) // 100 if not isinstance(size, Column) else F.floor((size * EXTRA + 100) / 100)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(words.signed(values)))


def _sets(n: int, percent: int, *, whole: bool):
    """Identity of each document's set, and the set itself or only its hash-order prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in words.chunks(batch.column(1)):
                values, bounds = shingle_sets(texts, n)
                sizes = np.diff(bounds)
                some = np.flatnonzero(sizes)
                keys = np.zeros((2, len(sizes)), np.uint64)
                if len(some):
                    keys[0, some] = np.add.reduceat(words.mixed(values), bounds[:-1][some])
                    keys[1, some] = np.add.reduceat(words.mixed(values ^ np.uint64(0x2545F4914F6CDD1D)), bounds[:-1][some])
                held = sizes
                if not whole:
                    held = np.minimum(sizes, sizes - least_overlap(sizes, percent) + extra_overlap(sizes))
                if not whole and len(values):
                    inside = np.arange(len(values)) - np.repeat(bounds[:-1], sizes)
                    values = values[inside < np.repeat(held, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(sizes),
                        pa.array(words.signed(keys[0])),
                        pa.array(words.signed(keys[1])),
                        _lists(values, held),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "shingles"],
                )

    return run


_SET_COLUMNS = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, shingles array<bigint>"


def merge_skip(lists: list[tuple[list[int], int, int]], enough: int) -> Iterator[tuple[int, int]]:
    """Numbers that at least ``enough`` of the sorted lists hold, with how many do.

    A list comes with the part of it that counts (start, end). Numbers that cannot be held often enough, because
    fewer than ``enough`` lists are as far back, are skipped by binary search.
    """
    heap = [(values[start], k, start) for k, (values, start, end) in enumerate(lists) if start < end]
    heapq.heapify(heap)
    while len(heap) >= enough:
        number = heap[0][0]
        taken = []
        while heap and heap[0][0] == number:
            taken.append(heapq.heappop(heap))
        if len(taken) >= enough:
            yield number, len(taken)
            goal = number + 1
        else:
            while heap and len(taken) < enough - 1:
                taken.append(heapq.heappop(heap))
            if not heap:
                return
            # Fewer than ``enough`` lists hold anything before this number.
            goal = max(heap[0][0], number + 1)
        for _, k, at in taken:
            values, _, end = lists[k]
            at = bisect_left(values, goal, at, end)
            if at < end:
                heapq.heappush(heap, (values[at], k, at))


class InvertedLists:
    """Sets of a block by inverted lists; sets are numbered by ascending size."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int], percent: int) -> None:
        self.percent = percent
        self.order = sorted(range(len(sets)), key=lambda i: sizes[i])
        self.sizes = [sizes[i] for i in self.order]
        self.lists: dict[int, list[int]] = {}
        for number, i in enumerate(self.order):
            for shingle in sets[i].tolist():
                self.lists.setdefault(shingle, []).append(number)

    def search(self, shingles: np.ndarray, size: int, wanted=lambda i: True) -> Iterator[int]:
        """Sets, by their number in the call, whose similarity with this one is enough.

        ``wanted`` is asked before a set is probed, so answers that are known already cost no probes.
        """
        percent = self.percent
        first = bisect_left(self.sizes, least_overlap(size, percent))
        last = bisect_left(self.sizes, 100 * size // percent + 1)
        if first == last:
            return
        found = []
        for shingle in shingles.tolist():
            values = self.lists.get(shingle)
            if values:
                start, end = bisect_left(values, first), bisect_left(values, last)
                if start < end:
                    found.append((values, start, end))
        # Required overlap: 100 * shared >= percent * (size + other - shared).
        enough = -(-percent * (size + self.sizes[first]) // (100 + percent))
        if len(found) < enough:
            return
        found.sort(key=lambda part: part[2] - part[1])
        longest = found[-1][2] - found[-1][1]
        n_long = min(enough - 1, int(enough / (PROBE_COST * math.log2(longest + 1) + 1)))
        short, long = found[: len(found) - n_long], found[len(found) - n_long :]
        for number, shared in merge_skip(short, enough - n_long):
            other = self.order[number]
            if not wanted(other):
                continue
            goal = -(-percent * (size + self.sizes[number]) // (100 + percent))
            for k, (values, start, end) in enumerate(long):
                if shared >= goal or shared + len(long) - k < goal:
                    break
                at = bisect_left(values, number, start, end)
                shared += at < end and values[at] == number
            if shared >= goal:
                yield other


def _meeting(percent: int):
    """Links between components, enough to join them, in one block and slice of a home."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        residents, visitors = frame[frame.resident], frame[~frame.resident]
        out: list[tuple[int, int]] = []
        if len(residents) and len(visitors):
            root: dict[int, int] = {}

            def top(c: int) -> int:
                while root.get(c, c) != c:
                    c = root[c]
                return c

            nodes, groups = residents.node.tolist(), residents.component.tolist()
            index = InvertedLists(list(residents.ranked), residents["size"].tolist(), percent)
            for node, own, size, ranked in zip(
                visitors.node.tolist(), visitors.component.tolist(), visitors["size"].tolist(), visitors.ranked, strict=True
            ):
                for i in index.search(ranked, size, lambda i, own=own: top(groups[i]) != top(own)):
                    low, high = sorted((top(groups[i]), top(own)))
                    root[high] = low
                    out.append((nodes[i], node))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def _part(column: str, count: Column) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(11)), count).cast("int")


def _upto(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), count.cast("int") - 1))


def _meet(nodes: DataFrame, labels: DataFrame | None, visits: DataFrame | None, *, percent: int, every_block: bool) -> DataFrame:
    """Links (a, b) that visitors (node, home) find among the residents of the homes.

    Without ``labels`` every node is a component, and without ``visits`` it visits its own home. With ``every_block`` all residents are searched,
    otherwise one block of them for each home.
    """
    placed = nodes.withColumn("component", F.col("node")) if labels is None else nodes.join(labels, "node")
    visitors = placed if visits is None else visits.join(placed.drop("home"), "node")
    asked = (nodes if visits is None else visits).groupBy("home").agg(F.ceil(F.count("*") / SLICE).alias("slices"))
    # A block is bounded in residents and, for long texts, in shingles.
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES))
    homes = nodes.groupBy("home").agg(blocks.alias("blocks"), F.count("*").alias("n")).join(asked, "home")
    homes = freeze(homes.where("n > 1" if visits is None else "n > 0"), "homes")
    columns = ["home", "block", "slice", "node", "size", "component", "ranked", "resident"]
    residents = placed.join(homes, "home").withColumn("block", _part("node", F.col("blocks")))
    visitors = visitors.join(homes, "home").withColumn("slice", _part("node", F.col("slices")))
    if every_block:
        visitors = visitors.select("*", _upto(F.col("blocks")).alias("block"))
    else:
        residents = residents.where("block = 0")
        visitors = visitors.withColumn("block", F.lit(0))
    residents = residents.select("*", _upto(F.col("slices")).alias("slice")).withColumn("resident", F.lit(True))
    visitors = visitors.withColumn("resident", F.lit(False))
    seated = residents.select(*columns).unionByName(visitors.select(*columns))
    return seated.groupBy("home", "block", "slice").applyInPandas(_meeting(percent), "a bigint, b bigint")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, component) after the links (a, b) bring components together."""
    links = freeze(links, "links")
    ends = links.join(labels.toDF("a", "_a"), "a").join(labels.toDF("b", "_b"), "b")
    over = freeze(connected_components(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b"))), "components")
    moved = labels.join(over.toDF("component", "_over"), "component", "left")
    return freeze(moved.select("node", F.coalesce("_over", "component").alias("component")), "labels")


def jaccard_components(
    docs: DataFrame,
    *,
    shingle_words: int = 3,
    percent: int = 90,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Two documents are linked if the Jaccard similarity of their sets of distinct shingles is at
    least ``percent`` hundredths; ``component_id`` is the smallest id reachable over links. Words are
    runs of characters other than space and 0x09-0x0D, with A-Z lower-cased; a text of fewer words
    than a shingle has is one shingle. Shingles are compared by 64-bit hashes.

    Null, empty and wordless texts have ``n_shingles`` 0 and are linked with nothing. Rows that repeat
    an id keep a row each and are told apart by their sets; all of them get the smallest id that
    their own text reaches. Null ids are linked with nothing and have a null component. An empty table gives an empty
    result. Other columns of ``docs`` are not looked at.
    """
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    sketches = freeze(source.mapInArrow(_sets(shingle_words, percent, whole=False), _SET_COLUMNS), "prefixes")
    listed = freeze(sketches.select("doc_id", "n_shingles", "set_a", "set_b"), "listed")
    classes = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("size"), F.first("shingles").alias("prefix")
    )
    # Numbered once, in a stored table: ids may repeat with different texts.
    prefixes = freeze(classes.withColumn("node", F.monotonically_increasing_id()), "class-prefixes")
    classes = freeze(prefixes.drop("prefix"), "classes")
    release(sketches)

    # Tables of shingles grow with the input and are joined by sorting at every size.
    firsts = prefixes.select("node", "size", F.explode("prefix").alias("shingle"))
    repeated = firsts.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    # A partner has at least ``need`` shingles and a k to match.
    need = F.ceil(F.col("size") * percent / 100)
    enough = F.least(extra_overlap(need), need)
    able = firsts.join(repeated.hint("merge"), "shingle").groupBy("node", "size").count().where(F.col("count") >= enough)
    wanted = freeze(classes.join(able.select("node"), "node").withColumnRenamed("rep", "doc_id"), "wanted")
    release(prefixes)
    texts = source.join(wanted.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    full = texts.mapInArrow(_sets(shingle_words, percent, whole=True), _SET_COLUMNS)
    sets = freeze(
        full.join(wanted, ["doc_id", "set_a", "set_b"]).select("node", "size", "shingles").dropDuplicates(["node"]), "sets"
    )

    postings = sets.select("node", "size", F.explode("shingles").alias("shingle"))
    lists = postings.groupBy("shingle").agg(F.count("*").alias("length")).where("length > 1")
    ranked = (
        postings.join(lists.hint("merge"), "shingle").groupBy("node", "size")
        .agg(F.sort_array(F.collect_list(_ranked(F.col("length"), F.col("shingle")))).alias("ranked"))
        .withColumn("_prefix", F.slice("ranked", F.lit(1), F.greatest(F.size("ranked") - need + 1, F.lit(0)).cast("int")))
        .where(F.size("_prefix") > 0)
    )
    nodes = freeze(ranked.select("node", "size", _home(F.col("_prefix")).alias("home"), "ranked"), "nodes")
    release(sets)
    keys = F.slice("ranked", F.lit(1), (F.size("ranked") - need + 1).cast("int"))
    held = freeze(nodes.select("node", "size", "home", F.explode(keys).alias("key")), "held")
    labels = nodes.select("node", F.col("node").alias("component"))

    def undecided() -> DataFrame:
        """Prefix shingles (key, node, size, home, component) of keys that hold several components."""
        placed = held.join(labels, "node")
        mixed = placed.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
        return freeze(placed.join(mixed.where("_low < _high").select("key"), "key", "left_semi"), "undecided")

    labels = _merged(labels, _meet(nodes, None, None, percent=percent, every_block=False))

    apart = undecided()
    leaders = apart.groupBy("key").agg(F.min_by(F.struct("home", "component"), F.xxhash64("node", "key")).alias("leader"))
    visits = apart.join(leaders, "key").where("component <> leader.component").select("node", "leader.home").distinct()
    labels = _merged(labels, _meet(nodes, labels, freeze(visits, "visits"), percent=percent, every_block=False))

    apart = undecided()
    places = apart.groupBy("key", "home").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"),
        F.min("size").alias("_least"), F.max("size").alias("_most"),
    )
    fits = (F.col("size") * percent <= F.col("_most") * 100) & (F.col("_least") * percent <= F.col("size") * 100)
    other = (F.col("_low") != F.col("component")) | (F.col("_high") != F.col("component"))
    # Of two homes it is enough that the nodes of one visit the other.
    visits = (
        apart.select("key", "node", "size", "component", F.col("home").alias("_own")).join(places, "key")
        .where(fits & other & (F.col("_own") >= F.col("home"))).select("node", "home").distinct()
    )
    labels = _merged(labels, _meet(nodes, labels, freeze(visits, "visits"), percent=percent, every_block=True))

    ends = classes.join(labels, "node").select("set_a", "set_b", "rep", "component")
    names = ends.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = freeze(ends.join(names, "component").select("set_a", "set_b", "component_id"), "names")
    whole = classes.select("set_a", "set_b", "rep").join(named, ["set_a", "set_b"], "left")
    whole = whole.select("set_a", "set_b", F.coalesce("component_id", "rep").alias("_component"))
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("_component")).otherwise(F.col("doc_id"))
    return listed.join(whole, ["set_a", "set_b"], "left").select("doc_id", "n_shingles", component.alias("component_id"))


def _ranked(length: Column, shingle: Column) -> Column:
    """A shingle as one number whose order is that of list lengths: 11 bits for the length, 52 of the hash.

    52 bits tell the shingles of two documents apart as well as 64 do; equal numbers of strangers only make them meet.
    """
    steps = F.floor(F.log2(length.cast("double")) * LENGTH_STEPS).cast("bigint")
    return F.shiftleft(steps, 52).bitwiseOR(F.shiftrightunsigned(shingle, 12))


def _home(prefix: Column) -> Column:
    """One shingle of a prefix.

    The least of exponential numbers drawn for each shingle at the rate of its list's length: related sets choose
    the same one mostly, and shared shingles win over chance ones.
    """

    def drawn(entry: Column) -> Column:
        uniform = (F.shiftrightunsigned(F.xxhash64(entry), 12) + 0.5) / 2.0**52
        length = F.pow(F.lit(2.0), F.shiftright(entry, 52) / LENGTH_STEPS)
        return F.struct((-F.log(uniform) / length).alias("draw"), entry.alias("shingle"))

    return F.array_min(F.transform(prefix, drawn))["shingle"]
