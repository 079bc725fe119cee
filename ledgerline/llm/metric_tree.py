"""Exact top-k search by inner product with M-trees.

The upper level of the tree holds regions: a bounded sample of the rows are pivots, each row belongs to the pivot
nearest to it, and a region knows its covering radius and its longest vector. A region
of more than ``SHARD_ROWS`` rows is split by a hash of the id into shards. Each shard becomes an M-tree of
paged nodes: a node has a pivot, a covering radius, its pivot's distance to the
parent's pivot, and either child nodes or up to ``PAGE`` vectors with their
distances to the pivot. The pages are stored as a table.

A query first searches its most promising regions, as many as hold k rows, one shard of each. With the k-th score found there
it goes only to shards of regions whose bound ``<q, pivot> + |q| * radius`` (or ``|q|`` times the longest vector) reaches that score, and skips
their nodes likewise. The queries of a shard are dealt into blocks of bounded size; the answers of a
query are merged at the end. How many shards a query visits depends on how the vectors cluster: vectors without
clusters in many dimensions, such as random ones, must visit nearly all.

Inner products become distances by one more coordinate, sqrt(M^2 - |x|^2) for
vectors (M: the shard's largest norm) and 0 for queries: then
``2 <q, x> = |q|^2 + M^2 - d(q, x)^2``, and a lower bound of the distance is an upper
bound of the score. Scores themselves are integers and exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.workspace import freeze

PAGE = 1024  # vectors in a leaf
FANOUT = 16  # children of an inner node
SHARD_ROWS = 16_384
REGION_ROWS = 4_096  # rows for each pivot of the upper level, while these are fewer than REGIONS
REGIONS = 1_024  # most pivots: they are broadcast
SAMPLED = 4  # rows from which a pivot is chosen
BLOCK_QUERIES = 1_024
ROUTED_ROWS = 1_024  # rows whose distances to all pivots a task holds at once
EXACT = 2.0**53  # integers below it are exact as doubles
LARGEST_SCORE = 2.0**63 * (1 - 1e-9)  # no score exceeds the largest squared norm

_SHARD = ("dim", "region", "part")
_PAGES = (
    "dim int, region int, part bigint, node int, parent int, pivot array<double>, radius double, to_parent double, "
    "least_id bigint, largest double, ids array<bigint>, vectors binary, distances array<double>"
)


def _quantised(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, norms, out = [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i is None or not v or any(x is None for x in v):
                    continue
                x = np.floor(scale * np.array(v, dtype=np.float64))
                if np.isfinite(x).all():
                    ids.append(i)
                    dims.append(len(x))
                    norms.append(float((x * x).sum()))
                    out.append(x.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(out, pa.binary())],
                names=["vec_id", "dim", "norm", "vector"],
            )

    return run


def _rounded_down(score: int) -> float:
    """The score as a double that is not above it."""
    return float(score) if abs(score) < EXACT else math.nextafter(float(score), -math.inf)


def _distance(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - pivot) ** 2).sum(axis=1))


def build_tree(ids: np.ndarray, vectors: np.ndarray) -> list[dict]:
    """Pages of an M-tree over one shard; parents come before their children."""
    norms = (vectors**2).sum(axis=1)
    largest = float(norms.max())
    points = np.column_stack([vectors, np.sqrt(np.maximum(largest - norms, 0))])
    pages: list[dict] = []
    open_ = [(np.argsort(ids, kind="stable"), -1)]
    while open_:
        own, parent = open_.pop()
        part = points[own]
        pivot = part[np.argmin(_distance(part, part.mean(axis=0)))]
        far = _distance(part, pivot)
        node = len(pages)
        leaf = len(own) <= PAGE
        pages.append(
            {
                "node": node, "parent": parent, "pivot": pivot, "radius": float(far.max()), "largest": largest,
                "to_parent": 0.0 if parent < 0 else float(_distance(pivot[None], pages[parent]["pivot"])[0]),
                "least_id": int(ids[own].min()), "ids": ids[own] if leaf else ids[:0],
                "vectors": vectors[own].tobytes() if leaf else b"", "distances": far if leaf else far[:0],
            }
        )
        if not leaf:
            open_ += [(own[group], node) for group in _split(part)]
    return pages


def _split(points: np.ndarray) -> list[np.ndarray]:
    """Row numbers by nearest seed; seeds are far from each other. Copies go by rank."""
    count = min(FANOUT, -(-len(points) // PAGE))
    seeds, nearest = [0], _distance(points, points[0])
    owner = np.zeros(len(points), dtype=np.int64)
    while len(seeds) < count and nearest.max() > 0:
        seeds.append(int(nearest.argmax()))
        far = _distance(points, points[seeds[-1]])
        owner[far < nearest] = len(seeds) - 1
        nearest = np.minimum(nearest, far)
    groups = [np.flatnonzero(owner == k) for k in range(len(seeds))]
    groups = [g for g in groups if len(g)]
    return groups if len(groups) > 1 else np.array_split(np.arange(len(points)), count)


class Tree:
    """Pages of one shard, ready to be searched."""

    def __init__(self, pages: pd.DataFrame, dim: int) -> None:
        pages = pages.sort_values("node")
        self.dim, self.largest = dim, float(pages.largest.iloc[0])
        self.radius, self.to_parent = pages.radius.to_numpy(), pages.to_parent.to_numpy()
        self.least = pages.least_id.to_numpy()
        self.pivots = np.stack([np.asarray(p) for p in pages["pivot"]])
        parents = pages.parent.to_numpy()
        self.children = {n: np.flatnonzero(parents == n) for n in np.unique(parents)}
        self.leaves = {
            n: (np.asarray(i), np.frombuffer(v, np.float64).reshape(-1, dim), np.asarray(d))
            for n, i, v, d in zip(pages.node, pages.ids, pages.vectors, pages.distances, strict=True)
            if len(i)
        }
        self.spread = max((float(np.abs(v).max()) for _, v, _ in self.leaves.values()), default=0.0)

    def top(
        self, query: np.ndarray, own: int, k: int, worst: float = -math.inf, worst_id: int = 0
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best, without the row ``own``.

        Rows that rank behind a score of ``worst`` with the id ``worst_id`` may be missing.
        """
        whole = float((query**2).sum()) + self.largest
        slack = 1e-9 * whole + 1e-6
        exact = float(np.abs(query).max(initial=0.0)) * self.spread * self.dim < EXACT
        point = np.append(query, 0.0)

        def at_most(lower):
            """Largest integer score at a distance of at least ``lower``."""
            return np.floor((whole - np.maximum(lower, 0.0) ** 2) / 2 + slack)

        ids, scores = np.zeros(0, np.int64), np.zeros(0) if exact else np.zeros(0, object)
        root = float(_distance(self.pivots[:1], point)[0])
        queue = [(-float(at_most(root - self.radius[0])), int(self.least[0]), 0, root)]
        while queue:
            bound, least, node, to_pivot = heapq.heappop(queue)
            if -bound < worst or (-bound == worst and least > worst_id):
                if -bound < worst:
                    break
                continue
            if node in self.leaves:
                own_ids, vectors, distances = self.leaves[node]
                # |d(q, pivot) - d(x, pivot)| bounds d(q, x) without computing it.
                near = np.flatnonzero(at_most(np.abs(to_pivot - distances)) >= worst)
                near = near[own_ids[near] != own]
                if not len(near):
                    continue
                if exact:
                    found = vectors[near] @ query
                else:
                    found = np.array([sum(int(a) * int(b) for a, b in zip(v, query, strict=True)) for v in vectors[near]], object)
                ids, scores = np.concatenate([ids, own_ids[near]]), np.concatenate([scores, found])
                order = np.lexsort((ids, -scores.astype(np.float64)))[:k] if exact else np.array(
                    sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)
                ids, scores = ids[order], scores[order]
                if len(ids) == k:
                    last, last_id = (float(scores[-1]) if exact else _rounded_down(int(scores[-1]))), int(ids[-1])
                    if last > worst or (last == worst and last_id < worst_id):
                        worst, worst_id = last, last_id
                continue
            children = self.children.get(node, ())
            if len(children):
                lower = np.abs(to_pivot - self.to_parent[children]) - self.radius[children]
                children = children[at_most(lower) >= worst]
                far = _distance(self.pivots[children], point) if len(children) else ()
                for child, d, b in zip(children, far, at_most(far - self.radius[children]) if len(children) else (), strict=True):
                    if b >= worst:
                        heapq.heappush(queue, (-float(b), int(self.least[child]), int(child), float(d)))
        return ids, scores


def _spread_out(points: np.ndarray, wanted: int) -> np.ndarray:
    """So many of the points: the first half as they come, the others each farthest from all before."""
    chosen = list(range(min(len(points), (wanted + 1) // 2)))
    nearest = np.min([_distance(points, points[i]) for i in chosen], axis=0)
    while len(chosen) < wanted and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distance(points, points[chosen[-1]]))
    return points[chosen]


class Regions:
    """Upper level of the tree: pivots of each vector length, with what is known of the rows around them."""

    def __init__(self, sample: list[tuple[int, bytes]], wanted: int) -> None:
        self.pivots: dict[int, np.ndarray] = {}
        for dim in sorted({d for d, _ in sample}):
            own = [v for d, v in sample if d == dim]
            points = np.stack([np.frombuffer(v, np.float64) for v in dict.fromkeys(own)])
            self.pivots[dim] = _spread_out(points, max(1, wanted * len(own) // len(sample)))
        self.radius = {dim: np.zeros(len(p)) for dim, p in self.pivots.items()}
        self.longest = {dim: np.zeros(len(p)) for dim, p in self.pivots.items()}
        self.rows = {dim: np.zeros(len(p)) for dim, p in self.pivots.items()}

    def measured(self, dim: int, region: int, radius: float, norm: float, rows: float) -> None:
        self.radius[dim][region], self.longest[dim][region], self.rows[dim][region] = radius, math.sqrt(norm), rows

    def nearest(self, dim: int, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Region of each point and its distance to the pivot; -1 where no pivot has this length."""
        if dim not in self.pivots:
            return np.full(len(points), -1), np.zeros(len(points))
        pivots = self.pivots[dim]
        region = ((pivots**2).sum(axis=1)[None] - 2 * points @ pivots.T).argmin(axis=1)
        return region, np.sqrt(((points - pivots[region]) ** 2).sum(axis=1))

    def likeliest(self, dim: int, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, region) numbers with which to start: by the pivot's score, until ``k`` other rows are there."""
        if dim not in self.pivots:
            return np.arange(len(queries)), np.full(len(queries), -1)
        best_first = (-queries @ self.pivots[dim].T).argsort(axis=1, kind="stable")
        rows = self.rows[dim][best_first]
        query, place = np.nonzero((rows.cumsum(axis=1) - rows <= k) & (rows > 0))
        return query, best_first[query, place]

    def reaching(self, dim: int, queries: np.ndarray, worst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, region) numbers where a row of the region may score at least ``worst``."""
        if dim not in self.pivots:
            return np.arange(len(queries)), np.full(len(queries), -1)
        length = np.sqrt((queries**2).sum(axis=1))[:, None]
        at_pivot, spread = queries @ self.pivots[dim].T, length * self.radius[dim]
        bound = np.minimum(at_pivot + spread, length * self.longest[dim])
        size = length * np.sqrt((self.pivots[dim] ** 2).sum(axis=1)) + spread
        return np.nonzero(bound + 1e-9 * size + 1e-6 >= worst[:, None])


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, vectors) of a batch, so many rows at a time."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        for first in range(0, len(rows), ROUTED_ROWS):
            some = rows[first : first + ROUTED_ROWS]
            vectors = batch.column("vector").take(pa.array(some)).to_pylist()
            yield int(dim), some, np.stack([np.frombuffer(v, np.float64) for v in vectors])


def _with_regions(shared):
    """Add each row's region and its distance to the pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for dim, rows, points in _by_length(batch):
                region[rows], far[rows] = shared.value.nearest(dim, points)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region), pa.array(far)], names=[*batch.schema.names, "region", "far"])

    return run


def _with_routes(shared, start: int | None = None):
    """One row for each query and region: those to start with (for so many answers), or those that may hold better rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            worst = np.array([-math.inf if s is None else _rounded_down(s) for s in batch.column("worst").to_pylist()])
            for dim, rows, points in _by_length(batch):
                regions = shared.value
                query, region = regions.reaching(dim, points, worst[rows]) if start is None else regions.likeliest(dim, points, start)
                for first in range(0, len(query), 16 * ROUTED_ROWS):
                    some = slice(first, first + 16 * ROUTED_ROWS)
                    routed = batch.take(pa.array(rows[query[some]]))
                    yield pa.RecordBatch.from_arrays(
                        [*routed.columns, pa.array(region[some].astype(np.int32))], names=[*batch.schema.names, "region"]
                    )

    return run


def _built(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("vec_id")
    vectors = np.stack([np.frombuffer(v, np.float64) for v in frame.vector])
    pages = pd.DataFrame(build_tree(frame.vec_id.to_numpy(), vectors))
    for name in _SHARD:
        pages[name] = frame[name].iloc[0]
    return pages[[c.split()[0] for c in _PAGES.split(", ")]]


def _searched(k: int):
    def run(pages: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(pages) and len(queries):
            tree = Tree(pages, int(pages.dim.iloc[0]))
            for own, vector, worst, worst_id in zip(queries.vec_id, queries.vector, queries.worst, queries.worst_id, strict=True):
                known = (-math.inf, 0) if worst is None else (_rounded_down(int(worst)), int(worst_id))
                ids, scores = tree.top(np.frombuffer(vector, np.float64), int(own), k, *known)
                out += [(int(own), int(i), int(s)) for i, s in zip(ids, scores, strict=True) if s >= known[0]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def _answers(routes: DataFrame, pages: DataFrame, k: int) -> DataFrame:
    """Search each shard for the queries that are routed to it, a block of them at a time."""
    blocks = F.ceil(F.count("*") / F.lit(BLOCK_QUERIES)).cast("bigint")
    needed = routes.groupBy(*_SHARD).agg(blocks.alias("blocks"))
    keys = [*_SHARD, "block"]
    left = pages.join(needed, list(_SHARD)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    right = routes.join(needed, list(_SHARD)).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(5)), "blocks"))
    # The worst score goes as text: pandas would make a nullable number a double.
    right = right.withColumn("worst", F.col("worst").cast("string"))
    return left.drop("blocks").groupBy(*keys).cogroup(right.drop("blocks").groupBy(*keys)).applyInPandas(
        _searched(k), "query_id bigint, vec_id bigint, score bigint"
    )


def top_inner_products(
    vectors: DataFrame,
    *,
    k: int = 20,
    every: int = 20,
    scale: float = 64.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Each query's ``k`` best rows: ``query_id, rank, vec_id, score``.

    Components become ``floor(scale * x)``. Queries are the rows whose id is divisible
    by ``every``; candidates are all rows with another id. The score is the integer
    inner product; ties go to the smaller id, and with fewer candidates all are
    returned.

    Vectors that are null, empty, or hold a null or non-finite component take no
    part, nor do null ids. Rows that repeat an id count once. Only vectors of equal
    length are compared. Vectors so large that a score could leave 64 bits raise a
    ``ValueError``. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).alias("vector"))
    usable = source.mapInArrow(_quantised(scale), "vec_id bigint, dim int, norm double, vector binary")
    once = freeze(usable.groupBy("vec_id").agg(F.min(F.struct("dim", "vector", "norm")).alias("v")).select("vec_id", "v.*"), "vectors")
    sizes = once.agg(
        F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q"), F.max("norm").alias("norm")
    ).first()
    if sizes["norm"] is not None and not sizes["norm"] < LARGEST_SCORE:
        raise ValueError(f"squared norms up to {sizes['norm']:.3g}: scores may leave 64 bits")
    routes, first, pages = routed_queries(once, sizes["n"], k, every)
    found = first.unionByName(_answers(routes, pages, k))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def routed_queries(once: DataFrame, rows: int, k: int, every: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Routes of queries to shards, what their first shards answered, and the pages.

    A route is a row ``vec_id, dim, vector, worst, worst_id, region, part``: a shard that the query must still
    visit, and the k-th score and id that it has.
    """
    spark = once.sparkSession
    wanted = max(1, min(REGIONS, math.ceil(rows / REGION_ROWS)))
    # Bounded: at most SAMPLED * REGIONS vectors, and a row of statistics for each pivot.
    sample = once.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(SAMPLED * wanted).select("dim", "vector").collect()
    regions = Regions([(r["dim"], bytes(r["vector"])) for r in sample], wanted)
    columns = f"{', '.join(f'{n} {t}' for n, t in once.dtypes)}, region int, far double"
    dealt = once.mapInArrow(_with_regions(spark.sparkContext.broadcast(regions)), columns)
    known = freeze(
        dealt.groupBy("dim", "region").agg(
            F.ceil(F.count("*") / F.lit(SHARD_ROWS)).cast("bigint").alias("parts"),
            F.max("far").alias("far"), F.max("norm").alias("norm"), F.count("*").alias("n"),
        ),
        "regions",
    )
    for r in known.where("region >= 0").toLocalIterator():
        # Parts are dealt by a hash, so one has hardly less than half of its share.
        regions.measured(r["dim"], r["region"], r["far"], r["norm"], r["n"] if r["parts"] == 1 else r["n"] / r["parts"] / 2)
    shared = spark.sparkContext.broadcast(regions)
    parts = known.select("dim", "region", "parts")
    part = F.pmod(F.xxhash64("vec_id", F.lit(7)), "parts").alias("part")
    shards = dealt.join(parts, ["dim", "region"]).select("vec_id", "vector", "dim", "region", part)
    pages = freeze(shards.groupBy(*_SHARD).applyInPandas(_built, _PAGES), "tree-pages")

    asked = once.where(F.col("vec_id") % every == 0).select("vec_id", "dim", "vector")
    route = "vec_id bigint, dim int, vector binary, worst bigint, worst_id bigint, region int"
    unknown = [F.lit(None).cast("bigint").alias(name) for name in ("worst", "worst_id")]
    starts = asked.select("*", *unknown).mapInArrow(_with_routes(shared, k), route).join(parts, ["dim", "region"])
    starts = starts.select("vec_id", "vector", "worst", "worst_id", "dim", "region", part)
    first = freeze(_answers(starts, pages, k), "first-answers")
    last = _ranked(first, k).where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").alias("worst"), F.col("vec_id").alias("worst_id")
    )
    open_ = asked.join(last, "vec_id", "left").select("vec_id", "dim", "vector", "worst", "worst_id")
    routes = open_.mapInArrow(_with_routes(shared), route).join(parts, ["dim", "region"])
    routes = routes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).drop("parts")
    routes = routes.join(starts.select("vec_id", *_SHARD), ["vec_id", *_SHARD], "left_anti")
    return freeze(routes, "routes"), first, pages
