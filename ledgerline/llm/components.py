"""Connected components of a link table, on Spark from end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.workspace import freeze


def roots(parents: DataFrame) -> DataFrame:
    """Follow parents to the top by pointer doubling: (node, root).

    Parents must not form a cycle; a parent that has none itself is a root. Both sides of
    each join are stored tables, so a root with very many nodes is split.
    """
    table = freeze(parents.select("node", F.col("parent").alias("root")), "parents")
    while True:
        up = table.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        joined = table.join(up, "root", "left")
        table = freeze(
            joined.select("node", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "parents",
        )
        moved = table.where("_moved").limit(1).count()
        table = table.select("node", "root")
        if not moved:
            return table


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): every node of ``links`` (a, b) and its component's smallest.

    Each round hooks every node to its smallest neighbour if that is smaller,
    follows the hooks to their roots, and carries the links over to the roots.
    Rounds end when no link joins two roots; their number grows with the logarithm
    of the longest chain. Direction, repeats, nulls and self-links do not matter.
    """
    edges = freeze(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    labels = None
    while True:
        # A hook goes from the larger end, so the smaller end needs no second row.
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        hooked = roots(hooks)
        low = hooked.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        high = hooked.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        if labels is None:
            labels = hooked
        else:
            over = hooked.select(F.col("node").alias("root"), F.col("root").alias("_over"))
            labels = freeze(
                labels.join(over, "root", "left").select("node", F.coalesce("_over", "root").alias("root"))
                .unionByName(hooked),
                "labels",
            )
        moved = edges.join(low, "a", "left").join(high, "b").select(
            F.coalesce("_a", "a").alias("a"), F.col("_b").alias("b")
        )
        edges = freeze(
            moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links",
        )
        if not edges.limit(1).count():
            break
    tops = labels.select(F.col("root").alias("node")).distinct()
    return labels.select("node", F.col("root").alias("component")).unionByName(
        tops.join(labels, "node", "left_anti").select("node", F.col("node").alias("component"))
    )
