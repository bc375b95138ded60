"""Connected components of an edge table, without any list of nodes on the driver.

Each round every node points to its smallest neighbour or itself, pointers are followed to their roots, and edges are
moved to the roots; edges inside a component vanish, so that the number of nodes with edges at least halves. Each
round's tables are written to the shared folder, which cuts lineage; the driver sees one count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.llm.store import keep


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node that can be reached. Nulls have no edges."""
    edges = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    edges = keep(edges, "edges")
    roots = None
    while edges.take(1):
        both = edges.select(F.col("b").alias("node"), F.col("a").alias("near")).unionByName(edges.select(F.col("a").alias("node"), F.col("b").alias("near")))
        link = keep(both.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("root")), "pointers")
        while True:
            up = link.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            moved = keep(link.join(up, link["root"] == up["_n"], "left").select("node", F.coalesce("_r", "root").alias("root"), (F.coalesce("_r", "root") != F.col("root")).alias("moved")), "pointers")
            link = moved.select("node", "root")
            if not moved.filter("moved").take(1):
                break
        if roots is None:
            roots = link
        else:
            up = link.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            roots = keep(roots.join(up, roots["root"] == up["_n"], "left").select("node", F.coalesce("_r", "root").alias("root")), "roots")
        left, right = link.select(F.col("node").alias("a"), F.col("root").alias("ra")), link.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = keep(edges.join(left, "a").join(right, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).filter("a < b").distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots
