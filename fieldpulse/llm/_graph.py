"""Connected components of an edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm._common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: every node learns the least of its neighbours and itself and hands it to
    the larger neighbours (``large``), or to the smaller ones and itself."""
    if large:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = (sides.groupBy("a").agg(F.min("b").alias("_m"))
             .select("a", F.least("a", "_m").alias("_m")))
    met = sides.join(least, "a")
    if large:
        out = met.filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(
            least.select("a", F.col("_m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a long, b long)`` -> ``(node, root)`` for every node of an edge, ``root`` being the
    smallest node of its component (itself included).

    Each round writes its edges to the shared folder, so the lineage stays short and a lost
    executor re-reads one round. Rounds grow with the logarithm of the longest path. No edge list
    and no component is collected; the driver reads two sums a round to see whether anything moved.
    """
    cur = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        cur = staged(_star(_star(cur, True), False), "cc")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
