"""Connected components of links between ids, in rounds of narrow joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import attach_totals, salts
from barflow.session import staged


def _with_least(edges: DataFrame, n: int) -> DataFrame:
    """Edges (u, v) with the least neighbour of u; a node with very many neighbours is dealt to salted pieces."""
    return attach_totals(edges, ["u"], F.col("v"), n, {"least": F.min("v")}, {"least": F.min("least")})


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links (columns a, b): the least node it can reach.

    Each round links every node's larger neighbours, and then its smaller ones, to the least node seen. That
    never loses a connection and ends in stars, after a number of rounds that grows with the logarithm of the
    longest path. Each round is written to the shared folder. No links give no rows.
    """
    edges = staged(links.filter("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    n = salts(edges.count())
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, n).filter("v > u").select(
            F.col("v").alias("u"), F.least("least", "u").alias("v")).filter("u != v").distinct()
        small = _with_least(large, n)
        edges = staged(small.select("u", F.col("least").alias("v")).unionAll(
            small.filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select("v").distinct()
    return edges.selectExpr("u AS node", "v AS component").unionAll(roots.selectExpr("v AS node", "v AS component"))
