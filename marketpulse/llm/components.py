"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketpulse.llm.common import discard, stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star algorithm. Every node links its larger
    neighbours (large) or its smaller ones and itself (small) to the smallest node
    among itself and its neighbours."""
    u, v = F.col("u"), F.col("v")
    if large:
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        out = both.join(least.withColumnRenamed("u", "c"), u == F.col("c")).where(v > u).select(v.alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        # both ends from the joined rows: another use of ``least`` would be another copy of its plan
        ends = F.array(*[F.struct(end.alias("u"), F.col("m").alias("v")) for end in (v, u)])
        out = down.join(least.withColumnRenamed("u", "c"), u == F.col("c")).select(F.inline(ends))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` (long) -> ``node, component``, the smallest node that is reachable.

    Alternates large and small stars until every node hangs on one that hangs on
    none, some log(n) times; joins on a node with many neighbours are split by AQE.
    Each step is stored, as it reads the one before more than once: nested, plans multiply in the driver.
    Loops, repeated edges and edges with a null are of no account. Nodes without an
    edge don't appear."""
    edges = stored(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v").distinct(), "edges")
    while True:
        before, far = edges, stored(_stars(edges, True), "edges")
        edges = stored(_stars(far, False), "edges")
        discard(before, far)
        torn = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        deep = edges.join(edges.select(F.col("v").alias("c")), F.col("u") == F.col("c"), "left_semi").select("u")
        if torn.unionByName(deep).isEmpty():
            out = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
            out.stored_at = edges.stored_at
            return out
