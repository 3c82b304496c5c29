"""Connected components by hash-to-min, on tables that never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quillmill.session import discard, materialise


def hash_to_min(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """``node, component`` for the undirected graph of ``edges``; a component is named by its least node.

    Each round every node sends its cluster to the cluster's least member and that
    member to the rest.  A cluster is kept as rows, so a giant component is spread
    over tasks.  NULL ends are ignored, loops give single nodes, and an empty
    edge table gives an empty result.
    """
    both = materialise(edges.select(F.col(a).alias("v"), F.col(b).alias("u")).where("v is not null and u is not null").distinct(), "edges")
    c = both.union(both.select("u", "v")).union(both.select("v", F.col("v").alias("u"))).union(both.select("u", F.col("u").alias("v"))).distinct()
    held, before = both, None
    for _ in range(most_rounds):
        low = c.groupBy("v").agg(F.min("u").alias("m"))
        sent = c.join(low, "v")
        # the least member gets the cluster, every member gets the least one
        nxt = sent.select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.v", "e.u").distinct()
        seen = Observation()
        nxt = materialise(nxt.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("s")), "clusters")
        state = (seen.get["n"], seen.get["s"])
        discard(held)
        c = held = nxt
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return c.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("node"), F.col("m").alias("component"))
