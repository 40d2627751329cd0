"""Connected components over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import cut_lineage


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over undirected ``edges`` (a, b).

    Each round takes the smallest label among the neighbours (a partial aggregate,
    so a node with very many edges is no hot task) and then the label's own label,
    which shortens long chains; rounds are checkpointed. Raises if it does not
    settle within ``max_rounds`` instead of giving an unfinished result.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct().toDF("id", "other"))
    label = both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component"))
    label = cut_lineage(label)
    for _ in range(max_rounds):
        near = both.join(label.select(F.col("id").alias("other"), F.col("component").alias("c")), "other").groupBy("id").agg(F.min("c").alias("c"))
        down = label.select(F.col("id").alias("component"), F.col("component").alias("far"))
        nxt = label.join(near, "id").join(down, "component", "left")
        nxt = cut_lineage(nxt.select("id", F.least("component", "c", F.coalesce("far", "component")).alias("component"), F.col("component").alias("old")))
        if nxt.where("component <> old").isEmpty():
            return nxt.select("id", "component")
        label = nxt.select("id", "component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
