"""Connected components of a link table: alternating large-star and small-star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.llm.common import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node with a link to another node; root is the component's smallest node.

    Each step is a minimum per node (summed in the map tasks first) and an equi-join that Spark can split where a node
    has very many links; its result is written to the shared folder. Large-star hangs every larger neighbour on the
    node's minimum, small-star every smaller one, until all links end at a root. Null ends and
    links of a node to itself are left out; no links give no rows.
    """
    edges = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).where("node <> root").distinct()
    edges = materialize(edges, "component-links")
    state = None
    while True:
        both = edges.union(edges.select("root", "node")).toDF("node", "other")
        least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))
        large = both.where("other > node").join(least, "node").select(F.col("other").alias("node"), F.col("least").alias("root")).distinct()
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        joined = large.join(least, "node")
        small = joined.select("node", F.col("least").alias("root")).union(
            joined.where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))).distinct()
        edges = materialize(small, "component-links")
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if seen == state:
            return edges
        state = seen
