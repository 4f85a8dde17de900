"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014), as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolith.llm.common import cut


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): component is the smallest node reachable, one row per node that has an edge to another.

    Rows with a null end and loops are no edges. An empty edge list gives no rows. Each round reads a table written to
    the shared folder, so a lost executor costs at most one round; no edge or component goes to the driver.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    pairs = cut(pairs.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    before = None
    while True:
        size = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if size == before or not size[0]:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        before = size
        ends = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("w")).union(pairs.select(F.col("lo").alias("u"), F.col("hi").alias("w")))
        least = ends.groupBy("u").agg(F.min("w").alias("w")).select(F.col("u").alias("lo"), F.least("u", "w").alias("m"))
        large = pairs.join(least, "lo").select("hi", F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        pairs = cut(small.union(root.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
