"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.scratch import written


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, root (the component's smallest node) for every node of ``edges`` (a, b long).

    Each round replaces the edges by fewer, shorter ones: a node's larger neighbours point to
    its smallest neighbour, then its smaller neighbours do. The number of rounds grows with
    the logarithm of the longest path. Every round is a table in the shared folder."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a <> b").distinct(), name)
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        rest = large.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        after = written(rest.unionByName(low.select("a", F.col("low").alias("b"))).filter("a <> b").distinct(), name)
        mark = after.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            roots = after.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen, now = mark, after
