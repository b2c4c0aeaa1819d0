"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxpop.llm.textkit import saved


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``comp`` (smallest id reachable) for every id in ``edges`` (``a``, ``b`` longs).

    Alternates two steps until the edge list is a set of stars: every node links
    its larger neighbours to its smallest one, then its smaller neighbours and
    itself.  The smallest neighbour is a partial aggregate, joined back by node,
    so a hub of any degree is split by the skew join; each round is written to
    the shared folder, and only counts reach the driver.
    """
    e = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "cc")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = saved(both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").distinct(), "cc")
        # small star: b is the node, a its smaller neighbour (a < b in every row)
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        e = large.join(low, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a < b").distinct()
        e = saved(e, "cc")
        now = tuple(e.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)")),
                          F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return e.select(F.col("b").alias("id"), F.col("a").alias("comp")).unionByName(e.select(F.col("a").alias("id"), F.col("a").alias("comp"))).distinct()
