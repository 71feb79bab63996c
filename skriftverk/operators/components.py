"""Connected components of a link table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """(id, component): the least id that is reachable over the undirected links; ids without links are absent.

    Alternating large-star and small-star rounds: the links shrink towards stars, so the number of rounds grows with the
    logarithm of a component's size. Each round is written to the shared folder. Null ids and links of an id to itself
    are ignored.
    """
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    e = materialize(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = small.union(low2.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        nxt = materialize(small.distinct(), "links")
        # stars: nobody is both a centre and a leaf, and each leaf has one centre
        leaf = nxt.select("u")
        bad = leaf.groupBy("u").count().filter("count > 1").select("u").union(leaf.join(nxt.select(F.col("v").alias("u")), "u", "left_semi"))
        e = nxt
        if bad.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
