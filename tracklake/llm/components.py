"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, spread


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest member of the component of each node that has a link.

    ``edges`` has two bigint columns ``u`` and ``v``.  Returns ``u`` and ``root``
    for every node but the roots themselves.  Each round is two aggregations
    with partial sums and two joins; the edges of a round go to the shared
    folder, only a count and a checksum reach the driver.  Null ends and loops
    are ignored; repeated edges count once.
    """
    now = materialize(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
        large = spread(both, low, ["u"]).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = materialize(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = spread(large, low, ["u"]).filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        now = materialize(small.unionByName(low.select("u", F.col("low").alias("v"))).distinct(), "small-star")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select("u", F.col("v").alias("root"))
        seen = state
