"""Connected components of a link table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node in ``links`` (``a``, ``b``); one root per component.

    A round gives each node the least parent among its neighbours, hooks its old
    parent there too, and then jumps to the parent's parent, so paths shrink by
    half and more. Each round is a stored table, from which lost work restarts.
    Parents only fall; rounds end when their sum stays. Stored tables only grow
    with the links; nothing but that sum reaches the driver.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    parents = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "parents")
    total = None
    while True:
        now = parents.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return parents
        total = now
        least = (both.join(parents.withColumnRenamed("node", "b"), "b")
                 .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("least")))
        offers = parents.join(least, "node")
        hooked = (offers.select("node", F.least("root", "least").alias("root"))
                  .union(offers.select(F.col("root").alias("node"), F.col("least").alias("root")))
                  .groupBy("node").agg(F.min("root").alias("root")))
        above = hooked.select(F.col("node").alias("root"), F.col("root").alias("over"))
        parents = staged(hooked.join(above, "root").select("node", F.least("root", "over").alias("root")), "parents")
