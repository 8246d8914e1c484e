"""Connected components of a link table by alternating star contractions.

Every round is two joins on narrow rows and ends in a written table, so lineage
stays short and a lost executor costs one round. The number of rounds grows with
the logarithm of the largest component. A hub's links are spread by AQE's skew
join, since each round's joins keep no order or grouping above them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """From links (u, v) of any sortable type: (node, component), the component being its least node.

    Nodes without links do not appear. Nulls must not occur.
    """
    now = stage(links.select("u", "v").where("u <> v").distinct(), "components")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        now = stage(_small_star(_large_star(now)), "components")
