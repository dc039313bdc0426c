"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import staged


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(low, "u")
    return (rest.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` of every node of ``links (u, v)`` but the roots themselves;
    the root is the smallest node of the component.

    Every round is written to the shared folder. A node with very many links
    costs partial minima and a join that AQE splits.
    """
    e = staged(links.filter("u <> v").select("u", "v").distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        e = staged(_small_star(_large_star(e)), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(now)
    raise RuntimeError("components did not settle")
