"""Connected components of a table of links, by alternating large-star and
small-star steps on DataFrames. Nothing is collected but a count and a sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    out = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return out.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): the smallest id reachable from each linked id; the
    smallest ids themselves have no row. Links of an id with itself and links
    with a null say nothing."""
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    e = stored(e, "links")
    before = None
    while True:
        e = stored(_small_star(_large_star(e)), "links")
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
