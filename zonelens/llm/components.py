"""Connected components of a link table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of `links` (columns x, y); the component is the smallest
    node reachable.

    Alternating large-star and small-star steps: each hangs the neighbours of a node below the
    smallest of them, so the links become stars in a logarithmic number of rounds.  A round is
    one map-side combined minimum and one join on the node; every round is written to the
    shared folder, so lineage stays short and no component is gathered anywhere.
    """
    spark = links.sparkSession
    e = written(spark, links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
                .filter("u <> v").distinct(), "links")
    print_of = lambda d: tuple(d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = print_of(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("c")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()          # every pair has u > v
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
        small = (large.join(least, F.col("u") == F.col("c"))
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
                 .select("p.u", "p.v").filter("u <> v").distinct())
        e = written(spark, small, "links")
        now = print_of(e)
        if now == before:
            break
        before = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
