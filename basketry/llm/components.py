"""Connected components of a graph held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import written


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """id, component of every id in the links ``a``, ``b``; the component is its smallest id.

    Alternates the large-star and small-star steps of Kiveris et al. until nothing changes. Each step takes minima per
    id, combined before the shuffle, and joins them back; a hub's rows are split by the skew handling of that join.
    It is an error if that has not come to rest after ``most_rounds``.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = written(edges, "edges")
    before = _fingerprint(edges)
    for _ in range(most_rounds):
        # every larger neighbour of an id gets the smallest id around it
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # an id and its smaller neighbours get the smallest of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.filter("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "edges")
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds; allow more")
    labels = edges.groupBy("u").agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("u")).distinct().withColumn("component", F.col("u"))
    return labels.unionByName(roots).groupBy("u").agg(F.min("component").alias("component")).withColumnRenamed("u", "id")
