"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import Workspace
from .common import lookup, tasks_for

# Rounds shrink paths at least by half, so this covers paths longer than any table.
MOST_ROUNDS = 64


def _smallest(links: DataFrame) -> DataFrame:
    """For each u its smallest neighbour, or itself when that is smaller."""
    return links.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))


def connected(links: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is its smallest node.

    Rounds of large and small stars: every node hands its larger neighbours, then its smaller ones,
    to the smallest node it knows. Each round is written to the shared folder, so no round depends
    on an executor, and nothing but counts comes to the driver. Links to oneself, repeated links and
    links with a null end are of no effect.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = work.store(edges, f"{name}_0")
    sign = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sign")
    seen = edges.agg(F.count("*").alias("n"), sign).first()
    tasks = tasks_for(seen.n)
    for k in range(1, MOST_ROUNDS + 1):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = lookup(work.store(_smallest(both).coalesce(tasks), f"{name}_large_{k}"))
        # A large star keeps one row for each row that it reads, so repeats need not go yet.
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        least = lookup(work.store(_smallest(large).coalesce(tasks), f"{name}_small_{k}"))
        smaller = large.join(least, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = smaller.unionByName(least.select("u", F.col("least").alias("v"))).distinct()
        edges = work.store(edges.coalesce(tasks), f"{name}_{k}")
        now = edges.agg(F.count("*").alias("n"), sign).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
