"""Connected components of large graphs over DataFrames, without gathering any neighbour list.

`forest_roots` follows pointers, each step twice as far. `components` alternates large-star and small-star steps: each takes
minima per node (combined before the shuffle) and joins them back, salted, so that a node with any number of
links costs rows of many tasks, not memory of one. Tables between steps lie in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_written, materialize

#: Parts that a node's links are dealt to.
SALTS = 16


def forest_roots(parents: DataFrame) -> DataFrame:
    """(node, root) of each node u, from one row (u, v) per node, v smaller than u."""
    now = materialize(parents.select("u", "v"), small=True)
    while True:
        # both sides are written tables, so Spark can split the rows of a parent with very many children
        step = now.join(now.select(F.col("u").alias("v"), F.col("v").alias("w")), "v", "left")
        after = materialize(step.select("u", F.coalesce("w", "v").alias("v"), F.col("w").isNotNull().alias("moved")), small=True)
        drop_written(now)
        if after.filter("moved").isEmpty():
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        now = after.select("u", "v")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours (larger ones, or smaller ones and itself) are linked to a node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = both.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS))).join(salted, ["u", "salt"])
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each linked node's component, from links (u, v)."""
    edges = materialize(links.filter("u <> v").select("u", "v").distinct(), small=True)
    before = None
    while True:
        now = materialize(_star(_star(edges, True), False), small=True)
        drop_written(edges)
        edges = now
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after more links (u, v): links are taken between roots, so that only these are linked anew. Nodes without a row are roots of their own."""
    end = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    known = links.join(end("u"), "u", "left").join(end("v"), "v", "left")
    between = known.select(F.coalesce("u_root", "u").alias("u"), F.coalesce("v_root", "v").alias("v"))
    moved = materialize(components(between), small=True).withColumnRenamed("root", "to")
    old = roots.join(moved.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    new = moved.join(roots, "node", "left_anti").select("node", F.col("to").alias("root"))
    return materialize(old.unionByName(new), small=True)
