"""Connected components of a graph given as links, by contraction.

In each round every node points at its smallest neighbour if that is smaller, pointers are followed
to their ends by doubling, and the links are drawn between the ends. Nodes that took part in a
link of the round have a smaller or equal end, so components shrink to their smallest node. Minima
are combined in the tasks before they travel; joins read written tables, so that a node with very
many links can be split at run time. Each round is written, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lapsewise.sources.workspace import Scratch


def _ends(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, end`` of every node in ``links``: where following smallest neighbours leads."""
    both = links.select(F.col("u").alias("node"), F.col("v").alias("other"))
    both = both.unionByName(links.select(F.col("v").alias("node"), F.col("u").alias("other")))
    ends = both.groupBy("node").agg(F.least("node", F.min("other")).alias("end"))
    ends, step = scratch.store(ends, f"{name}-0"), 0
    while True:
        step += 1
        jump = ends.select(F.col("node").alias("end"), F.col("end").alias("further"))
        ends = scratch.store(ends.join(jump, "end").select("node", F.col("further").alias("end"), (F.col("further") != F.col("end")).alias("moved")), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        if ends.where("moved").isEmpty():
            return ends.select("node", "end")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` (its smallest node) of every node that occurs in the links ``u, v``."""
    links = scratch.store(links.where("u != v").distinct(), "links-0")
    found = scratch.store(links.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("component", F.col("node")), "found-0")
    step = 0
    while not links.isEmpty():
        step += 1
        ends = _ends(links, scratch, f"ends-{step}")
        mapped = ends.select(F.col("node").alias("component"), F.col("end").alias("further"))
        found = found.join(mapped, "component", "left").select("node", F.coalesce("further", "component").alias("component"))
        found = scratch.store(found, f"found-{step}")
        left, right = (ends.select(F.col("node").alias(c), F.col("end").alias(f"{c}_end")) for c in ("u", "v"))
        links = links.join(left, "u").join(right, "v").where("u_end != v_end")
        links = scratch.store(links.select(F.col("u_end").alias("u"), F.col("v_end").alias("v")).distinct(), f"links-{step}")
        scratch.drop(f"found-{step - 1}", f"links-{step - 1}")
    return found
