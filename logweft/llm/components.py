"""Connected components by distributed union-find, with DataFrame operations only.

Alternating star contractions: a large star hangs each node's larger neighbours on the smallest node
it sees, a small star does so with its smaller ones.  Every round is a min per node, combined before
it shuffles, and an equi-join that adaptive execution can split at a hub, so no node's neighbours
meet in one task.  Rounds are about the logarithm of the longest chain; each is written out, which
cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from logweft.sources.scratch import settle


def _hang(edges: DataFrame) -> DataFrame:
    """Per node ``u``, the least of its neighbours ``v``."""
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges with ``u > v``."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = _hang(both).select("u", F.least("u", "low").alias("low"))
    large = (
        both.filter("v > u")
        .join(lowest, "u")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .distinct()
    )
    kept = large.join(_hang(large), "u")
    moved = kept.filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(kept.select("u", F.col("low").alias("v"))).distinct()


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Edges, written, with their number and a checksum, which the same job takes."""
    seen = Observation()
    rows = settle(edges.observe(seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("check")), "edges")
    return rows, (seen.get["n"] or 0, seen.get["check"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that is not the least node of its component.

    ``root`` is that least node.  Nodes can be of any type that compares; null ends and loops are
    ignored, so an edge table without links gives an empty result.
    """
    now, before = _settled(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    while before[0]:
        now, after = _settled(_round(now))
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
