"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import cut


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the smaller of ``u`` and its least neighbour; combined before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _hang(edges: DataFrame, keep) -> DataFrame:
    """Edges (v, m) for the neighbours ``keep`` selects, hung below the least of ``u``."""
    near = edges.alias("e").join(_least(edges).alias("l"), F.col("e.u") == F.col("l.u"))
    return near.where(keep).select(F.col("e.v").alias("v"), F.col("l.m").alias("m"))


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (columns a, b: long), root the least node reachable.

    Large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and
    Beyond") until the edges are stars. A step sends each edge twice whatever a node's degree,
    and joins hot nodes as ordinary equi-joins, which adaptive execution can split. Each
    round is checkpointed; nothing but a changed flag reaches the driver. No edges: no rows.
    """
    now, seen = _settled(
        edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct()
    )
    while seen[0]:
        both = now.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            now.select(F.col("m").alias("u"), F.col("v").alias("v"))
        )
        large = _hang(both, F.col("e.v") > F.col("e.u")).where("v <> m").distinct()
        down = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _hang(down, F.lit(True)).unionByName(_least(down).select(F.col("u").alias("v"), "m"))
        before, (now, seen) = seen, _settled(small.where("v <> m").distinct())
        if before == seen:
            break
    return now.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(
        now.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()
    )


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, computed, and their number and hashes, by which two rounds are compared."""
    kept = cut(edges)
    marks = kept.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "m")), F.bit_xor(F.xxhash64("m", "v")))
    return kept, tuple(marks.first())
