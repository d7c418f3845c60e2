"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool, written: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """One step. The smallest neighbour of a node is found by a combining aggregate, written and joined back: both sides of the join are plain, so the engine splits a node with very many neighbours."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = written(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m")), "low")
    joined = both.join(low, F.col("u") == F.col("at"))
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("at").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """edges (u, v) of any orderable type, either direction. Returns (node, root), root being the smallest node of the component; roots are left out."""
    written = (scratch or Scratch(edges.sparkSession, "components")).written
    edges = written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    state = None
    while (now := _state(edges)) != state:
        state = now
        edges = written(_star(written(_star(edges, True, written), "edges"), False, written), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
