"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.session import materialize


def _star(arcs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored arcs (u, v) and the stored smallest v of each u.

    Both sides of the join that follows are stored tables, so that a node with
    very many arcs can be split over tasks by the skew join.
    """
    arcs = materialize(arcs, "arcs")
    smallest = materialize(arcs.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "smallest")
    return arcs, smallest


def _large(edges: DataFrame) -> DataFrame:
    """Join every neighbour larger than u to the smallest of u and its neighbours."""
    arcs, smallest = _star(edges.union(edges.select("v", "u")).toDF("u", "v"))
    m = F.least("w", "m")
    return (arcs.join(smallest, arcs["u"] == smallest["w"]).filter("v > u")
                .select(F.col("v").alias("u"), m.alias("v")).dropDuplicates())


def _small(edges: DataFrame) -> DataFrame:
    """Join u and its smaller neighbours to the smallest of them; edges hold u > v."""
    arcs, smallest = _star(edges)
    moved = (arcs.join(smallest, arcs["u"] == smallest["w"]).filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.union(smallest.select("w", "m")).dropDuplicates()


def _state(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (two long columns a, b).

    The component is its smallest node; the smallest node itself has no row.
    Null ends and loops are ignored, an empty table gives no rows. The edges
    of each round are stored in the shared folder; only their count and a
    checksum come to the driver.
    """
    a, b = edges.columns
    edges = materialize(edges.filter(F.col(a) != F.col(b))
                             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                             .dropDuplicates(), "edges")
    before = _state(edges)
    while before[0]:
        edges = materialize(_small(_large(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
