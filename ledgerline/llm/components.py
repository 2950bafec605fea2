"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import held_tables, stored


def _seen() -> list[Column]:
    """Number and checksum of edges."""
    return [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")]


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """``edges`` written and read back, with their number and a checksum, counted while they are written."""
    seen = Observation()
    done = stored(edges.select("a", "b").observe(seen, *_seen()), "cc")
    return done, (seen.get["n"], seen.get["h"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    mins = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(mins, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    mins = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(mins, "u").select(F.explode(F.array(
        F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
    return moved.select("e.a", "e.b").where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b: long) that is not itself its component's smallest node.

    Every small-star step is written to the shared scratch folder, and the
    large-star step before it is held until then; only a count and a checksum
    reach the driver.  The number of steps grows with the logarithm of the
    longest chain.  It ends when a large-star step leaves the edges of
    the step before as they are and no node of them has two roots: then the
    small-star step would leave them too, and they are stars.  Self-loops are
    ignored; an empty table gives an empty table.
    """
    stars, before = _written(_small_star(edges.where("a <> b")))
    while before[0]:
        with held_tables() as hold:
            moved = hold(_large_star(stars))
            after = tuple(moved.agg(*_seen()).first())
            if after == before and stars.select("a").distinct().count() == before[0]:
                break
            stars, before = _written(_small_star(moved))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
