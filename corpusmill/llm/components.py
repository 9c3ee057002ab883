"""Connected components of a table of links, by rounds of large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import spill


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that has a link; component is the smallest node reached.

    ``links`` has long columns ``a`` and ``b``; nulls, self-links and repeats are ignored. Each round
    hangs every node on the smallest node it knows of, so hubs of any degree cost one partial
    minimum and one join that adaptive execution may split; no neighbourhood is gathered. Rounds
    grow with the logarithm of the longest path. Every round is written to the shared folder.
    """
    edges = spill(
        links.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = _fingerprint(edges)
    for _ in range(max_rounds):
        edges = spill(_small_star(_large_star(edges)))
        now = _fingerprint(edges)
        if now == seen:
            return _with_roots(edges)
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _fingerprint(edges: DataFrame):
    mix = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mix), F.sum((mix % 1000003).cast("long"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _with_roots(edges: DataFrame) -> DataFrame:
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.union(roots)
