"""Connected components of a graph of links, by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from weekloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of links (a, b).

    Each round links every node's larger neighbours, then all its smaller ones, to the
    smallest of them; rounds end when no link changes, after about log(n) of them. Groups
    are reduced to their minimum before the shuffle and joined back, never gathered. Each
    round's links are stored, so a lost task repeats one round only.
    """
    links = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        seen = Observation()  # rides along with the write
        links = stored(_small_star(_large_star(links)).observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("all")), "links")
        if seen.get == before:
            break
        before = seen.get
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select("b", "b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a")
    return moved.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least).distinct()


def spanning(n: int, pairs) -> list[tuple[int, int]]:
    """Links of a spanning forest of the pairs (i, j) over n places: as many links as joins, whatever the number of pairs."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept
