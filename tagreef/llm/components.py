"""Connected components by alternating stars: joins and minima only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagreef.llm.tables import stored


def _checksum(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a vertex to the least of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    tied = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a vertex and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    tied = tied.unionAll(least.select("a", F.col("m").alias("b")))
    return tied.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least vertex of its component, for each vertex but that one.

    ``edges`` has two long columns ``a`` and ``b``; loops, repeated edges and
    rows with a null say nothing. Rounds are stored, so none is ever computed
    twice; their number grows with the logarithm of the longest chain.
    """
    edges = stored(edges.dropna().filter("a <> b").select("a", "b").distinct(), "edges")
    seen = _checksum(edges)
    while seen[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
