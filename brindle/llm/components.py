"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brindle.session import settle


def _star(pairs: DataFrame, small: bool) -> DataFrame:
    """Hook the neighbours of each node to the least of its neighbourhood.

    The large star moves the neighbours above a node, the small star those below it and the node
    itself. The minimum is aggregated before it is joined back, so no neighbourhood is gathered.
    """
    both = pairs if small else pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u")
    if small:
        own = least.select(F.col("u").alias("v"), F.col("m"))
        return moved.select("v", "m").unionByName(own).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge, the component being its least node.

    Edges are undirected, may repeat and may be loops; edges with a null end are ignored. Rounds are
    logarithmic in practice; each is written to the shared folder, so a lost executor costs tasks of
    one round. Only a count and a checksum per round reach the driver.
    """
    clean = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and {a} != {b}")
    pairs = settle(clean.distinct(), "edges")
    state = None
    while True:
        mark = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if tuple(mark) == state:
            break
        state = tuple(mark)
        pairs = settle(_star(_star(pairs, small=False), small=True), "edges")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
