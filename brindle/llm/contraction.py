"""Subtree sums of a forest of any shape by parallel tree contraction.

Rounds of joins alternate two steps. *Rake*: every leaf hands its sums to its parent and goes.
*Compress*: of the unary chains, nodes that no neighbour in the chain comes before are spliced out at
the same time; what they held travels on the edge of their child. A leaf's total is known when it goes,
a spliced node's is what it held plus the total of its child: these are recovered in reverse order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brindle.session import settle

SUMS = ("s", "l")


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``(node, s, l)``: the sums of ``s`` and ``l`` over the subtree of each node, itself included.

    ``nodes`` are ``(node, parent, depth, n_children, s, l)``, one row each; roots have a null parent,
    and every other parent is a node. Chains are halved in a round, since nodes of odd depth come
    first, then those of depths divisible by 2, by 4 and so on, ties by hash: the number of rounds is
    about the logarithm of the depth. No node's children are gathered. Each round is written to the
    shared folder; only a count per round reaches the driver.
    """
    # Lowest set bit of the depth, then a hash: nodes with the least value go first.
    turn = F.struct(F.bit_count(F.expr("(depth & -depth) - 1")).alias("bit"), F.xxhash64("node").alias("hash"), "node")
    zero = F.lit(0).cast("long")
    open_ = nodes.select("node", "parent", turn.alias("turn"), F.col("n_children").alias("c"), "s", "l", zero.alias("es"), zero.alias("el"))
    open_ = settle(open_, "contract")
    leaf = (F.col("c") == 0) & F.col("parent").isNotNull()
    raked, spliced = [], []
    while True:
        raked.append(open_.where(leaf).select("node", *SUMS))
        up = open_.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            F.coalesce(F.sum(F.when(leaf, F.col("s") + F.col("es"))), zero).alias("add_s"),
            F.coalesce(F.sum(F.when(leaf, F.col("l") + F.col("el"))), zero).alias("add_l"),
            F.count_if(~leaf).alias("inner"),
            F.max(F.when(~leaf, F.struct("node", "es", "el"))).alias("kid"),
        )
        rest = open_.where(~leaf).join(up, "node", "left").select(
            "node", "parent", "turn", F.coalesce("inner", zero).alias("c"), (F.col("s") + F.coalesce("add_s", zero)).alias("s"), (F.col("l") + F.coalesce("add_l", zero)).alias("l"), "es", "el", "kid"
        )
        rest = settle(rest, "raked")
        chain = rest.where("c = 1 and parent is not null")
        said = chain.select(F.explode(F.array("parent", "kid.node")).alias("node"), "turn").groupBy("node").agg(F.min("turn").alias("other"))
        goes = (F.col("c") == 1) & F.col("parent").isNotNull() & (F.col("other").isNull() | (F.col("turn") < F.col("other")))
        judged = settle(rest.join(said, "node", "left").withColumn("goes", F.coalesce(goes, F.lit(False))), "judged")
        gone = judged.where("goes")
        spliced.append(gone.select("node", F.col("kid.node").alias("kid"), (F.col("s") + F.col("kid.es")).alias("s"), (F.col("l") + F.col("kid.el")).alias("l")))
        handed = gone.select(F.col("kid.node").alias("node"), F.col("parent").alias("up"), (F.col("s") + F.col("es")).alias("more_s"), (F.col("l") + F.col("el")).alias("more_l"))
        open_ = judged.where(~F.col("goes")).join(handed, "node", "left").select(
            "node", F.coalesce("up", "parent").alias("parent"), "turn", "c", "s", "l", (F.col("es") + F.coalesce("more_s", zero)).alias("es"), (F.col("el") + F.coalesce("more_l", zero)).alias("el")
        )
        open_ = settle(open_, "contract")
        if open_.where("parent is not null").isEmpty():
            break
    # What is left are the roots, with the sums of their whole trees.
    known = open_.select("node", *SUMS)
    for part in raked:
        known = known.unionByName(part)
    for part in reversed(spliced):
        below = known.select(F.col("node").alias("kid"), F.col("s").alias("s_kid"), F.col("l").alias("l_kid"))
        found = part.join(below, "kid").select("node", (F.col("s") + F.col("s_kid")).alias("s"), (F.col("l") + F.col("l_kid")).alias("l"))
        known = known.unionByName(settle(found, "expanded"))
    return known
