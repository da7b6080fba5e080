"""Connected components of edge tables by alternating stars.

Each round links the neighbours of every node to the smallest node it knows; edges shrink to stars
in a number of rounds that grows with the logarithm of the longest path. Smallest neighbours are
formed before the shuffle, so a node with very many edges costs one row per task.
"""

from pyspark.sql import functions as F

from riskloom.llm.scratch import discard, kept_once


def _downward(edges):
    """Distinct edges (a, b) with a > b."""
    return edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges):
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges):
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges, name="edges"):
    """(node, root) for every node that has an edge, from columns a and b; the root is the smallest
    node of the component. Loops and repeated edges change nothing; without edges no rows."""
    stars, before = kept_once(_downward(edges), name), None
    while True:
        state = tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before or not state[0]:
            break
        before = state
        after = kept_once(_downward(_small_star(_downward(_large_star(stars)))), name)
        discard(stars)
        stars = after
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
