"""Connected components of a link table, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropmosaic.llm.common import stored, with_size_hint

# The smallest neighbour of each node is found with partial aggregation. It is brought back to the edges by a
# broadcast while it is small, for the two ends of n edges have at most 2 n names; beyond that by a shuffle, whose
# hub of a star Spark splits like any skewed join.


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(with_size_hint(least, 2 * n, 32), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(with_size_hint(least, 2 * n, 32), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, root): root is the smallest node that the node reaches; nodes without edges and roots are absent.

    Each round shuffles the edges only and writes them to the shared folder; the number of rounds grows with the
    logarithm of the longest path.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state, n = None, edges.count()
    while True:
        # a star step moves each edge to at most one other, and adds at most one for each node
        edges = stored(_small_star(_large_star(edges, n), n).filter("a <> b").distinct())
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state, n = tuple(found), found[0]
