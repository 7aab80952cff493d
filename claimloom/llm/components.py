"""Connected components of a link table, as Spark joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each linked node.

    ``links`` has two long columns ``a`` and ``b`` (either order, repeats, nulls and
    self-links allowed; the last two are ignored). Returns ``node``, ``label`` for
    every node that has a link to another one. Alternates the large-star and the
    small-star step, which turns every component into a star around its smallest
    node in a number of rounds logarithmic in its diameter; each round is stored, so a lost
    executor costs one round. Adaptive skew joins split a node with very many links.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = as_table(links.select(high.alias("u"), low.alias("v")).filter("u != v").distinct(), "links")
    state = None
    while True:
        # Large star: every larger neighbour is linked to the smallest of the neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Stored, so that the join can split a node with very many links.
        least = as_table(least, "least")
        edges = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = edges.distinct()
        # Small star: smaller neighbours are linked to the smallest of them.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = as_table(moved.unionByName(least.withColumnRenamed("m", "v")).distinct(), "stars")
        # Unchanged edges mean that every component is a star.
        seen = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == state:
            break
        state = seen
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(centres)
