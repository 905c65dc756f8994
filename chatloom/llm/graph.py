"""Connected components and look-ups that no hot key can hold up.

A node that a third of all links meet is a hot key of every join on nodes. Here each join
has a written table on either side: Spark broadcasts the smaller one while it has at most
``BROADCAST_ROWS`` rows, and beyond that both sides get an exchange of their own, whose
large partitions adaptive execution splits. An aggregate, which holds the rows of a key
together, never feeds a join without being written first.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.session import materialize

BROADCAST_ROWS = 500_000  # rows of at most 40 bytes


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(``node``, ``root``) of all nodes of the links (``a``, ``b``), two longs: ``root`` is the least
    node that is reachable. Alternating large and small stars; a round is written, and
    the last one changes nothing.

    Null ends and links from a node to itself are left out; no links give no rows.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = materialize(links.where("a <> b").select(u, v).distinct())
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = both.where("v > u").join(small(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct())
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        star = large.join(small(least), "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        edges = materialize(star.where("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    own = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return materialize(own.unionByName(own.select(F.col("root").alias("node"), "root").distinct()))
