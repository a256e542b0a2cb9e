"""Connected components of a link table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst")), F.sum(F.xxhash64("dst", "src").cast("decimal(38,0)"))).first())


def _toward_least(pairs: DataFrame, keep_own: bool) -> DataFrame:
    """Link every partner (and the node itself) to the least node around it.

    The minimum is an aggregate joined back, never a list of partners, so a
    node with very many links needs no large group in memory.
    """
    least = pairs.groupBy("src").agg(F.min("dst").alias("low")).withColumn("low", F.least("src", "low"))
    if not keep_own:  # large star: only partners above the node move
        moved = pairs.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    else:  # small star: partners are all below the node
        moved = (pairs.join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
                 .unionAll(least.select("src", F.col("low").alias("dst"))))
    return moved.where("src <> dst").distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(src, dst) links of longs -> (node, component), component being the least node that is reachable.

    Nodes without links, self-links and null ends have no row.  Each round is
    written to the shared folder; the number of rounds grows with the
    logarithm of the longest chain.
    """
    ends = edges.where("src is not null and dst is not null and src <> dst")
    now = written(ends.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), name)
    before = _signature(now)
    while before[0]:
        both = now.unionAll(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        now = written(_toward_least(_toward_least(both, False), True), name)
        after = _signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionAll(
        now.select(F.col("dst").alias("node"), F.col("dst").alias("component"))).distinct()
