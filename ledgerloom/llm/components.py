"""Connected components of a link table, with the table written to the shared folder after every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import staged


def _fingerprint(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """Root of every node that has a link: node, root (the smallest node of its component).

    links has two columns of whole numbers, in any direction, repeats and self-links allowed. Rounds of large-star
    (a node hands its larger neighbours to its smallest one) and small-star (the same for smaller neighbours) turn
    each component into a star; rounds stop when the table no longer changes. A node with very many neighbours is
    only aggregated by partial minima and joined, where adaptive execution splits it.
    """
    one, two = links.columns
    pairs = links.select(F.greatest(one, two).alias("high"), F.least(one, two).alias("low"))
    pairs = staged(pairs.filter("high > low").distinct(), "links")
    before = _fingerprint(pairs)
    while before[0]:
        both = pairs.select(F.col("high").alias("node"), F.col("low").alias("other")).union(pairs.select("low", "high"))
        least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        large = both.filter("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))
        large = staged(large.distinct(), "links-large")
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(least, "high").select(
            F.explode(F.array(F.struct("high", F.col("least").alias("low")), F.struct(F.col("low").alias("high"), F.col("least").alias("low")))).alias("p")
        )
        pairs = staged(small.select("p.high", "p.low").filter("high > low").distinct(), "links")
        after = _fingerprint(pairs)
        if after == before:
            break
        before = after
    ends = pairs.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return ends.union(pairs.select("low", "low")).distinct()
