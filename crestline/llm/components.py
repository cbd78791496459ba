"""Connected components of a link table, by alternating star contraction.

Each round is a fixed number of aggregations and joins on node ids. Hubs are
reduced map-side (``min`` per node) and their join is left to the adaptive skew
split, so no neighbourhood is ever gathered. Rounds are cut with ``checkpoint``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.session import shared_dir


def _pairs(df: DataFrame, x, y) -> DataFrame:
    """Distinct links, larger end first; self-links go."""
    return (
        df.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
        .where("a <> b").distinct()
    )


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1_000_003)).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; the component is its smallest node.

    Repeated links, self-links and either direction are fine. Links with a null end
    are left out. An empty table gives an empty result. A node that only links to
    itself does not appear.
    """
    shared_dir(links.sparkSession)
    links = _pairs(links.where(F.col(a).isNotNull() & F.col(b).isNotNull()), F.col(a), F.col(b)).checkpoint()
    seen = _mark(links)
    while seen[0]:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # every larger neighbour now hangs on the smallest node around
        large = _pairs(both.where("v > u").join(low, "u"), F.col("v"), F.col("m"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # every node keeps its smallest link and passes it to its other smaller neighbours
        small = large.join(low, "a")
        links = _pairs(small, F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")), F.col("m")).checkpoint()
        now = _mark(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
