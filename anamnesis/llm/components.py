"""Connected components of a graph of links, as rounds of joins and aggregations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) to rows (node, root): root is the smallest node that can be reached.

    Each round hangs the larger neighbours of a node on its smallest one, then
    the smaller ones, until every link points from a node to its root. A hub's
    neighbours are never gathered: minima are aggregated before the shuffle and
    joined back, where a hot hub's links can be split. Every round is written to
    the shared folder. Null ends are dropped; no links give no rows.
    """
    links = links.where("a is not null and b is not null and a <> b")
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links, "links")
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).select("a", F.least("a", "least").alias("least"))
        large = (
            both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .where("a <> b").distinct()
        )
        large = materialize(large, "large-star")
        small = (
            large.join(_least(large), "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
                                      F.struct("a", F.col("least").alias("b")))).alias("l"))
            .select("l.*").where("a <> b").distinct()
        )
        links = materialize(small, "small-star")
        found = _state(links)
        if found == state:
            break
        state = found
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
