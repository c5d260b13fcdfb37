"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayside.storage import settle


def _with_smallest(links: DataFrame) -> DataFrame:
    """Links (a, b) with the smallest id next to a or a itself."""
    least = links.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return links.join(least, "a")


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of an id hang on its smallest one."""
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = links.select(F.explode(ends).alias("l")).select("l.*")
    return _with_smallest(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """An id and its smaller neighbours hang on the smallest of them; links point to the smaller end."""
    hung = F.array(F.struct(F.col("a"), F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))
    return _with_smallest(links).select(F.explode(hung).alias("l")).select("l.*")


def components(links: DataFrame) -> DataFrame:
    """(a, b): every linked id but the smallest of its component, with that smallest id.

    Links are pairs (a, b) of longs; order, repeats and loops don't matter. Every round
    hangs neighbours on the smallest id around them, until each component is one star. Ids
    meet in joins and minima only, which Spark combines before the shuffle and splits where
    one id has many links; each round is written to the shared folder.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    now, before = settle(now, "links"), None
    while True:
        row = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")).first()
        if row["n"] == 0 or (row["n"], row["sum"]) == before:
            return now
        before = row["n"], row["sum"]
        now = settle(_small_star(_large_star(now)).where("a != b").distinct(), "links")
