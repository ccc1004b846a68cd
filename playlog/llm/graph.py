"""Connected components of an edge list, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog.llm import common as C


_SALTS = 16  # tasks over which the edges of one node are dealt


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the smallest
    node that can be reached, itself included.

    Alternates large-star and small-star steps: every node hooks its larger
    neighbours, then its smaller ones, to the smallest node it knows. The edge
    list never grows, and the number of rounds is logarithmic in practice. Each round is written to
    the checkpoint folder. Only two numbers a round reach the driver.
    Loops and null ends are ignored; an empty edge list gives an empty result.
    """
    e = C.cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .filter("u <> v").distinct())
    before = _mark(e)
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # a group's smallest node has an edge to every other one: its rows go to several tasks
        # (dealt anew, else the join would settle for u alone, by which the minima lie already)
        spread = low.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))).repartition("u", "s")
        salted = both.withColumn("s", F.pmod(F.hash("v"), F.lit(_SALTS)))
        large = salted.join(spread, ["u", "s"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = C.cut(small.filter("u <> v").distinct())
        after = _mark(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(e: DataFrame) -> tuple:
    """Count and an order-free hash of an edge list."""
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]
