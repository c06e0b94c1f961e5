"""Connected components of an edge table, by DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.shared import Scratch, join_heavy


def settled(star: DataFrame) -> tuple[int, int]:
    """(the most rows that an id has, ids that are no star yet: with two lows, or on both sides)."""
    sides = star.select(F.col("id").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(star.select(F.col("low").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    n = sides.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    found = n.agg(F.coalesce(F.max(F.col("up") + F.col("down")), F.lit(0)), F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))))
    return tuple(found.first())


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, component) of all ids in ``edges`` (a, b longs): the smallest id that can be reached.

    Large-star and small-star passes in turn until each id hangs on one that hangs on nothing: each
    pass hangs the neighbours of an id on its smallest one. A hot id costs one partial aggregate
    and a join that adaptive execution can split. Passes grow as the
    logarithm of the longest chain. Each pass is written to the shared folder, and the pass before
    it is dropped.
    """
    star = scratch.keep(f"{name}-0", edges.where("a != b").select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("low")).distinct())
    turn = 0
    while True:
        most, open_ = settled(star)
        if not open_:
            break
        both = star.select("id", "low").unionByName(star.select(F.col("low").alias("id"), F.col("id").alias("low")))
        # large star: every larger neighbour of an id goes to the least of the id and its neighbours
        least = both.groupBy("id").agg(F.least(F.min("low"), F.first("id")).alias("least"))
        large = join_heavy(both.where("low > id"), least, ["id"], most).select(F.col("low").alias("id"), F.col("least").alias("low")).distinct()
        # small star: an id and its smaller neighbours go to the least of them
        least = large.groupBy("id").agg(F.min("low").alias("least"))
        joined = join_heavy(large, least, ["id"], most)
        small = joined.select(F.col("low").alias("id"), F.col("least").alias("low")).unionByName(joined.select("id", F.col("least").alias("low"))).where("id != low").distinct()
        turn += 1
        star = scratch.keep(f"{name}-{turn}", small)
        scratch.drop(f"{name}-{turn - 1}")
    return star.select("id", F.col("low").alias("component")).unionByName(star.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct())
