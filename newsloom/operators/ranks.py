"""Values at given places of large groups, without sorting a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.store import discard, stored

#: Ranges a group's values are cut into.
RANGES = 1000
#: No finite double has a larger logarithm.
LOG = 710.0


def _range(v: Column, low: Column, high: Column) -> Column:
    """The range of a value, ascending. Infinite values and NaN (the largest) have their own; equal steps
    where low, high and their distance are finite, steps of the logarithm where they are not. The least and
    the largest value never share a range, so every cut makes progress."""
    huge, nan = F.lit(float("inf")), F.isnan(high)
    log = lambda x: F.signum(x) * F.log1p(F.abs(x))
    ends = lambda x: F.greatest(F.least(log(x), F.lit(LOG)), F.lit(-LOG))
    plain = ~nan & (high < huge) & (low > -huge) & (high - low < huge)
    even = F.least(F.floor((v - low) / (high - low) * RANGES), F.lit(RANGES - 1))
    steps = F.least(F.floor((log(v) - ends(low)) / (F.when(nan, F.lit(LOG)).otherwise(ends(high)) - ends(low)) * RANGES), F.lit(RANGES - 1))
    return F.when(plain, even).when(F.isnan(v), RANGES + 1).when(v == huge, RANGES).when(v == -huge, -1).otherwise(steps)


def at_places(rows: DataFrame, group: str, value: str, places: dict[str, Column]) -> DataFrame:
    """One row a group: the group, n, and for each name the value at that place (from 1, ascending; an expression of n).

    Values are counted by range (equal steps from a group's least to its largest value) and
    only the ranges that hold a wanted place are cut again, until each has one value or few
    rows. So a window sees at most RANGES counts of a group, however large that is.
    """
    rows = rows.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    size = stored(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")), "sizes")
    want = size.select("g", F.explode(F.array(*[F.struct(F.lit(k).alias("name"), p.cast("bigint").alias("place")) for k, p in places.items()])).alias("x"), "low", "high").select("g", "low", "high", "x.*")
    todo, done = stored(want, "places"), None
    while True:
        found = todo.where("low = high").select("g", "name", F.col("low").alias("v"))
        done = found if done is None else done.union(found)
        todo = todo.where("low < high")
        if todo.isEmpty():
            break
        spans = todo.select("g", "low", "high").distinct()
        part = _range(F.col("v"), F.col("low"), F.col("high"))
        counts = rows.join(spans, "g").where("v between low and high").groupBy("g", "low", "high", part.alias("part")).agg(F.count(F.lit(1)).alias("k"), F.min("v").alias("least"), F.max("v").alias("most"))
        upto = F.sum("k").over(Window.partitionBy("g", "low", "high").orderBy("part"))
        ranges = counts.withColumn("upto", upto)
        hit = todo.join(ranges, ["g", "low", "high"]).where((F.col("place") <= F.col("upto")) & (F.col("place") > F.col("upto") - F.col("k")))
        # The place counts on inside the range.
        todo = stored(hit.select("g", F.col("least").alias("low"), F.col("most").alias("high"), "name", (F.col("place") - F.col("upto") + F.col("k")).alias("place")), "places")
    out = done.groupBy("g").agg(*[F.max(F.when(F.col("name") == k, F.col("v"))).alias(k) for k in places])
    out = stored(out.join(size.select("g", "n"), "g").select(F.col("g").alias(group), "n", *places), "ranked")
    discard(todo, size)
    return out
