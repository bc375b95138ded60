"""Exact quantiles of groups of any size.

A quantile is the value at a place in its group's order (between two, in proportion). No task sorts a group or holds its
values: a group's range is cut into equal bins and its values are counted by bin, each task for itself first; the bins
that hold the places asked for become the next ranges, in which the values are counted again. A range ends when it is
one value, however often it occurs, or has few values, which are then put in order. A pass makes a range narrower by
the number of bins, at least; two passes do for values that lie evenly, and every further one reads what is still open.

What a pass shuffles is a row for each task, group and bin that has values; what is broadcast or joined is a row for each
group and open range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelake.operators.order import few as sent, settled

#: Bins of a range in one pass, and values that are few enough to be put in order.
BINS, FEW = 2048, 4096


def _bin(value, low, high, bins: int):
    """Which of `bins` equal parts of [low, high] a value is in; halves avoid overflow of the range."""
    part = (value / 2 - low / 2) / (high / 2 - low / 2)
    return F.when(high <= low, 0).otherwise(F.least(F.floor(part * bins), F.lit(bins - 1))).cast("int")


def values_at(rows: DataFrame, keys: list[str], value: str, places: DataFrame, bins: int = BINS, few: int = FEW) -> DataFrame:
    """(*keys, place, value) for places (*keys, place from 0) in the order of each group's values; keys are not null, and
    values are neither null nor NaN."""
    rows = rows.select(*keys, F.col(value).cast("double").alias("v"))
    ends = rows.groupBy(*keys).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"))
    # an open range: its first place, how many values are below it, and the places asked for in it
    open_ = ends.join(places.groupBy(*keys).agg(F.sort_array(F.collect_set("place")).alias("places")), keys)
    open_ = settled(open_.withColumns({"r": F.lit(0), "below": F.lit(0).cast("long")}))
    found = []
    while open_.take(1):
        same = (F.col("low") == F.col("high"))
        found.append(open_.filter(same).select(*keys, F.explode("places").alias("place"), F.col("low").alias("value")))
        wide = open_.filter(~same)
        # where open ranges are few, rows are neither dealt out by group nor sorted
        inside = rows.join(sent(wide.select(*keys, "r", "low", "high", "n")), keys).filter("v BETWEEN low AND high")
        asked = wide.select(*keys, "r", "below", "places")
        # few values: in order, by their bounded number
        small = inside.filter(F.col("n") <= few).groupBy(*keys, "r").agg(F.sort_array(F.collect_list("v")).alias("vs")).join(asked, [*keys, "r"])
        found.append(settled(small.withColumn("place", F.explode("places")).select(*keys, "place", F.get("vs", (F.col("place") - F.col("below")).cast("int")).alias("value"))))
        counted = inside.filter(F.col("n") > few).withColumn("b", _bin(F.col("v"), F.col("low"), F.col("high"), bins))
        parts = counted.groupBy(*keys, "r", "b").agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi")).join(asked, [*keys, "r"])  # numbers alone are summed by hash, without a sort
        w = Window.partitionBy(*keys, "r").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # at most `bins` rows
        told = parts.withColumn("start", F.col("below") + F.coalesce(F.sum("m").over(w), F.lit(0)))
        told = told.withColumn("mine", F.filter("places", lambda p: (p >= F.col("start")) & (p < F.col("start") + F.col("m")))).filter(F.size("mine") > 0)
        number = F.row_number().over(Window.partitionBy(*keys).orderBy("r", "b"))
        open_ = settled(told.select(*keys, F.col("lo").alias("low"), F.col("hi").alias("high"), F.col("m").alias("n"), F.col("mine").alias("places"), number.alias("r"), F.col("start").alias("below")))
    out = found[0] if found else places.select(*keys, "place", F.lit(None).cast("double").alias("value")).limit(0)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def quantiles(rows: DataFrame, keys: list[str], value: str, at: dict[str, float], bins: int = BINS, few: int = FEW) -> DataFrame:
    """(*keys, one column for each name of `at`): exact quantiles, between two values in proportion, of the values that
    are not null; groups without any are not there."""
    rows = rows.filter(F.col(value).isNotNull()).select(*keys, value)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), ((F.col("n") - 1) * F.lit(float(q))).alias("pos")) for name, q in at.items()])
    asked = sizes.select(*keys, F.explode(wanted).alias("q")).select(*keys, "q.name", "q.pos", F.floor("q.pos").alias("a"), F.ceil("q.pos").alias("b"))
    asked = settled(asked)
    places = asked.select(*keys, F.col("a").alias("place")).unionByName(asked.select(*keys, F.col("b").alias("place"))).distinct()
    got = settled(values_at(rows, keys, value, places, bins, few))
    one = got.select(*keys, F.col("place").alias("a"), F.col("value").alias("x"))
    two = got.select(*keys, F.col("place").alias("b"), F.col("value").alias("y"))
    both = asked.join(one, [*keys, "a"]).join(two, [*keys, "b"])
    part = F.col("pos") - F.col("a")
    # the same arithmetic as of Spark's percentile: (1 - part) * x + part * y, in that order
    both = both.withColumn("v", F.when(F.col("a") == F.col("b"), F.col("x")).otherwise((F.col("b") - F.col("pos")) * F.col("x") + part * F.col("y")))
    return both.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in at])
