"""Total orders without a sort on one task: rows are dealt out by ranges, sorted in place and numbered."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share. Only where that is unset and there is one JVM (tests) a
    temporary folder is set."""
    sc = spark.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and not sc._jsc.sc().getCheckpointDir().isDefined():
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="kinelake-"))
    return sc._jsc.sc().getCheckpointDir().get()


def settled(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and kept in the session's checkpoint folder."""
    folder(df.sparkSession)
    return df.checkpoint()


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of df dealt out by keys, computed once and kept in a way that Spark knows: windows, groupings and joins by
    these keys find their rows in place. How adaptive plans lie is not kept with their rows, so that this one is made
    without adaptation; the setting is the session's own again afterwards."""
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return settled(df.repartition(n_ranges(df.sparkSession), *keys))
    finally:
        conf.set(name, before)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the session's checkpoint folder, whose files go when the driver's JVM ends."""
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


#: Rows of a table that every task may have, and rows that a task is dealt in the mean.
FEW_ROWS, ROWS_EACH = 1 << 16, 1 << 19


def few(df: DataFrame, most: int = FEW_ROWS) -> DataFrame:
    """df, to be sent to every task where it turns out to have at most `most` rows; df is settled. What is joined with it
    then stays where it is, however few keys there are."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def spread(df: DataFrame, n_rows: int, *keys: str, each: int = ROWS_EACH) -> DataFrame:
    """df dealt out by keys to as many tasks as its number of rows asks for, so that a task has no more when it grows."""
    return df.repartition(max(n_ranges(df.sparkSession), -(-n_rows // each)), *keys)


def n_ranges(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """df with each row's place (from 1) in its group by `order`, which must tell all rows of a group apart. Columns of
    `group` are not NULL. A group of any size is spread over as many ranges as it fills."""
    by = [*group, *order]
    dealt = df.repartitionByRange(n_ranges(df.sparkSession), *by).sortWithinPartitions(*by)
    rows = settled(dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)))
    part = rows.groupBy(*group, "_range").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_range")) - F.col("_n")
    told = part.select(*group, "_range", "_low", before.alias("_before"))
    return rows.join(told, [*group, "_range"]).withColumn(name, F.col("_at") - F.col("_low") + F.col("_before") + 1).drop("_at", "_range", "_low", "_before")
