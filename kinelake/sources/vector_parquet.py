"""Recordings as vector columns in Parquet: a row per frame, an episode a range of the dataset's global index.

Layout: meta/info.json, meta/episodes/**.parquet, meta/tasks.parquet, data/**.parquet. Episodes are found from
metadata alone; frames are sliced by the global index (never by a file offset), which Parquet statistics prune; vector
elements become named channels by position, after their number was checked against the declared one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.functions import signals as S

#: Columns that only keep books, and the vectors; all other scalar columns become raw values.
BOOKKEEPING = ("episode_index", "frame_index", "index", "task_index")
VECTORS = {"action": "action", "observation.state": "state"}


def info(spark: SparkSession, root: str) -> dict:
    return json.loads(spark.read.text(f"{root}/meta/info.json", wholetext=True).first()[0])


def discover(spark: SparkSession, root: str, source_id: str) -> DataFrame:
    """(episode_uid, source_id, episode_index, from_index, to_index, length, tasks); fewer episodes than declared fail."""
    expected = info(spark, root)["total_episodes"]
    e = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/meta/episodes")
    found = e.count()
    if found < expected:
        raise ValueError(f"{root} declares {expected} episodes, its metadata has {found}")
    tasks = F.col("tasks") if "tasks" in e.columns else F.array().cast("array<string>")
    return e.select(
        F.concat(F.lit(f"{source_id}:"), F.col("episode_index").cast("string")).alias("episode_uid"), F.lit(source_id).alias("source_id"), F.col("episode_index").cast("long").alias("episode_index"),
        F.col("dataset_from_index").cast("long").alias("from_index"), F.col("dataset_to_index").cast("long").alias("to_index"), F.col("length").cast("long").alias("length"), tasks.alias("tasks"),
    )


def slice_frames(data: DataFrame, episodes: DataFrame) -> DataFrame:
    """Rows whose global index lies in an episode's range, with its uid. Ranges join by the episode index if the data
    have one, otherwise by the range itself, in buckets of a thousand indices so that it stays an equi-join."""
    e = episodes.select("episode_uid", F.col("episode_index").alias("_e"), "from_index", "to_index")
    inside = (F.col("index") >= F.col("from_index")) & (F.col("index") < F.col("to_index"))
    if "episode_index" in data.columns:
        joined = data.join(e, (F.col("episode_index") == F.col("_e")) & inside)
    else:
        wide = e.withColumn("_b", F.explode(F.sequence(F.floor(F.col("from_index") / 1000), F.floor((F.col("to_index") - 1) / 1000))))
        joined = data.withColumn("_d", F.floor(F.col("index") / 1000)).join(wide, (F.col("_b") == F.col("_d")) & inside).drop("_b", "_d")
    return joined.drop("_e", "from_index", "to_index")


def check_lengths(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Episodes whose number of rows is not that of their range."""
    n = frames.groupBy("episode_uid").agg(F.count(F.lit(1)).alias("n_rows"))
    return episodes.join(n, "episode_uid", "left").select("episode_uid", (F.col("to_index") - F.col("from_index")).alias("expected"), F.coalesce("n_rows", F.lit(0)).alias("n_rows")).filter("expected <> n_rows")


def task_texts(spark: SparkSession, root: str) -> DataFrame:
    """(task_index, task), from whichever column has the text; no rows where the dataset has no such file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/meta/tasks.parquet")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], "task_index long, task string")
    t = spark.read.parquet(f"{root}/meta/tasks.parquet")
    text = "__index_level_0__" if "__index_level_0__" in t.columns else "task"
    return t.select("task_index", F.col(text).alias("task"))


def unpack(frames: DataFrame, channels: DataFrame, embodiment: str) -> DataFrame:
    """Samples of the canonical schema: vector elements by position, missing numbers as NULL, time from the first frame."""
    w = Window.partitionBy("episode_uid").orderBy("index")
    base = frames.withColumn("frame_idx", F.row_number().over(w) - 1).withColumn("t", S.rebased(F.col("timestamp").cast("double"), ["episode_uid"], "index"))
    out = None
    for column, signal in VECTORS.items():
        if column in frames.columns:
            one = base.select("episode_uid", "frame_idx", "t", F.lit(signal).alias("signal"), F.posexplode(F.col(f"`{column}`").cast("array<double>")).alias("pos", "value"))
            out = one if out is None else out.unionByName(one)
    declared = channels.filter(F.col("embodiment") == embodiment).select("embodiment", "signal", "pos", "channel")
    return out.join(F.broadcast(declared), ["signal", "pos"]).select("episode_uid", "embodiment", "signal", "channel", "frame_idx", "t", S.finite("value").alias("value"))


def transforms(frames: DataFrame, source: DataFrame) -> DataFrame:
    """(episode_uid, transforms): what unpacking does to an episode: its time starts at 0 where it did not, vectors become
    named channels, and numbers that are missing become NULL. `source` has (episode_uid, timestamp_source)."""
    vectors = [c for c in VECTORS if c in frames.columns]
    holes = sum((F.size(F.filter(F.col(f"`{c}`"), lambda x: F.isnan(x) | x.isNull())) for c in vectors), F.lit(0))
    a = frames.groupBy("episode_uid").agg(F.min("timestamp").alias("t0"), F.sum(F.greatest(holes, F.lit(0))).cast("int").alias("holes")).join(source, "episode_uid")
    make = lambda op, n, columns: F.struct(F.lit(op).alias("op"), n.cast("int").alias("n"), F.array(*map(F.lit, columns)).cast("array<string>").alias("columns"))
    steps = [
        F.when(F.col("t0") != 0, make("rebase_time", F.lit(None), ["timestamp"])), F.when(F.lit(bool(vectors)), make("unpack_vectors", F.lit(len(vectors)), vectors)),
        F.when(F.col("holes") > 0, make("missing_to_null", F.col("holes"), vectors)), F.when(F.col("timestamp_source") != "real", make("clock_is_synthesized", F.lit(None), ["timestamp"])),
    ]
    return a.select("episode_uid", F.array_compact(F.array(*steps)).alias("transforms"))


def check_widths(frames: DataFrame, channels: DataFrame, embodiment: str) -> DataFrame:
    """(signal, width, declared) where a vector's width is not the number of declared channels."""
    declared = channels.filter(F.col("embodiment") == embodiment).groupBy("signal").agg(F.count(F.lit(1)).alias("declared"))
    out = None
    for column, signal in VECTORS.items():
        if column in frames.columns:
            one = frames.select(F.lit(signal).alias("signal"), F.size(F.col(f"`{column}`")).alias("width")).distinct()
            out = one if out is None else out.unionByName(one)
    return out.join(declared, "signal", "left").filter(~F.col("width").eqNullSafe(F.col("declared")))


def raw_frames(frames: DataFrame) -> DataFrame:
    """(episode_uid, frame_idx, t, raw): scalars that are neither vectors, time nor books, as a map of doubles."""
    w = Window.partitionBy("episode_uid").orderBy("index")
    plain = [f.name for f in frames.schema if f.dataType.simpleString() in ("float", "double", "bigint", "int", "boolean") and f.name not in (*BOOKKEEPING, "timestamp")]
    cell = [x for c in plain for x in (F.lit(c), S.finite(F.col(f"`{c}`").cast("double")))]
    raw = F.create_map(*cell) if cell else F.create_map().cast("map<string,double>")
    return frames.select("episode_uid", (F.row_number().over(w) - 1).alias("frame_idx"), S.rebased(F.col("timestamp").cast("double"), ["episode_uid"], "index").alias("t"), raw.alias("raw"))


def timestamp_source(frames: DataFrame, fps: float) -> DataFrame:
    """(episode_uid, timestamp_source): made up if every time is exactly frame / fps in single precision; without numbers
    of frames nothing says so, and it is real."""
    if "frame_index" not in frames.columns:
        return frames.select("episode_uid").distinct().withColumn("timestamp_source", F.lit("real"))
    made = F.col("timestamp") == (F.col("frame_index") / F.lit(float(fps))).cast("float")
    return frames.groupBy("episode_uid").agg(F.when(F.bool_and(made), f"synthesized@{fps:g}Hz").otherwise("real").alias("timestamp_source"))


def effective_fps(frames: DataFrame, nominal: Column) -> DataFrame:
    """(episode_uid, fps): one over the median step, or the nominal rate where that says nothing."""
    d = frames.select("episode_uid", S.difference(F.col("timestamp").cast("double"), Window.partitionBy("episode_uid").orderBy("index")).alias("dt"))
    mid = d.groupBy("episode_uid").agg(F.percentile("dt", F.lit(0.5)).alias("mid"))
    return mid.select("episode_uid", F.when(F.col("mid") > 0, F.try_divide(F.lit(1.0), "mid")).otherwise(nominal).alias("fps"))


def boundary(frames: DataFrame) -> DataFrame:
    """(episode_uid, success, adjudicator, truncated): success is told by any frame, or not known."""
    if "next.success" not in frames.columns:
        return frames.select("episode_uid").distinct().select("episode_uid", F.lit(None).cast("boolean").alias("success"), F.lit("none").alias("adjudicator"), F.lit(None).cast("boolean").alias("truncated"))
    return frames.groupBy("episode_uid").agg(F.bool_or("`next.success`").alias("success")).select("episode_uid", "success", F.lit("environment").alias("adjudicator"), F.lit(None).cast("boolean").alias("truncated"))


def cameras(meta: dict) -> list[dict]:
    """Image and video features as cameras; a wrist mount only where the name says so."""
    out = []
    for name, f in sorted(meta.get("features", {}).items()):
        if f.get("dtype") in ("video", "image"):
            shape = f.get("shape") or [None, None, None]
            out.append({"name": name, "mount": "wrist" if "wrist" in name.lower() else "unknown", "height": shape[0], "width": shape[1], "encoding": "mp4_sidecar" if f["dtype"] == "video" else "inline"})
    return out
