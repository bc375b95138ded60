"""The normalised store: long tables by source, missing numbers as NULL, whole partitions replaced at once.

Samples, streams and episodes lie side by side below one root. What an episode no longer has goes when it is written
again. Raw files are staged with a marker that is written last and names the version of what staged them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.functions import signals as S
from kinelake.operators.order import n_ranges, settled


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and infinities of float columns as NULL."""
    plain = [f.name for f in df.schema if f.dataType.simpleString() in ("float", "double")]
    return df.withColumns({c: S.finite(F.col(f"`{c}`")) for c in plain})


def write(df: DataFrame, path: str, by: tuple[str, ...] = ("source_id",), sort: tuple[str, ...] = ("episode_uid", "frame_idx")) -> None:
    """Replaces the partitions that df has rows of, and no other; rows of an episode lie together in a file."""
    keys = [c for c in sort if c in df.columns]
    dealt = nan_to_null(df).repartition(*by, *keys[:1]).sortWithinPartitions(*keys)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read(spark: SparkSession, path: str, source_id: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if source_id is None else df.filter(F.col("source_id") == source_id)


def write_episodes(episodes: DataFrame, frames: DataFrame, path: str) -> None:
    """Episode records beside the frames, each with the raw columns that it has (`raw_columns`, in order of names)."""
    names = frames.select("episode_uid", F.explode(F.map_keys("raw")).alias("c")).groupBy("episode_uid").agg(F.sort_array(F.collect_set("c")).alias("raw_columns"))
    told = episodes.drop("raw_columns").join(names, "episode_uid", "left").withColumn("raw_columns", F.coalesce("raw_columns", F.array().cast("array<string>")))
    write(told, path, sort=("episode_uid",))


def unregistered(frames: DataFrame, registry: DataFrame) -> DataFrame:
    """Raw columns that an episode has and did not register, or registered and does not have."""
    have = frames.select("episode_uid", F.explode(F.map_keys("raw")).alias("column")).distinct()
    told = registry.select("episode_uid", F.explode("raw_columns").alias("column")).distinct()
    return have.exceptAll(told).withColumn("problem", F.lit("not registered")).unionByName(told.exceptAll(have).withColumn("problem", F.lit("not there")))


def content_hash(columns: DataFrame) -> DataFrame:
    """(episode_uid, content_hash) of rows (episode_uid, pos, column, dtype, frame_idx, value): a digest of what an episode
    holds, whatever file it is in. A header with the columns' names, types and length comes first, then each column's
    values in order of frames as little-endian float64; columns go by `pos`, those without one behind, by name.

    A digest is a chain, so that an episode's rows pass through one task, sorted, a batch at a time; what is held is the
    digest's state."""
    uid = "episode_uid"
    each = columns.groupBy(uid, "column").agg(F.min("pos").alias("pos"), F.min("dtype").alias("dtype"), F.count(F.lit(1)).alias("n"))
    listed = F.sort_array(F.collect_list(F.struct(F.col("pos").isNull().alias("last"), F.coalesce("pos", F.lit(0)).alias("by"), "column", "dtype")))
    heads = each.groupBy(uid).agg(listed.alias("l"), F.max("n").alias("n_rows"))
    none = lambda kind: F.lit(None).cast(kind)
    kinds = dict(columns.dtypes)
    first = heads.select(uid, F.lit(0).alias("kind"), none("boolean").alias("last"), none(kinds["pos"]).alias("by"), none("string").alias("column"), none(kinds["frame_idx"]).alias("frame_idx"), none("double").alias("value"), F.col("l.column").alias("columns"), F.col("l.dtype").alias("dtypes"), "n_rows")
    rows = columns.select(uid, F.lit(1).alias("kind"), F.col("pos").isNull().alias("last"), F.coalesce("pos", F.lit(0)).cast(kinds["pos"]).alias("by"), "column", "frame_idx", F.col("value").cast("double").alias("value"), none("array<string>").alias("columns"), none("array<string>").alias("dtypes"), none("bigint").alias("n_rows"))
    dealt = first.unionByName(rows).repartition(uid).sortWithinPartitions(uid, "kind", "last", "by", "column", "frame_idx")
    return dealt.select(uid, "kind", "value", "columns", "dtypes", "n_rows").mapInArrow(_digests, "episode_uid string, content_hash string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of episodes whose rows come one after the other, each episode's header first."""
    now, digest = None, None
    for batch in batches:
        kind, values = batch.column("kind").to_numpy(zero_copy_only=False), batch.column("value").to_numpy(zero_copy_only=False)
        heads = np.flatnonzero(kind == 0)
        ends = np.append(heads, len(kind))
        done = []
        if digest is not None:
            digest.update(np.ascontiguousarray(values[: ends[0]], "<f8").tobytes())
        for at, end in zip(heads.tolist(), ends[1:].tolist(), strict=True):
            if digest is not None:
                done.append((now, digest.hexdigest()))
            now = batch.column("episode_uid")[at].as_py()
            head = {c: batch.column(c)[at].as_py() for c in ("columns", "dtypes", "n_rows")}
            digest = hashlib.sha256(json.dumps(head, sort_keys=True, separators=(",", ":")).encode())
            digest.update(np.ascontiguousarray(values[at + 1 : end], "<f8").tobytes())
        yield _told(done)
    if digest is not None:
        yield _told([(now, digest.hexdigest())])


def _told(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], names=["episode_uid", "content_hash"])


def files_of(spark: SparkSession, path: str, episodes: DataFrame | None = None) -> DataFrame:
    """(episode_uid, files): the files below a path that have rows of an episode; one that will not open has none."""
    rows = spark.read.option("ignoreCorruptFiles", "true").schema("episode_uid string").parquet(path).select("episode_uid", F.col("_metadata.file_path").alias("file"))
    if episodes is not None:
        rows = rows.join(episodes.select("episode_uid"), "episode_uid", "left_semi")
    return rows.distinct().groupBy("episode_uid").agg(F.sort_array(F.collect_list("file")).alias("files"))


def probe(files: DataFrame) -> DataFrame:
    """(episode_uid, file, readable, error) of rows (episode_uid, file): whether each file is there and its footer opens.

    Every file is opened once, wherever Spark runs the task, and only its footer is read."""
    once = files.select("file").distinct()
    told = once.repartition(n_ranges(files.sparkSession), "file").mapInArrow(_footers, "file string, error string")
    return files.select("episode_uid", "file").join(told, "file").select("episode_uid", "file", F.col("error").isNull().alias("readable"), "error")


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def error(uri: str) -> str | None:
        system, path = FileSystem.from_uri(uri)  # a store that cannot be reached at all is the job's failure, not the file's
        try:
            with system.open_input_file(path) as f:
                pq.ParquetFile(f)
        except FileNotFoundError:
            return "gone"
        except (pa.ArrowInvalid, OSError) as e:
            return f"{type(e).__name__}: {str(e).partition(chr(10))[0]}"
        return None

    for batch in batches:
        uris = batch.column(0)
        yield pa.RecordBatch.from_arrays([uris, pa.array([error(u) for u in uris.to_pylist()], pa.string())], names=["file", "error"])


def write_streams(streams: DataFrame, path: str, episodes: DataFrame) -> None:
    """Replaces all streams of these episodes (source_id, episode_uid): samples (source_id, episode_uid, stream_id,
    sample_idx, ...) of those that they have now, and none of those that they had before."""
    spark = streams.sparkSession
    keys = ["source_id", "episode_uid"]
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        sources = [r[0] for r in episodes.select("source_id").distinct().collect()]
        kept = spark.read.schema(streams.schema).parquet(path).filter(F.col("source_id").isin(sources)).join(episodes.select(*keys).distinct(), keys, "left_anti")
        streams = settled(kept.unionByName(streams))
    write(streams, path, sort=("episode_uid", "stream_id", "sample_idx"))


def stage(spark: SparkSession, path: str, version: str, **facts: object) -> None:
    """Marks raw files below a path as complete; to be called when all that it describes is there."""
    marker = json.dumps({**facts, "adapter_version": version}, sort_keys=True)
    spark.createDataFrame([(marker,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/.staged")


def is_staged(spark: SparkSession, path: str, version: str) -> bool:
    """Whether the files are complete and of this version; another one has to stage them anew."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/.staged")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return False
    rows = spark.read.text(f"{path}/.staged/part-*").collect()
    return bool(rows) and json.loads(rows[0][0]).get("adapter_version") == version
