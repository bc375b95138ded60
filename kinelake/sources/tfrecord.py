"""TFRecord shards of serialised examples as a Spark data source, without any protobuf package.

A record is its length (u64), a checksum of it (u32), the payload and a checksum (u32); checksums are not read, and a
shard that ends inside a record ends there. The payload is a map of features, each a list of bytes, floats or unsigned
varints. A shard file is a partition: `spark.read.format("tfrecord")` holds one record of it at a time. Where executors
do not mount the shards, `read` gets them through Spark, a whole shard at a time.

Large shards are read by several tasks with an index: `offsets` passes over a shard by its records' lengths alone, and
`read_at` reads the records that an index (as it is, or filtered) names, each by its place, in parts of `split` bytes.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator
from decimal import Decimal
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from kinelake.operators.order import n_ranges

FEATURES = "map<string,struct<kind:string,floats:array<double>,ints:array<decimal(20,0)>,bytes:array<binary>>>"
SCHEMA = f"path string, record long, features {FEATURES}"


def records(stream: BinaryIO) -> Iterator[memoryview]:
    """The payloads of a shard, one after the other."""
    while len(head := stream.read(12)) == 12:
        (n,) = struct.unpack_from("<Q", head)
        body = stream.read(n + 4)
        if len(body) < n + 4:
            return
        yield memoryview(body)[:n]


def _varint(data: memoryview, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value & (2**64 - 1), at
        shift += 7


def fields(data: memoryview) -> Iterator[tuple[int, int, object]]:
    """(number, wire type, value) of a message's fields."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, kind, value


def feature(data: memoryview) -> tuple[str, list, list, list]:
    kind, floats, ints, texts = "empty", [], [], []
    for number, _, value in fields(data):
        kind = ("empty", "bytes", "float", "int64")[number]
        for _, wire, x in fields(value):
            if number == 1:
                texts.append(bytes(x))
            elif number == 2:
                floats += struct.unpack(f"<{len(x) // 4}f", x)
            elif wire == 0:
                ints.append(x)
            else:
                at = 0
                while at < len(x):
                    v, at = _varint(x, at)
                    ints.append(v)
    return kind, floats, ints, texts


def example(data: memoryview, wanted: list[str] | None = None) -> dict[str, tuple]:
    out = {}
    for _, _, feats in fields(data):
        for _, _, entry in fields(feats):
            parts = {n: v for n, _, v in fields(entry)}
            name = bytes(parts.get(1, b"")).decode()
            if wanted is None or name in wanted:
                out[name] = feature(parts.get(2, memoryview(b"")))
    return out


def decoded(payload: memoryview, wanted: list[str] | None = None) -> dict[str, dict]:
    """A record's features as the fields of SCHEMA; only those that are wanted are read."""
    return {name: {"kind": kind, "floats": f, "ints": [Decimal(i) for i in ints], "bytes": b} for name, (kind, f, ints, b) in example(payload, wanted).items()}


def decode(stream: BinaryIO) -> Iterator[tuple]:
    for k, payload in enumerate(records(stream)):
        yield k, {name: tuple(x.values()) for name, x in decoded(payload).items()}


class Shard(InputPartition):
    def __init__(self, path: str):
        self.path = path


class Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Shard]:
        import glob
        import os

        root = self.path.removeprefix("file://")
        found = sorted(glob.glob(f"{root}/**/*.tfrecord*", recursive=True)) if os.path.isdir(root) else sorted(glob.glob(root))
        return [Shard(p) for p in found]

    def read(self, partition: Shard):
        with open(partition.path, "rb") as f:
            for k, features in decode(f):
                yield partition.path, k, features


class TFRecordSource(DataSource):
    """For shards on a file system that every executor mounts."""

    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of all shards below a path on any store that Spark reads; a shard is decoded where it is read."""
    shards = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tfrecord*").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"], strict=True):
                for k, features in decode(io.BytesIO(data)):
                    yield pd.DataFrame([(path, k, features)], columns=["path", "record", "features"])

    return shards.mapInPandas(run, SCHEMA)


#: Bytes of a shard that one task reads, and bytes of payload in one Arrow batch.
SPLIT, BATCH = 128 << 20, 32 << 20


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """(path, record, offset, length) of every record of the shards below a path that executors mount; only lengths are
    read, and a record that is cut off is not there."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tfrecord*").load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                at, starts, lengths = 0, [], []
                with open(_local(uri), "rb") as f:
                    while len(head := f.read(8)) == 8:
                        (n,) = struct.unpack("<Q", head)
                        if at + 16 + n > size:
                            break
                        starts.append(at + 12)
                        lengths.append(n)
                        at += 16 + n
                        f.seek(at)
                yield pa.RecordBatch.from_arrays([pa.array([uri] * len(starts)), pa.array(range(len(starts)), pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())], names=["path", "record", "offset", "length"])

    return found.select("path", "length").mapInArrow(run, "path string, record long, offset long, length long")


def _local(uri: str) -> str:
    from urllib.parse import unquote, urlparse

    return unquote(urlparse(uri).path) if uri.startswith("file:") else uri


def read_at(index: DataFrame, split: int = SPLIT, wanted: list[str] | None = None) -> DataFrame:
    """The records that an index names, of all features or of those that are wanted."""
    part = F.floor(F.col("offset") / split)
    # into as many tasks as there are: rows of an index are small, but what they name is not
    n = n_ranges(index.sparkSession)
    dealt = index.select("path", "record", "offset", "length").repartition(n, "path", part).sortWithinPartitions("path", "offset")
    schema = to_arrow_schema(T.StructType.fromDDL(SCHEMA))
    return dealt.mapInArrow(lambda batches: _read(batches, wanted, schema), SCHEMA)


def _read(batches: Iterator[pa.RecordBatch], wanted: list[str] | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    file, at = None, None
    try:
        for batch in batches:
            rows, size = [], 0
            for path, record, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "record", "offset", "length")), strict=True):
                if path != at:
                    if file:
                        file.close()
                    file, at = open(_local(path), "rb"), path  # noqa: SIM115
                file.seek(offset)
                rows.append((path, record, list(decoded(memoryview(file.read(length)), wanted).items())))
                size += length
                if size >= BATCH:
                    yield out(rows)
                    rows, size = [], 0
            yield out(rows)
    finally:
        if file:
            file.close()


# ---- steps of an episode, one record each


def discover(spark: SparkSession, split: str, shard_lengths: list[int] | DataFrame, source_id: str) -> DataFrame:
    """(episode_uid, shard, shard_index): an episode's name is its running number over all shards. Lengths are a list or
    rows (shard from 0, n)."""
    rows = shard_lengths
    if isinstance(rows, list):
        rows = spark.createDataFrame([(k, n) for k, n in enumerate(rows)], "shard int, n long")
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a shard
    each = rows.withColumn("start", before).filter("n > 0").withColumn("shard_index", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)))
    return each.select(F.concat(F.lit(f"{source_id}:{split}#"), F.lpad((F.col("start") + F.col("shard_index")).cast("string"), 6, "0")).alias("episode_uid"), "shard", "shard_index")


def numbers(name: str) -> Column:
    """A feature's numbers, whichever list they are in."""
    f = F.try_element_at("features", F.lit(name))
    return F.when(f["kind"] == "float", f["floats"]).when(f["kind"] == "int64", f["ints"].cast("array<double>"))


def step_count() -> Column:
    return F.coalesce(*[F.size(numbers(f"steps/{n}")) for n in ("is_last", "is_first", "is_terminal", "reward")])


def reshaped(values: Column, n_steps: Column) -> Column:
    """A flat list as steps of equal width; a length that does not divide is an error."""
    width = F.floor(F.size(values) / n_steps).cast("int")
    whole = F.when(F.size(values) % n_steps != 0, F.raise_error(F.lit("the list does not divide into steps")).cast("array<array<double>>"))
    return F.coalesce(whole, F.transform(F.sequence(F.lit(0), n_steps - 1), lambda k: F.slice(values, k * width + 1, width)))


def kept_steps(is_last: Column, poses: Column) -> Column:
    """Steps left once trailing ones are trimmed that are both last and without any motion."""
    at = F.transform(is_last, lambda x, i: F.when((x != 0) & F.forall(F.get(poses, i), lambda v: v == 0), F.lit(None).cast("int")).otherwise(i + 1))
    return F.coalesce(F.array_max(at), F.lit(0))


def instruction(texts: Column) -> Column:
    """The task, if all steps have the same instruction."""
    one = F.array_distinct(texts)
    return F.when(F.size(one) == 1, F.get(one, F.lit(0)))


def boundary(is_last: Column, is_terminal: Column) -> Column:
    """Truncated: it has a last step and none that is terminal."""
    return F.exists(is_last, lambda x: x != 0) & ~F.coalesce(F.exists(is_terminal, lambda x: x != 0), F.lit(False))
