"""Tables between the jobs of one operator, in the folder that all executors share.

A written table cuts lineage: a lost executor costs its running tasks, not what came before. The folder is the
session's spark.checkpoint.dir; only where that is unset and there is one JVM (tests) a temporary folder is made. What
an operator writes inside `scratch` goes when it is done, but for its result. Results are read by whoever has the
DataFrame; they go with `drop`, or at the latest when the driver's JVM ends.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("kinelake.shared.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf = "file://" + tempfile.mkdtemp(prefix="kinelake-")
        spark.conf.set("kinelake.shared.dir", conf)
    return conf.rstrip("/")


_scratch: ContextVar[list[str] | None] = ContextVar("_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that `keep` writes here are deleted at the end, unless they are written as `result`."""
    mark = _scratch.set([])
    try:
        yield
    finally:
        paths = _scratch.get() or []
        _scratch.reset(mark)
        for path in paths:
            drop(spark, path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def drop(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, result: bool = False) -> DataFrame:
    """The rows of df, written once and reread."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if not result and _scratch.get() is not None:
        _scratch.get().append(path)
    df.write.parquet(path)
    place, system = _place(spark, path)
    system.deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept = path
    return out


def done(df: DataFrame) -> None:
    """Deletes a table that `keep` returned, before its operator ends, as nothing reads it any more."""
    drop(df.sparkSession, df._kept)


def fresh(name: str, taken: list[str]) -> str:
    """A column name like this one that is not taken (Spark's names differ by more than case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
