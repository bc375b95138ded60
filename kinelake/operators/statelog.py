"""A table of latest states as a log of immutable parts, with snapshots in buckets and commits that are all or nothing.

Rows are appended as a part of their own (plain Parquet) and exist for readers from the moment that a small file, the
commit, has been made under the next free number; commits are made only if absent, so that two writers never take one
number and a writer that dies before leaves rows that nobody sees. A commit may carry a token: of several commits with
one token the first counts and the others are as if they had not been, which is what makes a piece of work that two
workers took by mistake count once.

The latest row of a key is the one of the last commit (and the highest `order` within it). It is found by an aggregate
that each task does for itself first (max_by), over the newest snapshot and the parts since. A snapshot is the latest
rows by buckets of the key's hash; a new one rewrites the buckets whose keys have changed since and names the folders of
the others as they are, so that a small change costs its buckets. Buckets are partition folders: a lookup by key opens
one of them.

    root/parts/<id>/                      rows of one commit
    root/snapshots/version=<n>/bucket=<b>/ latest rows of a bucket as of commit n
    root/commits/<n>.json                 {"kind": "rows" | "snapshot", ...}
    root/claims/<name>                    who takes a piece of work, and when it lapses

Readers that have listed the commits once see that state from then on: no file that a commit names is ever changed.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64


class Files:
    """The few file system calls that a log needs, on any store that Spark reads."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _at(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def put_if_absent(self, path: str, text: str) -> bool:
        """Makes a file with all of its text, unless there is one: a draft is renamed, which shared file systems with
        atomic renames refuse where the name is taken; on a local disk, where a rename overwrites, it is linked."""
        place, fs = self._at(path)
        if fs.getScheme() == "file":
            local = place.toUri().getPath()
            os.makedirs(os.path.dirname(local), exist_ok=True)
            draft = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}.tmp"
            with open(draft, "w") as f:
                f.write(text)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(draft, local)
            except FileExistsError:
                return False
            finally:
                os.unlink(draft)
            return True
        draft = self._at(f"{path}.{uuid.uuid4().hex}.tmp")[0]
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.rename(draft, place):
            return True
        fs.delete(draft, False)
        return False

    def text(self, path: str) -> str:
        place, fs = self._at(path)
        stream = fs.open(place)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def names(self, path: str) -> list[str]:
        place, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def delete(self, path: str) -> None:
        place, fs = self._at(path)
        fs.delete(place, True)


@dataclass(frozen=True)
class Commit:
    number: int
    kind: str
    facts: dict


class StateLog:
    """The log below `root` of rows with this schema; `keys` tell states apart, `order` rows of one key in one commit."""

    def __init__(self, spark: SparkSession, root: str, schema: str | T.StructType, keys: tuple[str, ...] = ("episode_uid",), order: tuple[str, ...] = (), buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.order, self.buckets = spark, root.rstrip("/"), keys, order, buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.files = Files(spark)
        self._read: dict[str, dict] = {}  # commits never change

    # ---- commits

    def commits(self) -> list[Commit]:
        """All commits so far, in order; of those with one token the first."""
        out, tokens = [], set()
        for name in self.files.names(f"{self.root}/commits"):
            if not name.endswith(".json") or name.startswith("."):
                continue
            facts = self._read.get(name)
            if facts is None:
                facts = self._read[name] = json.loads(self.files.text(f"{self.root}/commits/{name}"))
            token = facts.get("token")
            if token and token in tokens:
                continue
            tokens.add(token)
            out.append(Commit(int(name.removesuffix(".json")), facts["kind"], facts))
        return out

    def _commit(self, facts: dict) -> int:
        names = [n for n in self.files.names(f"{self.root}/commits") if n.endswith(".json") and not n.startswith(".")]
        number = int(names[-1].removesuffix(".json")) + 1 if names else 0
        while not self.files.put_if_absent(f"{self.root}/commits/{number:012}.json", json.dumps(facts, sort_keys=True)):
            number += 1
        return number

    def append(self, rows: DataFrame, token: str | None = None, **facts) -> Commit | None:
        """Adds rows at once; nothing is added, and nothing returned, if this token's rows are there already."""
        if token and self.used(token):
            return None
        return self.enter(self.put(rows), token, **facts)

    def used(self, token: str) -> bool:
        return any(c.facts.get("token") == token for c in self.commits())

    def put(self, rows: DataFrame) -> str:
        """Writes rows as a part, which nobody sees before it is entered; its name."""
        part = f"parts/{uuid.uuid4().hex}"
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).write.parquet(f"{self.root}/{part}")
        return part

    def part(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/{name}")

    def drop(self, part: str) -> None:
        """Deletes a part that is not to be entered."""
        self.files.delete(f"{self.root}/{part}")

    def enter(self, part: str, token: str | None = None, **facts) -> Commit | None:
        """Commits a part; if this token's rows are there already, the part goes and nothing is returned."""
        number = self._commit(facts | {"kind": "rows", "part": part, "at": time.time()} | ({"token": token} if token else {}))
        won = [c for c in self.commits() if c.number == number]
        if not won:
            self.drop(part)
        return won[0] if won else None

    # ---- reading

    def _parts(self, commits: list[Commit]) -> DataFrame:
        """Rows of these commits with the number of each."""
        numbers = {c.facts["part"].rpartition("/")[2]: c.number for c in commits if c.kind == "rows"}
        if not numbers:
            return self.spark.createDataFrame([], self.schema).withColumn("_commit", F.lit(0).cast("long"))
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.root}/parts/{n}" for n in numbers])
        folder = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)  # told for every row
        of = self.spark.createDataFrame(list(numbers.items()), "_part string, _commit long")  # a row a commit
        return rows.withColumn("_part", folder).join(F.broadcast(of), "_part").drop("_part")

    def rows(self, since: int = -1, skip: Callable[[Commit], bool] | None = None) -> DataFrame:
        """All rows ever appended after commit `since`, with `_commit`; without commits that `skip` accepts."""
        return self._parts([c for c in self.commits() if c.number > since and not (skip and skip(c))])

    def bucket(self, keys: list[Column] | None = None) -> Column:
        return F.pmod(F.xxhash64(*(keys or [F.col(k) for k in self.keys])), F.lit(self.buckets)).cast("int")

    def snapshot(self) -> tuple[Commit | None, DataFrame]:
        """The newest snapshot's commit and its rows (with `bucket`, a partition column)."""
        found = [c for c in self.commits() if c.kind == "snapshot"]
        if not found:
            return None, self.spark.createDataFrame([], self.schema).withColumn("bucket", F.lit(0))
        folders = [f"{self.root}/snapshots/{f}" for f in found[-1].facts["folders"].values()]
        whole = T.StructType([*self.schema.fields, T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())])
        if not folders:
            return found[-1], self.spark.createDataFrame([], self.schema).withColumn("bucket", F.lit(0))
        rows = self.spark.read.schema(whole).option("basePath", f"{self.root}/snapshots").parquet(*folders)
        return found[-1], rows.drop("version")

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row a key, by the last commit. Without an `order` a key has a row a commit at most: rows are dealt out by key
        as they are, which saves a sort. With one, a key can have any number, and tasks take the best of theirs first."""
        rest = [f.name for f in self.schema if f.name not in self.keys]
        by = F.struct("_commit", *self.order)
        if not self.order:
            rows = rows.repartition(*self.keys)
        best = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), by).alias("_best"))
        return best.select(*[F.col(f.name) if f.name in self.keys else F.col(f"_best.{f.name}").alias(f.name) for f in self.schema])

    def latest(self, where: Column | None = None, keys: Column | None = None, skip: Callable[[Commit], bool] | None = None) -> DataFrame:
        """The latest row of every key, and of those the ones that `where` accepts; only of the keys that `keys` accepts. None
        of these is in the commits that `skip` accepts, which are not read."""
        commit, old = self.snapshot()
        since = self.rows(-1 if commit is None else commit.facts["upto"], skip)
        rows = old.drop("bucket").withColumn("_commit", F.lit(-1).cast("long")).unionByName(since)
        out = self._newest(rows if keys is None else rows.filter(keys))
        return out if where is None else out.filter(where)

    def lookup(self, **key) -> DataFrame:
        """The latest row of one key: one bucket of the snapshot and the rows since."""
        commit, old = self.snapshot()
        mine = [F.lit(key[k]).cast(self.schema[k].dataType) for k in self.keys]
        number = self.spark.range(1).select(self.bucket(mine)).first()[0]
        same = F.lit(True)
        for k, v in zip(self.keys, mine, strict=True):
            same = same & F.col(k).eqNullSafe(v)
        held = old.filter(F.col("bucket") == F.lit(number)).filter(same).drop("bucket").withColumn("_commit", F.lit(-1).cast("long"))
        since = self.rows(-1 if commit is None else commit.facts["upto"]).filter(same)
        return self._newest(held.unionByName(since))

    # ---- snapshots

    def compact(self) -> dict[str, int]:
        """Writes a snapshot as of now: buckets with changed keys anew, the others by name. What it did, in numbers."""
        commits = self.commits()
        done = [c for c in commits if c.kind == "rows"]
        upto = done[-1].number if done else -1
        before, old = self.snapshot()
        since = self._parts([c for c in done if c.number > (-1 if before is None else before.facts["upto"])])
        if before is not None and before.facts["upto"] == upto:
            return {"buckets": len(before.facts["folders"]), "written": 0}
        version = f"{upto:012}-{uuid.uuid4().hex[:8]}"
        touched = [r[0] for r in since.select(self.bucket().alias("b")).distinct().collect()]  # at most `buckets` numbers
        mine = old.filter(F.col("bucket").isin(touched)) if before is not None else old
        rows = self._newest(mine.drop("bucket").withColumn("_commit", F.lit(-1).cast("long")).unionByName(since)).withColumn("bucket", self.bucket())
        place = f"{self.root}/snapshots/version={int(uuid.uuid4().hex[:12], 16)}"
        rows.repartition("bucket").sortWithinPartitions("bucket", *self.keys).write.partitionBy("bucket").parquet(place)
        folders = dict(before.facts["folders"]) if before is not None else {}
        name = place.rpartition("/")[2]
        folders |= {str(b): f"{name}/bucket={b}" for b in touched}
        self._commit({"kind": "snapshot", "upto": upto, "folders": folders, "version": version})
        return {"buckets": len(folders), "written": len(touched)}

    # ---- claims

    def claim(self, work: str, owner: str, ttl_seconds: float, now: float | None = None) -> int | None:
        """The attempt (from 1) with which `owner` has taken a piece of work, or nothing if someone else holds it.

        An attempt is a file that only one can make. Who finds the last one lapsed makes the next. A claim saves work that
        would be done twice; that it counts once is up to tokens (see `append`): a former holder that wakes up finds its
        token used, or does the work's only commit itself."""
        now = time.time() if now is None else now
        held = [n for n in self.files.names(f"{self.root}/claims") if n.rpartition(".")[0] == work and n[-6:].isdigit()]
        attempt = max((int(n.rpartition(".")[2]) for n in held), default=0)
        if attempt:
            last = json.loads(self.files.text(f"{self.root}/claims/{work}.{attempt:06}"))
            if last["until"] > now and last["owner"] != owner:
                return None
        attempt += 1
        mine = json.dumps({"owner": owner, "until": now + ttl_seconds})
        return attempt if self.files.put_if_absent(f"{self.root}/claims/{work}.{attempt:06}", mine) else None

    def release(self, work: str, attempt: int, owner: str) -> None:
        """Gives a claim up, so that anyone may take the work at once."""
        self.files.put_if_absent(f"{self.root}/claims/{work}.{attempt + 1:06}", json.dumps({"owner": owner, "until": 0}))
