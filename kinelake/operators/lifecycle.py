"""Episodes on their way through a run: changes of stage, leases, ingestion in sets, and what is timed and counted.

A run takes the work-list through fetch, normalise, quality control and commit in batches of episodes, each stage one job
over the episodes of a batch that need it, and each stage of a batch one commit in a log of states (see `statelog`). What
was committed is never done again: a run that dies goes on, in the next one, behind the last commit, and repeats at most
the one stage of the one batch that it had in hand. Batches are claimed, so that several workers can share a run; if two
hold one batch all the same, one of them commits and the other's rows do not exist.

An episode that fails must not take others with it. Stages say what failed in a column `error` of their rows, which costs
nothing; a stage that raises all the same is run again over halves of its episodes, in a bounded number of jobs, after
which what still raises fails together.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.operators.history import STAGES, recover, stage_rank
from kinelake.operators.order import settled
from kinelake.operators.report import failure_reason
from kinelake.operators.statelog import StateLog
from kinelake.sources.store import probe

PENDING = "PENDING"
# What a run counts, and the points at which it can be made to die.
COUNTERS = ("discovered", "skipped_already_processed", "stale_renormalize", "stale_reqc", "resumed_in_progress", "fetched", "normalized", "qc_done", "committed", "failed")
CHECKPOINTS = ("fetch.before", "fetch.after", "normalize.before", "normalize.after_write_before_commit", "qc.before", "qc.mid_rule", "qc.after_episode_n", "commit.after_file_before_db")


def advanced(episodes: DataFrame, to: str, run_id: str, now: Column, **changes: Column) -> DataFrame:
    """Episodes one stage on, with what the stage has found; any other step is an error in the row that makes it."""
    here = stage_rank(F.col("status"))
    status = F.when(here + 1 == STAGES.index(to), F.lit(to)).otherwise(F.raise_error(F.concat(F.lit("no step from "), F.col("status"), F.lit(f" to {to}"))).cast("string"))
    return episodes.withColumns({"status": status, "last_update_run": F.lit(run_id), "updated_at": now, "last_error": F.lit(None).cast("string"), **changes})


def requeued(episodes: DataFrame, stage: Column | str, reason: str, run_id: str, now: Column) -> DataFrame:
    """Episodes back at an earlier stage; the verdict is open again, as what it was reached by is about to change."""
    if not reason:
        raise ValueError("going back needs a reason")
    to = F.lit(stage) if isinstance(stage, str) else stage
    return episodes.withColumns({"status": to, "qc_verdict": F.lit(PENDING), "last_error": F.lit(None).cast("string"), "last_update_run": F.lit(run_id), "updated_at": now})


def failed(episodes: DataFrame, error: Column, run_id: str, now: Column) -> DataFrame:
    return episodes.withColumns({"status": F.lit("FAILED"), "last_error": error, "last_update_run": F.lit(run_id), "updated_at": now})


def leased(episodes: DataFrame, states: DataFrame, owner: str, now: Column, ttl_seconds: int) -> DataFrame:
    """State rows of episodes that a worker takes: one attempt more than their last one."""
    before = states.select("episode_uid", F.col("attempt").alias("_a"))
    taken = episodes.select("episode_uid", "status").join(before, "episode_uid", "left")
    return taken.select("episode_uid", "status", (F.coalesce("_a", F.lit(0)) + 1).alias("attempt"), F.lit(owner).alias("lease_owner"), (now + F.make_interval(secs=F.lit(ttl_seconds))).alias("lease_expires_at"), F.lit(None).cast("string").alias("last_error"), now.alias("updated_at"))


def released(states: DataFrame, now: Column, error: Column | None = None) -> DataFrame:
    none = F.lit(None)
    return states.withColumns({"lease_owner": none.cast("string"), "lease_expires_at": none.cast("timestamp"), "last_error": none.cast("string") if error is None else error, "updated_at": now})


def expired(states: DataFrame, now: Column, owner: str) -> DataFrame:
    """Leases that nobody can hold any more: without an end, past it, or the caller's own from a life before."""
    return states.filter(F.col("lease_owner").isNotNull() & (F.col("lease_expires_at").isNull() | (F.col("lease_expires_at") <= now) | (F.col("lease_owner") == owner)))


def recovery(runs: DataFrame, episodes: DataFrame, states: DataFrame, readable: DataFrame, owner: str, run_id: str, now: Column) -> dict[str, DataFrame]:
    """What a restart has to write: open runs closed, leases that nobody holds released, and episodes sent back to be
    normalised again whose artifact (episode_uid in `readable`) will not open; and the run that it goes on from."""
    found = recover(runs, episodes, readable, now)
    lost = episodes.join(found["demoted"].select("episode_uid"), "episode_uid", "left_semi")
    return {"interrupted": found["interrupted"], "resumed_from": found["resumed_from"], "released": released(expired(states, now, owner), now), "demoted": requeued(lost, "FETCHED", "unreadable artifact", run_id, now)}


def sweep(spark: SparkSession, root: str) -> list[str]:
    """Deletes files *.tmp below a root, which a writer that died has left; their paths."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files, gone = (fs.listFiles(place, True) if fs.exists(place) else None), []
    while files is not None and files.hasNext():
        path = files.next().getPath()
        if path.getName().endswith(".tmp"):
            fs.delete(path, False)
            gone.append(path.toString())
    return sorted(gone)


class Faults:
    """Ends the process at the n-th time that it comes to a checkpoint, as if it were killed; for tests of recovery."""

    def __init__(self, spec: str = "", die: Callable[[int], None] = os._exit):
        name, _, n = spec.partition(":")
        if name.strip() and name.strip() not in CHECKPOINTS:
            raise ValueError(f"no checkpoint {name.strip()!r}")
        self.name, self.left, self.die = name.strip(), int(n or 1), die

    def reach(self, checkpoint: str) -> None:
        if checkpoint == self.name:
            self.left -= 1
            if self.left == 0:
                self.die(1)


@dataclass
class Run:
    run_id: str
    counters: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTERS, 0))
    seconds: dict[str, float] = field(default_factory=dict)
    calls: dict[str, int] = field(default_factory=dict)
    #: The first failures for the report, and how many there are by reason.
    failures: list[tuple[str, str]] = field(default_factory=list)
    reasons: dict[str, int] | None = None

    @contextmanager
    def timed(self, stage: str):
        """Attributes time to a stage, also when it raises."""
        began = time.monotonic()
        try:
            yield
        finally:
            self.seconds[stage] = self.seconds.get(stage, 0.0) + time.monotonic() - began
            self.calls[stage] = self.calls.get(stage, 0) + 1

    def count(self, name: str, n: int) -> None:
        self.counters[name] += n

    def lost(self, failures: DataFrame, listed: int = 1000) -> None:
        """Counts failures (episode_uid, error); by reason in Spark, the first ones for the report."""
        self.reasons = self.reasons or {}
        for reason, n in failures.groupBy(failure_reason(F.col("error"))).count().collect():  # a row a kind of error
            self.reasons[reason] = self.reasons.get(reason, 0) + n
            self.count("failed", n)
        some = failures.orderBy("episode_uid").limit(max(listed - len(self.failures), 0))
        self.failures += [tuple(r) for r in some.select("episode_uid", "error").collect()]

    def stats(self) -> dict:
        from collections import Counter

        reasons = Counter(e.partition(":")[0].strip() or "unknown" for _, e in self.failures) if self.reasons is None else self.reasons
        stages = ("fetch", "normalize", "qc", "commit")
        return {
            "counters": self.counters, "stage_seconds": {s: round(self.seconds.get(s, 0.0), 3) for s in stages}, "stage_calls": {s: self.calls.get(s, 0) for s in stages},
            "failure_reasons": dict(sorted(reasons.items(), key=lambda x: (-x[1], x[0]))), "failures": [{"episode_uid": u, "error": e} for u, e in self.failures],
        }


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of episodes without an error, and (episode_uid, error) of the others, the least error of each."""
    if "error" not in rows.columns:
        return rows, rows.sparkSession.createDataFrame([], "episode_uid string, error string")
    bad = rows.filter("error IS NOT NULL").groupBy("episode_uid").agg(F.min("error").alias("error"))
    return rows.drop("error").join(bad.select("episode_uid"), "episode_uid", "left_anti"), bad


def tried(work: DataFrame, stage: Callable[[DataFrame], DataFrame], jobs: int = 24) -> tuple[list[DataFrame], list[DataFrame]]:
    """The rows of `stage` over the sets of episodes that it does not raise on, and (episode_uid, error) of the others.

    A set on which it raises is halved; after `jobs` attempts no more are, and those that raise fail as a whole."""
    done, raised, todo = [], [], [(work, 0)]
    while todo:
        part, depth = todo.pop()
        jobs -= 1
        try:
            done.append(settled(stage(part)))
            continue
        except Exception as e:  # whatever a source does wrong
            said = f"{type(e).__name__}: {str(e).partition(chr(10))[0]}"
        side = F.pmod(F.xxhash64(F.lit(depth), F.col("episode_uid")), F.lit(2)) == 0
        if jobs <= 0 or len(part.select("episode_uid").distinct().take(2)) < 2:
            raised.append(part.select("episode_uid", F.lit(said).alias("error")).distinct())
            continue
        todo += [(half, depth + 1) for half in (settled(part.filter(x)) for x in (side, ~side)) if half.take(1)]
    return done, raised


def apart(work: DataFrame, stage: Callable[[DataFrame], DataFrame], jobs: int = 24) -> tuple[DataFrame | None, DataFrame]:
    """The rows of `stage` over all episodes that it does not fail on, and (episode_uid, error) of those that it does."""
    done, raised = tried(work, stage, jobs)
    split = [split_errors(rows) for rows in done]
    return (reduce(DataFrame.unionByName, [good for good, _ in split]) if split else None), settled(reduce(DataFrame.unionByName, [bad for _, bad in split] + raised))


def told(rows: DataFrame, *columns: str) -> DataFrame:
    """(episode_uid, error, ...) of the rows of a stage, one an episode: the least error, and NULL where there is none."""
    if "error" in rows.columns:
        return rows.groupBy("episode_uid").agg(F.min("error").alias("error"), *[F.min(c).alias(c) for c in columns])
    return rows.select("episode_uid", F.lit(None).cast("string").alias("error"), *columns) if columns else rows.select("episode_uid").distinct().withColumn("error", F.lit(None).cast("string"))


@dataclass
class Source:
    """What a source has to bring: `discover` gives episodes, `fetch` makes their raw rows available, `normalize` gives
    canonical rows (episode_uid, ...) of them, `judge` (episode_uid, qc_verdict) from these, `write` stores canonical rows
    so that writing them again replaces them, `files` (episode_uid, files) of episodes that are stored. Rows of the first
    three may have a column `error`."""

    discover: Callable[[], DataFrame]
    fetch: Callable[[DataFrame], DataFrame]
    normalize: Callable[[DataFrame], DataFrame]
    judge: Callable[[DataFrame], DataFrame]
    write: Callable[[DataFrame], None]
    files: Callable[[DataFrame], DataFrame] | None = None


#: Rows of the log of episodes, and of the log of runs.
EPISODES = "episode_uid string, status string, qc_verdict string, last_error string, last_update_run string, updated_at timestamp, files array<string>"
RUNS = "run_id string, status string, started_at timestamp, finished_at timestamp, resumed_from string, stats string"


def episode_log(spark: SparkSession, root: str, buckets: int = 64) -> StateLog:
    return StateLog(spark, f"{root}/episodes", EPISODES, buckets=buckets)


def run_log(spark: SparkSession, root: str) -> StateLog:
    return StateLog(spark, f"{root}/runs", RUNS, keys=("run_id",), buckets=1)


def begin(runs: StateLog, run: Run) -> str | None:
    """Enters a run, closes those that a dead process left open, and tells the newest of them."""
    open_ = runs.latest(F.col("finished_at").isNull() & (F.col("run_id") != run.run_id))
    last = open_.orderBy(F.desc("started_at"), F.desc("run_id")).select("run_id").head()
    resumed = last[0] if last else None
    now = F.current_timestamp()
    closed = open_.withColumns({"status": F.lit("INTERRUPTED"), "finished_at": now})
    mine = runs.spark.range(1).select(
        F.lit(run.run_id).alias("run_id"), F.lit("RUNNING").alias("status"), now.alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"), F.lit(resumed).cast("string").alias("resumed_from"), F.lit(None).cast("string").alias("stats"),
    )
    runs.append(settled(closed.unionByName(mine)))
    return resumed


def finish(runs: StateLog, run: Run) -> None:
    done = {"status": F.lit("COMPLETED"), "finished_at": F.current_timestamp(), "stats": F.lit(json.dumps(run.stats(), sort_keys=True))}
    runs.append(settled(runs.lookup(run_id=run.run_id).withColumns(done)))


def demote_unreadable(log: StateLog, run: Run) -> DataFrame:
    """Sends episodes back to be normalised again of whose files one is gone or will not open; their uids."""
    asked = log.latest(F.col("status").isin("NORMALIZED", "QC_DONE", "COMMITTED"))
    broken = probe(asked.select("episode_uid", F.explode("files").alias("file"))).filter("NOT readable").select("episode_uid").distinct()
    broken = settled(broken)
    if broken.take(1):
        lost = asked.join(broken, "episode_uid", "left_semi")
        log.append(settled(requeued(lost, "FETCHED", "unreadable artifact", run.run_id, F.current_timestamp())))
    return broken


def due(discovered: DataFrame, log: StateLog, stale: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(episode_uid, action, from_stage) of what a run has to do, by the log: new ones, failed ones anew, unfinished ones
    from their stage, and what `stale` says of committed ones (episode_uid, action, from_stage)."""
    have = log.latest().select("episode_uid", "status")
    both = discovered.select("episode_uid").distinct().join(have, "episode_uid", "left")
    action = F.when(F.col("status").isNull(), "NEW").when(F.col("status") == "FAILED", "RETRY").when(F.col("status") != "COMMITTED", "RESUME")
    stage = F.when(F.col("status").isNull() | (F.col("status") == "FAILED"), "DISCOVERED").otherwise(F.col("status"))
    out = both.select("episode_uid", action.alias("action"), stage.alias("from_stage")).filter("action IS NOT NULL")
    if stale is None:
        return out
    return out.unionByName(stale(both.filter("status = 'COMMITTED'")).select("episode_uid", "action", "from_stage"))


def ingest(log: StateLog, work: DataFrame, source: Source, run: Run, faults: Faults | None = None, n_discovered: int | None = None, batches: int = 1, owner: str = "run", ttl_seconds: float = 3600) -> DataFrame:
    """The latest states after a run over the work-list (episode_uid, action, from_stage), batch by batch.

    Files are written before the log says so, so that a run that dies between the two writes them again. Episodes found
    and not on the work-list are counted as skipped. A batch that another worker holds is left to it."""
    faults = faults or Faults()
    work = settled(work)
    actions = {r[0]: r[1] for r in work.groupBy("action").count().collect()}
    for action, name in (("NEW", "discovered"), ("RESUME", "resumed_in_progress"), ("REDO_NORMALIZE", "stale_renormalize"), ("REDO_QC", "stale_reqc")):
        run.count(name, actions.get(action, 0))
    run.count("skipped_already_processed", max((n_discovered or 0) - sum(actions.values()), 0))
    for k in range(batches):
        mine = work.filter(_batch_of(batches) == k)
        name = f"{k}-{batches}"
        attempt = log.claim(name, owner, ttl_seconds) if mine.take(1) else None
        if attempt:
            _batch(log, mine, source, run, faults, k, batches)
            log.release(name, attempt, owner)
    return log.latest()


def _base(log: StateLog, name: str) -> int:
    """The last commit that a batch's episodes can be in; whoever goes on from there takes the same token."""
    return max((c.number for c in log.commits() if c.kind == "rows" and c.facts.get("batch", name) == name), default=-1)


def _still(log: StateLog, work: DataFrame, k: int, batches: int) -> DataFrame:
    """(episode_uid, status, qc_verdict, files) of a batch as of now: what another worker has done since the work-list was
    made is not done again. Episodes that go back on purpose (from a stage before the one that they are at) stay as they
    are. What other batches of as many have committed has none of this one's episodes and is not read."""
    names = {f"{i}-{batches}" for i in range(batches) if i != k}
    now = log.latest(keys=_batch_of(batches) == k, skip=lambda c: c.facts.get("batch") in names)
    both = work.join(now.select("episode_uid", F.col("status").alias("_now"), "qc_verdict", "files"), "episode_uid", "left")
    ahead = F.col("action").isin("NEW", "RETRY", "RESUME") & F.coalesce(stage_rank(F.col("_now")) > stage_rank(F.col("from_stage")), F.lit(False))
    return settled(both.select("episode_uid", F.when(ahead, F.col("_now")).otherwise(F.col("from_stage")).alias("status"), "qc_verdict", "files"))


def _batch_of(batches: int) -> Column:
    return F.pmod(F.xxhash64("episode_uid"), F.lit(batches))


def _batch(log: StateLog, work: DataFrame, source: Source, run: Run, faults: Faults, k: int, batches: int) -> None:
    """One batch through all stages, each of them one commit. What a commit goes on from is in its token, so that of two
    workers in one batch, from whatever stage on, one enters each stage and the other leaves.

    Episodes are carried from stage to stage by the rows of the commits: what a stage has to do is what the commit before
    brought there and what was there when the batch began, without a look at the log or at a stage's rows again."""
    name = f"{k}-{batches}"
    base = _base(log, name)
    begun = _still(log, work, k, batches)
    entered: dict[str, DataFrame] = {}

    def todo(stage: str) -> DataFrame:
        """Episodes one step before it; one that a stage said nothing of stays where it is."""
        at = F.col("status") == STAGES[STAGES.index(stage) - 1]
        last = entered.get(STAGES[STAGES.index(stage) - 1])
        here = begun.filter(at)
        return here if last is None else here.unionByName(last.filter(at).select(*begun.columns))

    def given(stage: str) -> DataFrame:
        return todo(stage).select("episode_uid", "status")

    def commit(stage: str, rows: DataFrame, counter: str) -> bool:
        """Enters rows (episode_uid, error, qc_verdict, files) of a stage and counts them; not if another worker was first."""
        nonlocal base
        token = f"{name}:{base}:{stage}"
        if log.used(token):
            return False
        bad = F.col("error").isNotNull()
        rows = rows.select(
            "episode_uid", F.when(bad, "FAILED").otherwise(stage).alias("status"), F.when(bad, PENDING).otherwise(F.col("qc_verdict")).alias("qc_verdict"), F.col("error").alias("last_error"),
            F.lit(run.run_id).alias("last_update_run"), F.current_timestamp().alias("updated_at"), "files",
        )
        part = log.put(rows)
        n = {r[0]: r[1] for r in log.part(part).groupBy("status").count().collect()}
        if not n:
            log.drop(part)
            return True
        done = log.enter(part, token, run=run.run_id, stage=stage, batch=name)
        if done is None:
            return False
        base, entered[stage] = done.number, log.part(part)
        if "FAILED" in n:
            run.lost(entered[stage].filter("status = 'FAILED'").select("episode_uid", F.col("last_error").alias("error")))
        run.count(counter, n.get(stage, 0))
        return True

    def said(stage: str, done: list[DataFrame], raised: list[DataFrame], *columns: str) -> DataFrame:
        """What a stage said of its episodes, beside their files."""
        nothing = [F.lit(None).cast("string").alias(c) for c in columns]
        rows = reduce(DataFrame.unionByName, [told(r, *columns) for r in done] + [r.select("*", *nothing) for r in raised])
        return rows.join(todo(stage).select("episode_uid", "files"), "episode_uid")

    open_ = F.lit(PENDING).alias("qc_verdict")

    faults.reach("fetch.before")
    if todo("FETCHED").take(1):
        with run.timed("fetch"):
            done, raised = tried(given("FETCHED"), source.fetch)
        faults.reach("fetch.after")
        if not commit("FETCHED", said("FETCHED", done, raised).withColumn("qc_verdict", open_), "fetched"):
            return
    faults.reach("normalize.before")
    if todo("NORMALIZED").take(1):
        with run.timed("normalize"):
            done, raised = tried(given("NORMALIZED"), source.normalize)
            if done:
                source.write(reduce(DataFrame.unionByName, [split_errors(r)[0] for r in done]))
        faults.reach("normalize.after_write_before_commit")
        rows = said("NORMALIZED", done, raised).withColumn("qc_verdict", open_)
        if source.files is not None:
            rows = settled(rows.drop("files"))
            rows = rows.join(source.files(rows.filter("error IS NULL").select("episode_uid")), "episode_uid", "left")
        if not commit("NORMALIZED", rows, "normalized"):
            return
    faults.reach("qc.before")
    if todo("QC_DONE").take(1):
        with run.timed("qc"):
            done, raised = tried(given("QC_DONE"), source.judge)
        faults.reach("qc.mid_rule")
        if not commit("QC_DONE", said("QC_DONE", done, raised, "qc_verdict"), "qc_done"):
            return
    faults.reach("qc.after_episode_n")
    if todo("COMMITTED").take(1):
        with run.timed("commit"):
            faults.reach("commit.after_file_before_db")
            commit("COMMITTED", todo("COMMITTED").withColumn("error", F.lit(None).cast("string")), "committed")
