"""The log of states, ingestion that dies at every checkpoint, files that will not open, quantiles of large groups, and
digests that carry their state."""

import hashlib
import json
import os
import random
import subprocess
import sys
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.operators import lifecycle as L
from kinelake.operators import quantiles as Q
from kinelake.operators.statelog import StateLog
from kinelake.sources import store

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "episode_uid string, status string, n int"


def table(df):
    return sorted(map(tuple, df.collect()))


def rows(spark, *r):
    return spark.createDataFrame(list(r), SMALL)


def test_latest_rows_with_and_without_snapshots(spark, tmp_path):
    log, want, rnd = StateLog(spark, str(tmp_path / "log"), SMALL, buckets=8), {}, random.Random(1)
    assert log.latest().count() == 0 and log.compact() == {"buckets": 0, "written": 0}
    for k in range(6):
        part = {f"e{rnd.randrange(40)}": ("S", k) for _ in range(15 if k != 4 else 1)}
        want |= part
        log.append(rows(spark, *[(u, *v) for u, v in part.items()]))
        assert table(log.latest()) == sorted((u, *v) for u, v in want.items())
        if k in (1, 4):
            done = log.compact()
            assert done["written"] == (1 if k == 4 and prev == 3 else done["written"])
            assert table(log.latest()) == sorted((u, *v) for u, v in want.items())
        if k == 3:
            log.compact()
            prev = 3
    assert log.compact()["written"] > 0 and log.compact()["written"] == 0
    some = max(want)
    assert table(log.lookup(episode_uid=some)) == [(some, *want[some])] and log.lookup(episode_uid="no").count() == 0
    plan = log.lookup(episode_uid="e3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert table(log.latest(F.col("n") >= 4)) == sorted((u, *v) for u, v in want.items() if v[1] >= 4)
    # what came before the snapshot is not read
    files = log.latest().inputFiles()
    assert files and all("/snapshots/" in f for f in files)


def test_a_small_change_rewrites_its_buckets(spark, tmp_path):
    log = StateLog(spark, str(tmp_path), SMALL, buckets=32)
    log.append(spark.range(2000).select(F.concat(F.lit("e"), "id").alias("episode_uid"), F.lit("A").alias("status"), F.lit(0).alias("n")))
    assert log.compact() == {"buckets": 32, "written": 32}
    log.append(rows(spark, ("e5", "B", 1), ("e6", "B", 1)))
    assert log.compact()["written"] in (1, 2)
    assert log.latest().count() == 2000 and log.latest(F.col("status") == "B").count() == 2


def test_readers_keep_the_state_that_they_listed(spark, tmp_path):
    log = StateLog(spark, str(tmp_path), SMALL)
    log.append(rows(spark, ("a", "A", 1)))
    before = log.latest()
    log.append(rows(spark, ("a", "B", 2)))
    log.compact()
    assert table(before) == [("a", "A", 1)] and table(log.latest()) == [("a", "B", 2)]
    assert table(log.rows().drop("_commit")) == [("a", "A", 1), ("a", "B", 2)]


def test_a_writer_that_died_left_nothing_and_one_token_counts_once(spark, tmp_path):
    log = StateLog(spark, str(tmp_path), SMALL)
    rows(spark, ("a", "GHOST", 0)).write.parquet(str(tmp_path / "parts" / "dead"))
    assert log.append(rows(spark, ("a", "A", 1)), token="t") and not log.append(rows(spark, ("a", "B", 2)), token="t")
    # both looked before either wrote
    log._commit({"kind": "rows", "part": "parts/dead", "token": "t"})
    assert table(StateLog(spark, str(tmp_path), SMALL).latest()) == [("a", "A", 1)]


def test_of_two_claimers_one_commits(spark, tmp_path):
    log, won = StateLog(spark, str(tmp_path), SMALL), []
    got = []
    run = lambda k: got.append(log.claim("b0", f"w{k}", 60, now=100.0))
    threads = [threading.Thread(target=run, args=(k,)) for k in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert [g for g in got if g] == [1]
    assert log.claim("b0", "late", 60, now=120.0) is None and log.claim("b0", "late", 60, now=161.0) == 2
    # the first one wakes up and both write
    threads = [threading.Thread(target=lambda k=k: won.append((k, bool(log.append(rows(spark, ("a", f"w{k}", k)), token="b0:FETCHED"))))) for k in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(w for _, w in won) == [False, True]
    assert table(log.latest()) == [("a", f"w{k}", k) for k, w in won if w]


# ---------------------------------------------------------------- a run that dies

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from tests.test_statelog import made_run
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "1").config("spark.sql.adaptive.enabled", "false").config("spark.ui.enabled", "false").config("spark.sql.codegen.wholeStage", "false").getOrCreate()
made_run(spark, {place!r}, "run_1", {fault!r})
"""


def made_run(spark, place, run_id, fault="", die=os._exit):
    """A run over four episodes in two batches; every call of a stage on an episode leaves a mark."""
    names = [f"e{k}" for k in range(4)]
    found = spark.createDataFrame([(n,) for n in names], "episode_uid string")

    def marked(kind):
        def run(rows):
            for r in rows.select("episode_uid").collect():
                with open(f"{place}/calls", "a") as f:
                    f.write(f"{kind} {r[0]}\n")
            return rows

        return run

    def normalize(rows):
        return marked("normalize")(rows).select("episode_uid", F.lit("src").alias("source_id"), F.lit(0).alias("frame_idx"), F.length("episode_uid").alias("value"))

    data = f"{place}/data"

    def write(rows):
        for r in rows.collect():  # a file each, so that one can be damaged
            spark.createDataFrame([r], rows.schema).coalesce(1).write.mode("overwrite").parquet(f"{data}/{r['episode_uid']}")

    def files(episodes):
        return store.files_of(spark, f"{data}/*", episodes)

    source = L.Source(lambda: found, marked("fetch"), normalize, lambda e: marked("qc")(e).select("episode_uid", F.lit("PASS").alias("qc_verdict")), write, files)
    log, runs, run = L.episode_log(spark, place, 4), L.run_log(spark, place), L.Run(run_id)
    resumed = L.begin(runs, run)
    L.sweep(spark, f"file://{place}")
    demoted = [r[0] for r in L.demote_unreadable(log, run).collect()]
    L.ingest(log, L.due(found, log), source, run, L.Faults(fault, die), n_discovered=4, batches=2)
    L.finish(runs, run)
    return log, runs, run, resumed, demoted


class Killed(BaseException):
    """Passes through whatever catches what a source does wrong."""


def killed(code):
    raise Killed


def calls(place):
    out = {}
    for line in open(f"{place}/calls"):
        kind, uid = line.split()
        out.setdefault(kind, []).append(uid)
    return {k: sorted(v) for k, v in out.items()}


def states(log):
    return table(log.latest().select("episode_uid", "status", "qc_verdict", "last_error"))


@pytest.fixture
def tiny(spark):
    """Tables of a few rows: one partition, and plans as they are."""
    changed = {"spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_run_killed_at_any_checkpoint_goes_on(tiny, tmp_path):
    spark = tiny
    os.makedirs(tmp_path / "whole")
    log, *_ = made_run(spark, str(tmp_path / "whole"), "run_1")
    whole, once = states(log), calls(tmp_path / "whole")
    assert whole == [(f"e{k}", "COMMITTED", "PASS", None) for k in range(4)] and {k: len(v) for k, v in once.items()} == {"fetch": 4, "normalize": 4, "qc": 4}
    redone = {"fetch.after": "fetch", "normalize.after_write_before_commit": "normalize", "qc.mid_rule": "qc"}
    for point in L.CHECKPOINTS:
        place = str(tmp_path / point)
        os.makedirs(place)
        if point in ("normalize.after_write_before_commit", "commit.after_file_before_db"):  # a process that is gone
            code = SCRIPT.format(root=ROOT, place=place, fault=f"{point}:2")  # in the second batch
            assert subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=300).returncode == 1, point
        else:
            with pytest.raises(Killed):
                made_run(spark, place, "run_1", f"{point}:2", killed)
        before = calls(place)
        log, runs, run, resumed, demoted = made_run(spark, place, "run_2")
        assert states(log) == whole and resumed == "run_1" and demoted == [], point
        after, first = calls(place), set(before["fetch"])
        extra = {k: len(after[k]) - 4 for k in after}
        mine = redone.get(point)
        assert {k for k, n in extra.items() if n} == ({mine} if mine else set()), (point, extra)
        assert first and all(n < 4 for n in extra.values())
        told = {r["run_id"]: (r["status"], r["resumed_from"]) for r in runs.latest().collect()}
        assert told == {"run_1": ("INTERRUPTED", None), "run_2": ("COMPLETED", "run_1")}
        assert not [f for _, _, names in os.walk(place) for f in names if f.endswith(".tmp")]


def test_two_workers_in_one_batch_enter_each_stage_once(tiny, tmp_path):
    """A worker whose lease has lapsed goes on beside the one that took its batch over, from different stages."""
    spark, place = tiny, str(tmp_path)
    found = spark.createDataFrame([("a",), ("b",)], "episode_uid string")
    verdict = lambda v: L.Source(None, lambda e: e, lambda e: e, lambda e: e.select("episode_uid", F.lit(v).alias("qc_verdict")), lambda rows: None)
    for point in ("fetch.after", "normalize.before", "qc.mid_rule"):
        log = L.episode_log(spark, f"{place}/{point}", 2)
        other = L.Run("other")

        def overtake(code, log=log, other=other):
            L.ingest(log, L.due(found, log), verdict("REVIEW"), other, owner="other", ttl_seconds=60)

        mine = L.Run("mine")
        L.ingest(log, L.due(found, log), verdict("PASS"), mine, L.Faults(point, overtake), owner="mine", ttl_seconds=-1)
        stages = [c.facts["stage"] for c in log.commits()]
        assert stages == ["FETCHED", "NORMALIZED", "QC_DONE", "COMMITTED"], (point, stages)
        assert {r[1:3] for r in states(log)} == {("COMMITTED", "REVIEW")}
        assert mine.counters["committed"] == 0 and other.counters["committed"] == 2
        assert log.claim("0-1", "third", 60) is not None  # the batch is free again


def test_a_batch_settles_each_stage_once_and_leaves_other_batches_unread(tiny, tmp_path, monkeypatch):
    spark, made, read = tiny, [], []
    real = L.settled
    monkeypatch.setattr(L, "settled", lambda df: (made.append(1), real(df))[1])
    log = L.episode_log(spark, str(tmp_path), 2)
    parts = log._parts
    log._parts = lambda commits: (read.append({c.facts.get("batch") for c in commits}), parts(commits))[1]
    found = spark.createDataFrame([(f"e{k}",) for k in range(8)], "episode_uid string")
    fetch = lambda e: e.withColumn("error", F.when(F.col("episode_uid") == "e3", F.lit("KeyError: e3")))
    source = L.Source(None, fetch, lambda e: e.filter("episode_uid <> 'e5'"), lambda e: e.select("episode_uid", F.lit("PASS").alias("qc_verdict")), lambda rows: None)
    run = L.Run("r1")
    out = L.ingest(log, L.due(found, log), source, run, batches=2)
    # the work-list, and of both batches where they begin and what the three stages said
    assert len(made) == 1 + 2 * 4
    # before the states at the end nobody reads more than the batch at hand
    assert all(len(batches) <= 1 for batches in read[:-1]) and read[-1] == {"0-2", "1-2"} and len(read) == 4
    got = {r["episode_uid"]: (r["status"], r["qc_verdict"]) for r in out.collect()}
    assert got.pop("e3") == ("FAILED", "PENDING") and got.pop("e5") == ("FETCHED", "PENDING") and set(got.values()) == {("COMMITTED", "PASS")} and len(got) == 6
    assert {k: v for k, v in run.counters.items() if v} == {"discovered": 8, "fetched": 7, "normalized": 6, "qc_done": 6, "committed": 6, "failed": 1}


def test_a_resumed_episode_keeps_its_files_and_verdict_beside_new_ones(tiny, tmp_path):
    spark = tiny
    log = L.episode_log(spark, str(tmp_path), 2)
    log.append(spark.createDataFrame([("a", "NORMALIZED", "PENDING", ["f1"]), ("b", "QC_DONE", "REVIEW", ["f2"])], "episode_uid string, status string, qc_verdict string, files array<string>").withColumns({"last_error": F.lit(None), "last_update_run": F.lit("r0"), "updated_at": F.current_timestamp()}))
    found = spark.createDataFrame([("a",), ("b",), ("c",)], "episode_uid string")
    source = L.Source(None, lambda e: e, lambda e: e, lambda e: e.select("episode_uid", F.lit("PASS").alias("qc_verdict")), lambda rows: None, lambda e: e.select("episode_uid", F.array("episode_uid").alias("files")))
    out = L.ingest(log, L.due(found, log), source, L.Run("r1"))
    assert table(out.select("episode_uid", "status", "qc_verdict", "files")) == [("a", "COMMITTED", "PASS", ["f1"]), ("b", "COMMITTED", "REVIEW", ["f2"]), ("c", "COMMITTED", "PASS", ["c"])]


def test_a_file_that_will_not_open_sends_its_episode_back(tiny, tmp_path):
    spark = tiny
    place = str(tmp_path)
    log, *_ = made_run(spark, place, "run_1")
    broken = next(f for f in os.listdir(f"{place}/data/e3") if f.endswith(".parquet"))
    with open(f"{place}/data/e3/{broken}", "wb") as f:
        f.write(b"not parquet any more")
    gone = next(f for f in os.listdir(f"{place}/data/e1") if f.endswith(".parquet"))
    os.remove(f"{place}/data/e1/{gone}")
    log, _, run, _, demoted = made_run(spark, place, "run_2")
    assert sorted(demoted) == ["e1", "e3"] and run.counters["resumed_in_progress"] == 2 and run.counters["fetched"] == 0
    assert calls(place)["normalize"] == sorted([f"e{k}" for k in range(4)] + ["e1", "e3"])
    assert {r[1] for r in states(log)} == {"COMMITTED"}


def test_probe_reads_footers_and_says_why(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "episode_uid string, x int")
    df.coalesce(1).write.parquet(str(tmp_path / "ok"))
    good = store.files_of(spark, str(tmp_path / "ok"))
    assert {r[0]: len(r[1]) for r in good.collect()} == {"a": 1, "b": 1}
    path = good.first()["files"][0]
    whole = open(path.removeprefix("file:"), "rb").read()
    (tmp_path / "cut.parquet").write_bytes(whole[:-5])
    files = [("a", path), ("b", path), ("b", f"file://{tmp_path}/cut.parquet"), ("c", f"file://{tmp_path}/none.parquet")]
    got = {(r["episode_uid"], r["file"].rpartition("/")[2]): (r["readable"], r["error"]) for r in store.probe(spark.createDataFrame(files, "episode_uid string, file string")).collect()}
    name = path.rpartition("/")[2]
    assert got["a", name] == got["b", name] == (True, None) and got["c", "none.parquet"] == (False, "gone") and not got["b", "cut.parquet"][0]


def test_errors_as_columns_and_bounded_halving(spark, tmp_path):
    names = [f"e{k:02}" for k in range(40)]
    work = spark.createDataFrame([(n, "NEW", "DISCOVERED") for n in names], "episode_uid string, action string, from_stage string")
    bad = F.col("episode_uid").isin("e03", "e04")
    tried = []
    fetch = lambda e: e.withColumn("error", F.when(bad, F.concat(F.lit("KeyError: "), "episode_uid")))

    def normalize(e):
        tried.append(1)
        return e.withColumn("x", F.when(F.col("episode_uid") == "e07", F.raise_error(F.lit("odd width")).cast("int")).otherwise(1))

    log, run = L.episode_log(spark, str(tmp_path)), L.Run("r1")
    source = L.Source(None, fetch, normalize, lambda e: e.select("episode_uid", F.lit("PASS").alias("qc_verdict")), lambda rows: None)
    out = {r["episode_uid"]: r for r in L.ingest(log, work, source, run, n_discovered=43).collect()}
    assert {k for k, r in out.items() if r["status"] == "FAILED"} == {"e03", "e04", "e07"} and "odd width" in out["e07"]["last_error"]
    assert run.stats()["failure_reasons"]["KeyError"] == 2 and len(run.failures) == 3 and run.counters["committed"] == 37 and run.counters["skipped_already_processed"] == 3
    assert len(tried) < 24
    # everything raises: a bounded number of jobs
    tried.clear()
    rows_, failures = L.apart(work, lambda e: (tried.append(1), e.withColumn("x", F.raise_error(F.lit("down")).cast("int")))[1], jobs=9)
    assert rows_ is None and failures.count() == 40 and 9 <= len(tried) <= 16
    retry = {r[0]: r[1:] for r in L.due(work, log).collect()}
    assert retry == {k: ("RETRY", "DISCOVERED") for k in ("e03", "e04", "e07")}


# ---------------------------------------------------------------- quantiles, digests


@pytest.mark.parametrize(("bins", "few"), [(2048, 4096), (16, 3)])
def test_quantiles_equal_sorted_values(spark, bins, few):
    rnd = random.Random(bins)
    data = [("even", rnd.uniform(-5, 5)) for _ in range(301)] + [("ties", rnd.choice([1.0, 2.0, 2.0, 7.0])) for _ in range(200)] + [("one", 3.5)] + [("same", -1.0)] * 90
    data += [("far", s * 10.0 ** rnd.randint(-12, 12)) for s in (1, -1) for _ in range(60)] + [("far", 0.0), ("far", 1.7e308), ("far", -1.7e308), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    at = {"p1": 0.01, "median": 0.5, "p99": 0.99, "low": 0.0, "high": 1.0}
    got = {r["g"]: r for r in Q.quantiles(df, ["g"], "v", at, bins, few).collect()}
    assert set(got) == {"even", "ties", "one", "same", "far"}
    told = df.filter("v IS NOT NULL").groupBy("g").agg(*[F.percentile("v", F.lit(q)).alias(n) for n, q in at.items()]).collect()
    for r in told:
        for n in at:
            assert got[r["g"]][n] == r[n], (r["g"], n)


def test_digests_over_batches_equal_one_over_all(spark):
    rnd = random.Random(3)
    data = []
    for e in range(5):
        for pos, name in [(1, "b"), (0, "a"), (None, "z"), (None, "y")][: e + 1]:
            data += [(f"e{e}", pos, name, "float64", k, rnd.choice([None, rnd.random()])) for k in range(40)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "episode_uid string, pos int, column string, dtype string, frame_idx long, value double")
    want = {}
    for e in {r[0] for r in data}:
        mine = [r for r in data if r[0] == e]
        order = sorted({(r[1] is None, r[1] or 0, r[2]) for r in mine})
        d = hashlib.sha256(json.dumps({"columns": [o[2] for o in order], "dtypes": ["float64"] * len(order), "n_rows": 40}, sort_keys=True, separators=(",", ":")).encode())
        for _, _, c in order:
            d.update(np.array([np.nan if r[5] is None else r[5] for r in sorted((r for r in mine if r[2] == c), key=lambda r: r[4])], "<f8").tobytes())
        want[e] = d.hexdigest()
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("7", old):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        assert dict(map(tuple, store.content_hash(df).collect())) == want


def test_summaries_of_large_groups_equal_those_of_small_ones(spark):
    from kinelake.operators import stats

    rnd = random.Random(9)
    data = [("a", "x", rnd.gauss(0, 1)) for _ in range(300)] + [("a", "y", float(k % 3)) for k in range(40)] + [("b", "x", None), ("b", "x", float("nan")), ("b", "x", 2.0)] + [("c", "x", float("inf"))] * 60
    df = spark.createDataFrame(data, "g string, h string, value double")
    want = {(r["g"], r["h"]): r for r in stats.distributions(df, ["g", "h"]).collect()}
    for limit in (0, 50):
        got = {(r["g"], r["h"]): r for r in stats.distributions(df, ["g", "h"], in_a_task=limit).collect()}
        assert set(got) == set(want)
        for k, r in want.items():
            for name in r.__fields__:
                assert got[k][name] == (pytest.approx(r[name], rel=1e-12) if name in ("mean", "std") and r[name] is not None else r[name]), (k, name)


def test_latest_rows_by_partial_aggregates(spark):
    from pyspark.sql import Window

    from kinelake.operators import history

    rnd = random.Random(4)
    data = [(f"e{rnd.randrange(9)}", rnd.choice("RS"), rnd.choice([None, "2024", "2025"]), k if k % 7 else None, rnd.choice([None, "PASS"])) for k in range(200)]
    df = spark.createDataFrame(data, "episode_uid string, rule_id string, created_at string, seq long, verdict string").dropDuplicates(["episode_uid", "rule_id", "created_at", "seq"])
    w = Window.partitionBy("episode_uid", "rule_id").orderBy(F.desc("created_at"), F.desc("seq"))
    want = df.withColumn("k", F.row_number().over(w)).filter("k = 1").drop("k")
    got = history.latest(df)
    assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rules_over_dealt_tables_move_samples_once(spark):
    from kinelake.plans import catalog

    df = catalog.queries()["q_rule_results"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("- Exchange") <= 8


def test_shards_are_read_in_parts_by_an_index(spark, tmp_path):
    from kinelake.sources import tfrecord
    from tests import shards

    examples = [{"x": [k, 2**64 - 1], "f": [k / 2], "b": [f"r{k}".encode() * (k % 5)]} for k in range(60)]
    shards.write(str(tmp_path / "a b.tfrecord-0"), examples[:40])
    shards.write(str(tmp_path / "c.tfrecord-1"), examples[40:])
    with open(tmp_path / "c.tfrecord-1", "ab") as f:
        f.write((99).to_bytes(8, "little") + b"cut off")
    index = tfrecord.offsets(spark, str(tmp_path))
    assert index.count() == 60
    whole = {(r["path"].rpartition("/")[2], r["record"]): r["features"] for r in tfrecord.read(spark, str(tmp_path)).collect()}
    parts = tfrecord.read_at(index, split=200)
    assert {(r["path"].rpartition("/")[2], r["record"]): r["features"] for r in parts.collect()} == whole and len(whole) == 60
    dealt = tfrecord.read_at(index, split=200).withColumn("task", F.spark_partition_id()).filter("path LIKE '%tfrecord-0'").select("task").distinct().count()
    assert dealt > 1
    one = tfrecord.read_at(index.filter("record = 7 AND path LIKE '%tfrecord-1'"), wanted=["x"]).collect()
    assert len(one) == 1 and set(one[0]["features"]) == {"x"} and [int(i) for i in one[0]["features"]["x"]["ints"]] == [47, 2**64 - 1]


def test_few_large_groups_are_neither_dealt_out_nor_sorted(spark):
    """Before, rows were joined with their groups by exchange and sort, all of a group in one task."""
    from kinelake.operators import stats

    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.sqrt("id").alias("value"))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        got = stats.distributions(df, ["g"], in_a_task=0)
        plan = got._jdf.queryExecution().executedPlan().toString()
        found = {r["g"]: (r["count"], r["p1"], r["p99"]) for r in got.collect()}
    finally:
        spark.conf.set(name, before)
    assert plan.count("LeftSemi, BuildRight") and plan.count("LeftAnti, BuildRight") and not any("SortMergeJoin" in line and ("LeftSemi" in line or "LeftAnti" in line) for line in plan.splitlines())
    assert found == {r["g"]: (r["count"], r["p1"], r["p99"]) for r in stats.distributions(df, ["g"]).collect()}
