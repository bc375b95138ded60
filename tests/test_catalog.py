"""Every query against its SQL on the smallest tables, and sampling, sources and ingestion by hand."""

import math
import os
import subprocess
import sys

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinelake.operators import history as H
from kinelake.operators import sampler as G
from kinelake.plans import catalog
from kinelake.sources import segments, store, tfrecord
from kinelake.sources import vector_parquet as P
from tests import shards

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings conversations".split():
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return c


def rows(df):
    cell = lambda x: "~" if x is None or x is pd.NA or x != x else f"{x:.9g}" if isinstance(x, int | float | np.number) and not isinstance(x, bool | np.bool_) else str(x)
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_query_equals_its_sql(spark, con, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), con.execute(catalog.oracles()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def candidates(spark, made):
    return spark.createDataFrame([(f"{e}{k:03d}", e, "s", None, "PASS", n) for e, count, n in made for k in range(count)], "episode_uid string, embodiment string, source_id string, task string, qc_verdict string, n_frames long")


def test_balanced_plan_by_hand(spark):
    made = [("a", 4, 100), ("b", 5, 400), ("mid", 20, 500), ("z", 40, 1000)]
    c = candidates(spark, made)
    w = {r["embodiment"]: r["weight"] for r in G.sqrt_weights(c).collect()}
    clamped = G.clamp(w)
    assert [int(clamped[k] * 10_000 + 1e-9) for k in ("a", "b", "mid", "z")] == [728, 1628, 3642, 4000]
    entries, groups = G.plan_balanced(c, 10_000, seed=7)
    taken = {r["embodiment"]: r["frames_selected"] for r in groups.collect()}
    assert taken == {"a": 400, "b": 1600, "mid": 4000, "z": 4000}
    chosen = entries.orderBy("pos").collect()
    assert [r["pos"] for r in chosen] == list(range(len(chosen))) and sum(r["n_frames"] for r in chosen) <= 10_000
    assert [tuple(r) for r in G.plan_balanced(c, 10_000, seed=7)[0].orderBy("pos").collect()] == [tuple(r) for r in chosen]
    with pytest.raises(G.BudgetTooSmall):
        G.plan_balanced(c, 99)


def plain_plan(rows, budget, seed):
    """The balanced plan one episode at a time: (chosen uids by embodiment in order, quotas)."""
    import hashlib

    names = sorted({r["embodiment"] for r in rows})
    frames = {g: sum(r["n_frames"] for r in rows if r["embodiment"] == g) for g in names}
    roots = {g: math.sqrt(frames[g]) for g in names}
    w = G.clamp({g: roots[g] / sum(roots.values()) for g in names})
    queue = {}
    for g in names:
        buckets = {}
        for r in sorted((r for r in rows if r["embodiment"] == g), key=lambda r: (hashlib.blake2b(f"{seed}:{r['episode_uid']}".encode(), digest_size=16).hexdigest(), r["episode_uid"])):
            buckets.setdefault((r["qc_verdict"] != "PASS", r["source_id"], r["task"] or ""), []).append(r)
        queue[g] = [r for _, r in sorted((((t, k, s, a), r) for (t, s, a), b in buckets.items() for k, r in enumerate(b)), key=lambda x: x[0])]
    quota, used, chosen, free = {g: int(w[g] * budget) for g in names}, dict.fromkeys(names, 0), {g: [] for g in names}, budget

    def serve(g):
        nonlocal free
        got = False
        for r in list(queue[g]):
            if r["n_frames"] <= min(quota[g] - used[g], free):
                used[g] += r["n_frames"]
                free -= r["n_frames"]
                chosen[g].append(r["episode_uid"])
                queue[g].remove(r)
                got = True
        return got

    for g in names:
        serve(g)
    while able := sorted((g for g in names if any(r["n_frames"] <= free for r in queue[g])), key=lambda g: (-w[g], g)):
        rest, some = free, False
        for g in able:
            quota[g] += int(rest * w[g] / sum(w[x] for x in able))
            some |= serve(g)
        if not some:
            for g in able:
                quota[g] = budget
                serve(g)
            break
    return chosen, quota


@pytest.mark.parametrize(("seed", "budget", "chunk"), [(1, 900, 4), (2, 2500, 7), (3, 333, 3), (4, 5000, 1 << 16)])
def test_balanced_plan_equals_one_episode_at_a_time(spark, seed, budget, chunk):
    import random

    rnd = random.Random(seed)
    rows = [{"episode_uid": f"e{k:03d}", "embodiment": rnd.choice("aaabbcd"), "source_id": rnd.choice("st"), "task": rnd.choice(["x", "y", None]), "qc_verdict": rnd.choice(["PASS", "PASS", "REVIEW"]), "n_frames": int(rnd.paretovariate(1.1) * 8) + 5} for k in range(130)]
    c = spark.createDataFrame([tuple(r.values()) for r in rows], "episode_uid string, embodiment string, source_id string, task string, qc_verdict string, n_frames long")
    chosen, quota = plain_plan(rows, budget, seed)
    entries, groups = G.plan_balanced(c, budget, seed=seed, chunk=chunk)
    assert [(r["embodiment"], r["episode_uid"]) for r in entries.orderBy("pos").collect()] == [(g, u) for g in sorted(chosen) for u in chosen[g]]
    size = {r["episode_uid"]: r["n_frames"] for r in rows}
    assert {r["embodiment"]: (r["quota"], r["n_selected"], r["frames_selected"]) for r in groups.collect()} == {g: (quota[g], len(chosen[g]), sum(size[u] for u in chosen[g])) for g in chosen}
    used, want = 0, []
    for r in rows:
        if used + r["n_frames"] <= budget:
            used += r["n_frames"]
            want.append(r["episode_uid"])
    assert [r["episode_uid"] for r in G.plan_sequential(c, budget, chunk).orderBy("pos").collect()] == want


def test_clamp_floor_and_single_group():
    out = G.clamp({"a": 0.001, "b": 0.333, "c": 0.333, "d": 0.333})
    assert out["a"] == 0.05 and math.isclose(out["b"], 0.95 / 3) and math.isclose(sum(out.values()), 1)
    assert G.clamp({"a": 1.0}) == {"a": 1.0} and G.clamp({}) == {}


def test_sequential_takes_what_still_fits(spark):
    c = spark.createDataFrame([("a", 60), ("b", 50), ("c", 40), ("d", 1)], "episode_uid string, n_frames long")
    assert [r["episode_uid"] for r in G.plan_sequential(c, 100).orderBy("pos").collect()] == ["a", "c"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_plans_over_all_candidates_equal_a_fold(spark, con):
    import hashlib
    from itertools import groupby

    from kinelake.plans import q_catalog

    c = con.execute(f"{q_catalog.CAND} SELECT uid, n_frames, embodiment, source_id, qc_verdict, coalesce(task, '') AS task FROM e").df().to_dict("records")

    def fold(rows, limit):
        used, out = 0, []
        for r in rows:
            if used + r["n_frames"] <= limit:
                used += r["n_frames"]
                out.append(r)
        return out

    pack = fold(sorted(c, key=lambda r: r["uid"]), 400)
    assert {r["source_id"] for r in pack} == {"s0", "s1", "s2"} and len({r["embodiment"] for r in pack}) > 1
    run = lambda name: sorted(map(tuple, catalog.queries()[name](spark, SF).collect()))
    assert run("q_sequential_pack") == [(k, r["uid"], r["n_frames"]) for k, r in enumerate(pack)]
    found = catalog.queries()["q_export_manifest"](spark, SF).orderBy("pos").collect()
    assert [tuple(r) for r in found] == [(k, r["uid"], {"s0": "mit", "s1": "cc-by"}.get(r["source_id"]), r["n_frames"]) for k, r in enumerate(pack)]
    groups = {e: [r for r in c if r["embodiment"] == e] for e in {r["embodiment"] for r in c}}
    root = {e: math.sqrt(sum(r["n_frames"] for r in g)) for e, g in groups.items()}
    expect = []
    for e, g in groups.items():
        bucket = lambda r: (r["qc_verdict"] != "PASS", r["source_id"], r["task"])
        key = lambda r: (hashlib.sha256(f"7:{r['uid']}".encode()).hexdigest(), r["uid"])
        turns = [((t, k, s, a), r) for (t, s, a), b in groupby(sorted(g, key=lambda r: (bucket(r), key(r))), bucket) for k, r in enumerate(b)]
        order = [r for _, r in sorted(turns, key=lambda x: x[0])]
        expect += [(e, k, r["uid"]) for k, r in enumerate(fold(order, int(root[e] / sum(root.values()) * 1500)))]
    assert run("q_first_fill") == sorted(expect)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_intervals_and_frames_cover_every_event(spark, con):
    e = con.execute("SELECT event_id, user_id % 5, (epoch_us(ts) - 1704067200000000) // 1000 FROM events").fetchall()
    # ends are seconds as doubles, in which a start can be rounded to behind its own sample
    expect = {str(i): sum(w == v and a / 1000 * 1000 <= ms <= (a / 1000 + 3600) * 1000 for _, w, ms in e) for i, v, a in e}
    got = {r["episode_uid"]: r["n"] for r in catalog.queries()["q_interval_join"](spark, SF).collect()}
    assert got == {k: n for k, n in expect.items() if n} and len(got) > 900
    assert {r["episode_uid"] for r in catalog.queries()["q_frame_ranges"](spark, SF).collect()} == set(expect)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_roll_up_reads_every_rule(spark):
    from kinelake.operators import rules as R
    from kinelake.plans import surrogate

    t = surrogate.event_tables(spark, SF)
    by = {r[0]: {} for r in t.episodes.select("episode_uid").collect()}
    for rule in R.RULES:
        for r in R.evaluate(t, rule).select("episode_uid", "verdict").collect():
            by[r[0]][rule.rule_id] = r[1]
    assert {k for v in by.values() for k in v} == {r.rule_id for r in R.RULES} and len(R.RULES) == 11
    worst = lambda v: "FAIL" if "FAIL" in v else "REVIEW" if {"REVIEW", "ERROR"} & v else "PASS"
    expect = {k: worst(set(v.values())) for k, v in by.items()}
    assert dict(map(tuple, catalog.queries()["q_rollup"](spark, SF).collect())) == expect


def test_work_list_leaves_fresh_ones_out(spark):
    cat = spark.createDataFrame([("f", "COMMITTED", "h", "1.1", "a@2", "2.1"), ("q", "COMMITTED", "h", "1.1", "a@2", "2.0"), ("x", "FAILED", None, None, None, None), ("r", "FETCHED", None, None, None, None)], "episode_uid string, status string, content_hash string, schema_version string, adapter_version string, ruleset_version string")
    found = spark.createDataFrame([(k,) for k in "fqxrn"], "episode_uid string")
    got = {r[0]: (r[1], r[2]) for r in H.work_list(found, cat, "1.1", F.lit("a@2"), "2.1").collect()}
    assert got == {"q": ("REDO_QC", "NORMALIZED"), "x": ("RETRY", "DISCOVERED"), "r": ("RESUME", "FETCHED"), "n": ("NEW", "DISCOVERED")}


def test_tfrecord_shards_both_ways(spark, tmp_path):
    steps = {"steps/is_last": [0, 0, 1, 1], "steps/action/world_vector": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 0.0, 0.0, 0.0], "steps/text": [b"go"] * 4, "big": [2**64 - 1]}
    path = str(tmp_path / "x.tfrecord-00000")
    shards.write(path, [steps, steps])
    with open(path, "ab") as f:
        f.write(b"\x10\x00\x00")  # a record that was cut off
    spark.dataSource.register(tfrecord.TFRecordSource)
    for df in (tfrecord.read(spark, str(tmp_path)), spark.read.format("tfrecord").option("path", str(tmp_path)).load()):
        n = tfrecord.step_count()
        poses = tfrecord.reshaped(tfrecord.numbers("steps/action/world_vector"), n)
        got = df.select("record", n.alias("n"), tfrecord.kept_steps(tfrecord.numbers("steps/is_last"), poses).alias("kept"), F.get(poses, F.lit(1)).alias("p1"), tfrecord.instruction(F.element_at("features", "steps/text")["bytes"]).cast("string").alias("task"), F.element_at("features", "big")["ints"][0].cast("string").alias("big")).orderBy("record").collect()
        assert [tuple(r) for r in got] == [(k, 4, 3, [4.0, 5.0, 6.0], "go", str(2**64 - 1)) for k in (0, 1)]


def test_vector_dataset_end_to_end(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/meta")
    with open(f"{root}/meta/info.json", "w") as f:
        f.write('{"total_episodes": 2, "fps": 10, "features": {"cam_wrist": {"dtype": "video", "shape": [4, 5, 3]}}}')
    spark.createDataFrame([(0, 0, 3, 3, ["t"]), (1, 3, 5, 2, ["t"])], "episode_index long, dataset_from_index long, dataset_to_index long, length long, tasks array<string>").write.parquet(f"{root}/meta/episodes/chunk-000")
    data = [(k, int(k >= 3), k if k < 3 else k - 3, [float(k), float("nan")], [1.0, 2.0], k == 4) for k in range(5)]
    d = spark.createDataFrame(data, "index long, episode_index long, frame_index long, action array<float>, `observation.state` array<float>, `next.success` boolean").withColumn("timestamp", (F.col("frame_index") / F.lit(10.0)).cast("float"))
    e = P.discover(spark, root, "src")
    f = P.slice_frames(d, e)
    assert P.check_lengths(f, e).count() == 0 and P.check_lengths(P.slice_frames(d.drop("episode_index"), e), e).count() == 0
    channels = spark.createDataFrame([("x", s, p, c) for s in ("action", "state") for p, c in enumerate("ab")], "embodiment string, signal string, pos int, channel string")
    assert P.check_widths(f, channels, "x").count() == 0
    got = P.unpack(f, channels, "x")
    assert got.count() == 20 and got.filter("value IS NULL").count() == 5
    assert {r[0]: r[1] for r in P.timestamp_source(f, 10).collect()} == {"src:0": "synthesized@10Hz", "src:1": "synthesized@10Hz"}
    assert {r["episode_uid"]: r["success"] for r in P.boundary(f).collect()} == {"src:0": False, "src:1": True}
    assert P.raw_frames(f).first()["raw"].keys() == {"next.success"}
    assert P.cameras(P.info(spark, root))[0]["mount"] == "wrist"
    store.write(got.withColumn("source_id", F.lit("src")), f"{root}/store")
    store.write(got.withColumn("source_id", F.lit("src")), f"{root}/store")
    assert store.read(spark, f"{root}/store", "src").count() == 20


def test_pose_join_counts_from_one(spark, tmp_path):
    os.makedirs(tmp_path / "pose")
    with open(tmp_path / "pose" / "V1.json", "w") as f:
        f.write('{"images": {"frame_0000000001.jpg": [1,2,3,4,5,6,7]}}')
    frames = spark.createDataFrame([("V1", 0), ("V1", 1)], "video_id string, frame_no int")
    got = {r["frame_no"]: r["pose"] for r in segments.with_pose(frames, segments.pose_table(spark, str(tmp_path / "pose"))).collect()}
    assert got[0] == [1, 2, 3, 4, 5, 6, 7] and got[1] is None


def test_ingest_takes_each_file_once(spark, tmp_path):
    from kinelake.streaming.ingest import ingest

    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "episode_uid string, n int")
    df.write.parquet(src)
    for _ in range(2):
        ingest(spark, src, df.schema, out, ck, lambda b: b)
    assert spark.read.parquet(out).count() == 2
    df.write.mode("append").parquet(src)
    ingest(spark, src, df.schema, out, ck, lambda b: b)
    assert spark.read.parquet(out).count() == 4


def test_entry_imports_without_the_subpackage(tmp_path):
    import shutil

    shutil.copytree(os.path.join(ROOT, "kinelake"), tmp_path / "kinelake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'q_rollup' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events_of(spark, tmp_path, rows, *names):
    """Rows of named queries, and of their SQL, over a table of events (event_id, seconds, user_id, event_type, value)."""
    from datetime import datetime, timedelta

    made = [(e, datetime(2024, 1, 1) + timedelta(seconds=s), u, kind, v, "{}") for e, s, u, kind, v in rows]
    spark.createDataFrame(made, EVENTS).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    return [(rows_of, c.execute(catalog.oracles()[n]).df()) for n in names for rows_of in [catalog.queries()[n](spark, str(tmp_path)).toPandas()]]


def test_overlap_of_empty_intervals_is_as_in_sql(spark, tmp_path):
    """Before, a value of 0 ended the query with a division by zero."""
    made = [(0, 0, 1, "view", 0.0), (1, 0, 1, "view", 0.0), (2, 9, 1, "view", 5.0), (3, 10, 1, "view", 0.0), (4, 99999, 1, "view", 1.0), (5, 7, 2, "view", 2.0), (6, 8, 2, "view", 3.0), (7, 9, 2, "view", None)]
    ((got, want),) = events_of(spark, tmp_path, made, "q_segment_overlap_sym")
    assert rows(got) == rows(want)


def test_long_and_many_segments_are_not_laid_out(spark, tmp_path):
    """Before, users of large numbers had as many rows as their segments have frames, and events of one hour met in pairs:
    4e9 frames, 4e6 pairs."""
    far = [(k, k * 40_000, 100_000_000 + k, "error" if k % 2 else "view", float(k)) for k in range(70)]
    ((got, want),) = events_of(spark, tmp_path, far, "q_frame_ranges")
    assert rows(got) == rows(want)
    near = [(k, k % 700 * 0.5 + (k % 3) * 1800, k % 4, "view", 1.0) for k in range(4000)]
    ((got, want),) = events_of(spark, tmp_path, near, "q_interval_join")
    assert rows(got) == rows(want)


def test_facts_of_slices_equal_slices(spark):
    import random

    rnd = random.Random(3)
    samples = spark.createDataFrame([(rnd.choice("ab"), rnd.randrange(50_000)) for _ in range(300)] + [(None, 5), ("a", None)], "video_id string, ms long")
    seg = spark.createDataFrame([(f"e{k % 37}", rnd.choice("abc"), rnd.randrange(40) * 1.0, rnd.randrange(60) * 1.0) for k in range(60)] + [("n", "a", None, 1.0)], "episode_uid string, video_id string, start_s double, stop_s double")
    want = segments.slice_samples(samples, seg.filter("start_s <= stop_s")).groupBy("episode_uid").agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("last_t"), F.max("sample_idx").alias("last_idx"))
    got = segments.slice_facts(samples, seg.filter("start_s IS NULL OR start_s <= stop_s"))
    assert got.count() > 5 and rows(got.toPandas()) == rows(want.toPandas())


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lines_of_orders_are_dealt_out_once(spark):
    """Before, cells of a line were dealt out by channel and again by order, and cells of a frame after its lines."""
    for name in ("q_span_by_unit", "q_bit_equal"):
        assert exchanges(catalog.queries()[name](spark, SF)) == 1


def test_tasks_grow_with_rows_not_rows_of_a_task(spark, monkeypatch):
    """Before, the number of tasks was the session's, whatever the number of rows."""
    from kinelake.operators import order
    from kinelake.plans import surrogate

    monkeypatch.setattr(order.spread, "__kwdefaults__", {"each": 500})
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert surrogate.line_frames(spark, SF).rdd.getNumPartitions() == -(-n // 500) > 3
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    plan = catalog.queries()["q_sparse_left_join"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {-(-orders * 7 // 500)}), REPARTITION_BY_NUM") == 2


def test_rollup_reads_episodes_once_less(spark):
    """Before, results were rows that were grouped again and joined with episodes that were read a third time."""
    from kinelake.operators import rules
    from kinelake.plans import surrogate

    got, t = catalog.queries()["q_rollup"](spark, SF), surrogate.event_tables(spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # beside facts, and for the columns of end markers
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rules.roll_up(t.episodes, rules.evaluate_all(t)).collect()))
