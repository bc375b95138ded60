"""Sources, the life of episodes, hashes, staging and exports, by hand."""

import hashlib
import io
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.operators import lifecycle as L
from kinelake.operators import report as P
from kinelake.operators import sampler as G
from kinelake.operators.rules import CHANNEL
from kinelake.sources import records, segments, store, tfrecord
from tests import shards

def now():
    return F.timestamp_seconds(F.lit(1000))

CATALOG = "episode_uid string, status string, qc_verdict string, last_error string, last_update_run string, updated_at timestamp"


def example(n, pad, reward=1.0, hand=b"x", text=b"go"):
    """An episode of n steps whose last `pad` ones stand still and are last."""
    flags = [int(k >= n - max(pad, 1)) for k in range(n)]
    move = [0.0 if k >= n - pad else k + 1.0 for k in range(n)]
    return {
        "steps/is_last": flags, "steps/is_terminal": flags[1:] + [1], "steps/reward": [0.0] * (n - 1) + [reward], "steps/action/world_vector": [x for m in move for x in (m, 0.0, 0.0)], "steps/action/rotation_delta": [0.0] * 3 * n,
        "steps/action/gripper_closedness_action": [0.5] * n, "steps/action/terminate_episode": [0.0] * n, "steps/observation/robot_state": [float(k) for k in range(2 * n)], "steps/observation/natural_language_instruction": [text] * n,
        "steps/observation/hand_image": [hand] * n, "steps/observation/force": [float(k) for k in range(n)], "steps/embedding": [1.0] * 5 * n,
    }


@pytest.fixture()
def shard(tmp_path):
    path = str(tmp_path / "set-train.tfrecord-00000-of-00001")
    shards.write(path, [example(6, 2), example(4, 0, text=b"stop"), example(3, 3)])
    info = {"fileFormat": "tfrecord", "name": "set", "version": "1.0", "splits": [{"name": "train", "shardLengths": ["3"]}]}
    image = {"featuresDict": {"features": {"hand_image": {"image": {"shape": {"dimensions": ["4", "5", "3"]}}}, "force": {"tensor": {}}}}}
    features = {"featuresDict": {"features": {"steps": {"sequence": {"feature": {"featuresDict": {"features": {"observation": image}}}}}}}}
    for name, what in (("dataset_info", info), ("features", features)):
        (tmp_path / f"{name}.json").write_text(json.dumps(what))
    return str(tmp_path)


def test_record_episodes_from_metadata_to_samples(spark, shard):
    info, features = records.dataset(spark, shard)
    refs = records.discover(spark, info, "ur")
    assert [tuple(r) for r in refs.orderBy("episode_uid").collect()][1] == ("ur:train#000001", "train#000001", "train", "set-train.tfrecord-00000-of-00001", 0, 1, "train:1-shards@1.0")
    with pytest.raises(ValueError, match="no split"):
        records.discover(spark, info, "ur", "test")
    whole = {r["episode_uid"]: bytes(r["record"]) for r in records.fetch(refs, shard).collect()}
    assert whole == {f"ur:train#{k:06d}": shards.payload(x) for k, x in enumerate((example(6, 2), example(4, 0, text=b"stop"), example(3, 3)))}
    with open(f"{shard}/set-train.tfrecord-00000-of-00001", "rb") as f, pytest.raises(IndexError):
        records.payload(f, 3)

    got = tfrecord.read(spark, shard).select(F.format_string("e%d", "record").alias("episode_uid"), "features")
    e = records.assembled(got)
    by = {r["episode_uid"]: r for r in e.select("episode_uid", "n_upstream", "n_frames", "action", "state", "task").collect()}
    assert [(by[k]["n_upstream"], by[k]["n_frames"], by[k]["task"]) for k in ("e0", "e1", "e2")] == [(6, 4, "go"), (4, 4, "stop"), (3, 0, "go")]
    assert by["e0"]["action"][3] == [4.0, 0, 0, 0, 0, 0, 0.5, 0] and by["e0"]["state"][1] == [2.0, 3.0] and by["e2"]["action"] == []
    channels = spark.createDataFrame([("x", s, f"c{p}", p, True, False, None, None, "unknown", "unknown", "measured", None, p) for s, n in (("action", 8), ("state", 2)) for p in range(n)], CHANNEL)
    assert records.check_widths(e, channels, "x").count() == 0
    s = records.samples(e, channels, "x", 5.0)
    assert s.count() == (4 + 4) * 10 and s.filter("episode_uid = 'e0' AND signal = 'action' AND channel = 'c0' AND frame_idx = 2").first()["t"] == 0.4
    raw = {(r["episode_uid"], r["frame_idx"]): r["raw"] for r in records.raw_frames(e, 5.0, ("steps/reward",)).collect()}
    assert len(raw) == 8 and raw["e0", 3] == {"force": 3.0, "is_last": 0.0, "is_terminal": 1.0}
    t = {r["episode_uid"]: r for r in records.trimmed(e).collect()}
    assert (t["e0"]["n_trimmed"], t["e0"]["rewards"], t["e0"]["terminal"], t["e0"]["terminal_reward"], t["e0"]["has_termination_signal"]) == (2, [0.0, 1.0], [True, True], 1.0, True)
    assert t["e1"]["n_trimmed"] == 0 and t["e1"]["rewards"] == [] and t["e2"]["has_termination_signal"] is False
    assert {r["is_truncated"] for r in records.boundary(e).collect()} == {False}
    cams = records.cameras(e, features)
    assert cams.first()["cameras"] == [("hand_image", "wrist", 4, 5, 3, "inline", True)] and records.observation_features({}) == {}
    told = {r["episode_uid"]: [x["op"] for x in r["transforms"]] for r in records.transforms(e.join(cams, "episode_uid"), ("a",)).collect()}
    assert told == {"e0": ["drop_channels", "trim_trailing_steps", "drop_inline_frames"], "e1": ["drop_channels", "drop_inline_frames"], "e2": ["drop_channels", "trim_trailing_steps", "drop_inline_frames"]}


def test_another_container_or_width_is_an_error(spark, tmp_path):
    (tmp_path / "dataset_info.json").write_text('{"fileFormat": "riegeli"}')
    (tmp_path / "features.json").write_text("{}")
    with pytest.raises(ValueError, match="riegeli"):
        records.dataset(spark, str(tmp_path))
    wide = example(4, 0) | {"steps/action/terminate_episode": [0.0] * 8}
    shards.write(str(tmp_path / "x.tfrecord-0"), [wide])
    e = records.assembled(tfrecord.read(spark, str(tmp_path)).select(F.lit("e").alias("episode_uid"), "features"))
    with pytest.raises(Exception, match="is not 1 wide"):
        e.select("action").collect()
    assert [bytes(r) for r in tfrecord.records(io.BytesIO(b"\x01" + bytes(11) + b"a"))] == []  # cut off


def test_segments_by_header_with_videos_and_sensors(spark, tmp_path):
    head = "noun,video_id,narration_id,participant_id,start_timestamp,stop_timestamp,start_frame,stop_frame,narration,verb,verb_class,noun_class,more"
    rows = [("V2", "b1", 0, 2), ("V1", "a1", 1, 3), ("V1", "a2", 2, 4), ("V2", "b2", 5, 6), ("V1", "a3", 9, 9.2), ("V3", "c1", 0, 1)]
    (tmp_path / "s.csv").write_text("\n".join([head, *(f"cup,{v},{n},P,00:00:{a:05.2f},00:00:{b:05.2f},{int(a * 50)},{int(b * 50)},take,t,1,2,z" for v, n, a, b in rows)]))
    (tmp_path / "v.csv").write_text("fps,resolution,video_id,duration\n50,1920x1080,V1,9.1\n59.94,odd,V2,100\n50,1x1,V3,1")
    seg, vid = segments.read_segments(spark, str(tmp_path / "s.csv")), segments.read_videos(spark, str(tmp_path / "v.csv"))
    assert {r["video_id"]: (r["height"], r["width"]) for r in vid.collect()}["V1"] == (1080, 1920) and vid.filter("video_id = 'V2'").first()["height"] == 0
    got = segments.discover(seg, vid, ["V1", "V2"], "k").orderBy("place").collect()
    assert [(r["episode_uid"], r["place"], r["extraction_fps"], r["first_frame"], r["last_frame"]) for r in got] == [("k:a1", 0, 50.0, 50, 150), ("k:b1", 1, 60.0, 0, 120), ("k:a2", 2, 50.0, 100, 200), ("k:b2", 3, 60.0, 300, 360)]
    assert (got[2]["prev_end_s"], got[2]["next_start_s"], got[2]["duration"]) == (3.0, 9.0, 9.1)
    for wanted in ([], ["V9"]):
        with pytest.raises(ValueError):
            segments.discover(seg, vid, wanted, "k")
    d = segments.duration_facts(seg, vid).filter("video_id = 'V1'").first()
    assert tuple(d) == ("V1", 3, 1, 1, 1, 0)
    assert {r["rate"]: r["reproduced"] for r in segments.rate_search(seg.filter("video_id = 'V1'"), vid).collect()}["official"] == 1
    os.makedirs(tmp_path / "i" / "P")
    (tmp_path / "i" / "P" / "V1-gyro.csv").write_text("GyroZ,Milliseconds,GyroX,GyroY\n3,0,1,2\n6,10,4,5")
    imu = segments.read_inertial(spark, str(tmp_path / "i"))
    assert [tuple(r) for r in imu.orderBy("ms").collect()] == [("V1", "gyro", 0.0, 1.0, 2.0, 3.0), ("V1", "gyro", 10.0, 4.0, 5.0, 6.0)]
    assert segments.inertial_facts(imu).first()["unit"] == "rad/s"
    poses = spark.createDataFrame([("V1", f"frame_{k:010d}.jpg") for k in (1, 2, 5)], "video_id string, frame_key string")
    assert tuple(segments.pose_coverage(poses, vid).first()) == ("V1", 3, 3 / 455, 1, 2.0, 3)


def test_content_hash_is_of_float64_bytes(spark):
    rows = [("e", 0, "t", "float64", k, k / 10) for k in range(3)] + [("e", None, "raw.z", "float64", k, None if k == 1 else 1.0) for k in range(3)] + [("e", 1, "action.a", "float64", k, -k * 1.0) for k in range(3)]
    df = spark.createDataFrame(rows[::-1], "episode_uid string, pos int, column string, dtype string, frame_idx int, value double")
    head = json.dumps({"columns": ["t", "action.a", "raw.z"], "dtypes": ["float64"] * 3, "n_rows": 3}, sort_keys=True, separators=(",", ":"))
    body = b"".join(np.array(v, "<f8").tobytes() for v in ([0, 0.1, 0.2], [0.0, -1, -2], [1, np.nan, 1]))
    want = hashlib.sha256(head.encode() + body).hexdigest()
    got = df.withColumn("value", F.when((F.col("column") == "action.a") & (F.col("frame_idx") == 0), 0.0).otherwise(F.col("value")))
    assert store.content_hash(got).first()["content_hash"] == want


def test_streams_that_an_episode_no_longer_has_go(spark, tmp_path):
    path, schema = str(tmp_path / "streams"), "source_id string, episode_uid string, stream_id string, sample_idx int, t double"
    e = lambda *u: spark.createDataFrame([("s", x) for x in u], "source_id string, episode_uid string")
    store.write_streams(spark.createDataFrame([("s", "a", "gyro", 0, 0.0), ("s", "a", "accel", 0, 0.0), ("s", "b", "gyro", 0, 0.0)], schema), path, e("a", "b"))
    store.write_streams(spark.createDataFrame([("s", "a", "gyro", 0, 1.0)], schema), path, e("a"))
    assert sorted((r["episode_uid"], r["stream_id"], r["t"]) for r in spark.read.parquet(path).collect()) == [("a", "gyro", 1.0), ("b", "gyro", 0.0)]


def test_staged_files_are_of_a_version(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert not store.is_staged(spark, path, "a@1")
    store.stage(spark, path, "a@1", n=3)
    assert store.is_staged(spark, path, "a@1") and not store.is_staged(spark, path, "a@2")


def test_a_run_takes_the_good_ones_and_tells_of_the_others(spark, tmp_path):
    names = [f"e{k}" for k in range(9)]
    catalog = spark.createDataFrame([("old", "COMMITTED", "PASS", None, "r0", None), ("e1", "FETCHED", "PENDING", None, "r0", None)], CATALOG)
    work = spark.createDataFrame([(n, "RESUME" if n == "e1" else "NEW", "FETCHED" if n == "e1" else "DISCOVERED") for n in names], "episode_uid string, action string, from_stage string")
    written = []
    bad = lambda df, which, what: df.withColumn("x", F.when(F.col("episode_uid") == which, F.raise_error(F.lit(what)).cast("int")).otherwise(1))
    source = L.Source(None, lambda e: bad(e, "e7", "gone"), lambda e: bad(e, "e3", "odd width"), lambda e: e.select("episode_uid", F.lit("PASS").alias("qc_verdict")), lambda rows: written.append({r[0] for r in rows.select("episode_uid").collect()}))
    run = L.Run("r1")
    log = L.episode_log(spark, str(tmp_path))
    log.append(catalog.withColumn("files", F.lit(None).cast("array<string>")))
    out = {r["episode_uid"]: r for r in L.ingest(log, work, source, run, n_discovered=12).collect()}
    assert {k for k, r in out.items() if r["status"] == "FAILED"} == {"e3", "e7"} and out["old"]["last_update_run"] == "r0"
    assert all(out[n]["status"] == "COMMITTED" and out[n]["qc_verdict"] == "PASS" for n in names if n not in ("e3", "e7"))
    assert "odd width" in out["e3"]["last_error"] and written == [set(names) - {"e3", "e7"}]
    stats = run.stats()
    assert {k: v for k, v in stats["counters"].items() if v} == {"discovered": 8, "skipped_already_processed": 3, "resumed_in_progress": 1, "fetched": 7, "normalized": 7, "qc_done": 7, "committed": 7, "failed": 2}
    assert stats["stage_calls"] == dict.fromkeys(("fetch", "normalize", "qc", "commit"), 1) and len(stats["failures"]) == 2 and all(v >= 0 for v in stats["stage_seconds"].values())
    n = log.latest().count()
    assert L.ingest(log, work.limit(0), source, L.Run("r2")).count() == n


def test_faults_end_a_run_at_the_nth_time():
    ended = []
    f = L.Faults("qc.before:2", ended.append)
    for point in ("qc.before", "fetch.after", "qc.before", "qc.before"):
        f.reach(point)
    assert ended == [1]
    L.Faults("").reach("qc.before")
    with pytest.raises(ValueError):
        L.Faults("nowhere")


def test_changes_of_stage_and_leases(spark):
    e = spark.createDataFrame([("a", "FETCHED", "PASS", "x", "r0", None)], CATALOG)
    assert L.advanced(e, "NORMALIZED", "r1", now()).first()["status"] == "NORMALIZED"
    with pytest.raises(Exception, match="no step from FETCHED to COMMITTED"):
        L.advanced(e, "COMMITTED", "r1", now()).collect()
    assert L.requeued(e, "DISCOVERED", "why", "r1", now()).first()["qc_verdict"] == "PENDING"
    with pytest.raises(ValueError):
        L.requeued(e, "DISCOVERED", "", "r1", now())
    assert tuple(L.failed(e, F.lit("KeyError: k"), "r1", now()).first())[1:4] == ("FAILED", "PASS", "KeyError: k")
    taken = L.leased(e, spark.createDataFrame([("a", 3)], "episode_uid string, attempt int"), "w", now(), 60)
    assert taken.first()["attempt"] == 4 and L.expired(taken, now(), "other").count() == 0 and L.expired(taken, now(), "w").count() == 1
    assert L.expired(L.released(taken, now()), now(), "w").count() == 0


def test_a_restart_mends_what_the_last_run_left(spark, tmp_path):
    runs = spark.createDataFrame([("r1", "t1", 1, "t2", "COMPLETED"), ("r2", "t3", 2, None, "RUNNING"), ("r3", "t4", 3, None, "RUNNING")], "run_id string, started_at string, seq int, finished_at string, status string")
    e = spark.createDataFrame([("a", "NORMALIZED", "PASS", None, "r3", None), ("b", "QC_DONE", "PASS", None, "r3", None), ("c", "COMMITTED", "PASS", None, "r3", None)], CATALOG)
    states = L.leased(e, spark.createDataFrame([], "episode_uid string, attempt int"), "w", now(), 60)
    got = {k: sorted(map(tuple, v.collect())) for k, v in L.recovery(runs, e, states, spark.createDataFrame([("b",)], "episode_uid string"), "w", "r4", now()).items()}
    assert [r[0] for r in got["interrupted"]] == ["r2", "r3"] and [r[0] for r in got["resumed_from"]] == ["r3"] and [r[0] for r in got["released"]] == ["a", "b", "c"]
    assert [r[:3] for r in got["demoted"]] == [("a", "FETCHED", "PENDING")]
    (tmp_path / "x").mkdir()
    for name in ("x/a.tmp", "b.tmp", "x/c"):
        (tmp_path / name).write_text("")
    assert [p.rpartition("/")[2] for p in L.sweep(spark, str(tmp_path))] == ["b.tmp", "a.tmp"] and os.path.exists(tmp_path / "x" / "c") and L.sweep(spark, str(tmp_path / "none")) == []


def test_reports_agree_with_their_tables(spark):
    e = spark.createDataFrame([("a", "s", "x", "COMMITTED", 10, 1.0), ("b", "s", None, "COMMITTED", 5, 0.5), ("c", "t", "x", "FAILED", 7, 1.0)], "episode_uid string, source_id string, embodiment string, status string, n_frames long, duration_s double")
    r = spark.createDataFrame([("a", "R", "r1", "2024", 1, "PASS", None), ("a", "R", "r2", "2025", 2, "FAIL", None), ("b", "R", "r2", "2025", 3, "SKIPPED", "")], "episode_uid string, rule_id string, run_id string, created_at string, seq long, verdict string, reason string")
    run = {"run_id": "r2", "started_at": "t0", "finished_at": None, "status": "RUNNING", "resumed_from": None, "args": {}, "stats": L.Run("r2", failures=[("c", "KeyError: k")]).stats()}
    usage = spark.createDataFrame([("raw", 5)], "layer string, bytes long")
    report = P.build(e, r, run, usage)
    assert P.disagreements(report, e, r) == ([], [s.title for s in P.SECTIONS])
    assert report["sections"]["Committed by source and embodiment"]["rows"] == [["s", "", 1, 5], ["s", "x", 1, 10]]
    assert report["sections"]["Rule rates"]["rows"] == [["R", 1, 1, 1, 0, 1.0, 0.5]]
    text = P.markdown(report)
    assert "| KeyError | 1 |" in text and "## Time by stage" in text and json.loads(P.to_json(report))["run"]["run_id"] == "r2"
    report["sections"]["Episodes by stage"]["rows"][0][1] = 9
    assert len(P.disagreements(report, e, r)[0]) == 1
    corpus = P.build(e, r)
    assert corpus["run"] is None and "Counters" not in corpus["sections"] and P.disagreements(corpus, e, r)[0] == []


def test_export_lines_have_all_fields_and_an_audit(spark):
    entries = spark.createDataFrame([(0, "a", 10)], "pos int, episode_uid string, n_frames long")
    row = G.audit(entries, None, "out/x.jsonl", "r", "balanced", 12, "now", seed=3).first()
    assert (row["export_id"], row["n_frames"], json.loads(row["stats"])["shortfall_frames"], row["seed"]) == ("x.jsonl@now", 10, 2, 3)
    assert len(G.FIELDS) == 24 and list(G.FIELDS) == sorted(G.FIELDS)


def test_files_come_from_a_folder_or_the_cache(spark, tmp_path):
    from kinelake.sources.upstream import NotUpstream, Upstream, fetch_all

    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.bin").write_bytes(b"abcdef")
    for uri in (str(tmp_path), f"file://{tmp_path}"):
        u = Upstream("s", uri)
        with u.stream("d/x.bin") as f:
            assert f.read(3) == b"abc"
        assert u.local("d/x.bin") == str(tmp_path / "d" / "x.bin") and u.has("d/x.bin") and not u.has("y")
        with pytest.raises(NotUpstream), u.stream("y"):
            pass
    got = {r["path"]: r for r in fetch_all(spark.createDataFrame([("d/x.bin",), ("y",)], "path string"), Upstream("s", str(tmp_path))).collect()}
    assert got["d/x.bin"]["error"] is None and got["y"]["place"] is None and "NotUpstream" in got["y"]["error"]
    web = Upstream("s", "https://host.example/{revision}/data/{path}", "v 1", str(tmp_path / "cache"))
    assert web.address("a b/c") == "https://host.example/v%201/data/a%20b/c" and Upstream("s", "https://h.example/x/").address("y") == "https://h.example/x/y"
    os.makedirs(tmp_path / "cache" / "s" / "v 1")
    (tmp_path / "cache" / "s" / "v 1" / "z").write_bytes(b"z")
    assert web.local("z") == str(tmp_path / "cache" / "s" / "v 1" / "z")
    with pytest.raises(ValueError, match="neither"):
        Upstream("s", "http://h.example").local("x")


def test_what_was_done_on_the_way_is_told(spark, tmp_path):
    from kinelake.sources import vector_parquet as V

    frames = spark.createDataFrame([("a", 5.0, 0, [1.0, float("nan")]), ("a", 5.1, 1, [1.0, 2.0]), ("b", 0.0, 0, [0.0, 0.0])], "episode_uid string, timestamp double, index long, action array<double>")
    real = V.timestamp_source(frames, 10)
    assert {r[1] for r in real.collect()} == {"real"}
    told = {r["episode_uid"]: [(x["op"], x["n"]) for x in r["transforms"]] for r in V.transforms(frames, real).collect()}
    assert told == {"a": [("rebase_time", None), ("unpack_vectors", 1), ("missing_to_null", 1)], "b": [("unpack_vectors", 1)]}
    assert V.task_texts(spark, str(tmp_path)).count() == 0
    layers = spark.createDataFrame([("a", ["imu"], ["pose"]), ("b", ["imu"], [])], "episode_uid string, layers array<string>, missing array<string>")
    assert {r["episode_uid"]: [(x["op"], x["layer"]) for x in r["transforms"]] for r in segments.transforms(layers).collect()} == {"a": [("slice_segment", None), ("layer_absent", "pose")], "b": [("slice_segment", None)]}
    e = spark.createDataFrame([("s", "a", 2), ("s", "b", 1)], "source_id string, episode_uid string, n_frames int")
    raw = spark.createDataFrame([("a", {"z": 1.0, "y": 2.0}), ("a", {"z": None, "y": 2.0})], "episode_uid string, raw map<string,double>")
    store.write_episodes(e, raw, str(tmp_path / "e"))
    assert {r["episode_uid"]: r["raw_columns"] for r in spark.read.parquet(str(tmp_path / "e")).collect()} == {"a": ["y", "z"], "b": []}
