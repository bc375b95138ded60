import pytest

from kinelake.operators import invariants as I
from kinelake.sources import registry

CAPS = "struct<has_action:boolean,has_state:boolean,has_video:boolean,is_segment:boolean,has_termination_signal:boolean>"


def found(df):
    return {(r["invariant"], r["subject"]) for r in df.collect()}


def test_episodes(spark):
    good = ("s:1", "s", "1", (True, False, False, False, False), I.CONTINUOUS, "absent", [], None, None, "real", "upstream", False, "success", "none", None)
    bad = ("x", "s", "2", (False, True, True, False, False), I.CONTINUOUS, "absent", [("inline",)], ("p",), "done", "wall", "derived", True, "success", "none", True)
    e = spark.createDataFrame([good, bad], f"episode_uid string, source_id string, upstream_id string, capabilities {CAPS}, action_level string, state_level string, cameras array<struct<encoding:string>>, segment struct<p:string>, termination_column string, timestamp_source string, frame_index_source string, truncated boolean, end_reason string, adjudicator string, success boolean")
    assert found(I.episode_checks(e)) == {(k, "x") for k in ("3action", "3state", "11", "7", "14", "clock", "15", "18", "19", "uid")}


def test_channels_columns_streams_and_plans(spark):
    c = spark.createDataFrame([("e", "action", "a", 1.0, 0.0, "gripper", None, "g", "flag"), ("e", "action", "raw.b", None, None, "joint", "m", "g", "flag"), ("e", "action", "d", None, None, "joint", None, None, "flag"), ("e", "action", "d", None, None, "joint", None, None, "flag")], "embodiment string, signal string, channel string, min double, max double, role string, gripper string, `group` string, space string").withColumnRenamed("x", "x")
    assert found(I.channel_checks(c)) == {("limits", "e.action.a"), ("8", "e.action.a"), ("8", "e.action.raw.b"), ("prefix", "e.action.raw.b"), ("name", "e.action.d")}
    e = spark.createDataFrame([("u", "e", I.CONTINUOUS, "absent")], "episode_uid string, embodiment string, action_level string, state_level string")
    s = spark.createDataFrame([("u", "action", "a"), ("u", "action", "z")], "episode_uid string, signal string, channel string")
    assert found(I.column_checks(e, c.filter("channel IN ('a', 'raw.b')"), s)) == {("2", "u.action.raw.b"), ("2", "u.action.z")}
    t = spark.createDataFrame([("u", "g", "x", 0, 1.0), ("u", "g", "x", 1, 0.5), ("u", "h", "x", 0, 1.0)], "episode_uid string, stream_id string, channel string, sample_idx int, t double")
    assert found(I.stream_checks(t)) == {("17", "u.g")}
    plan = spark.createDataFrame([("a", 3), ("a", 3), ("b", 1)], "episode_uid string, n_frames long")
    cat = spark.createDataFrame([("a", 3), ("b", 2)], "episode_uid string, n_frames long")
    assert found(I.plan_checks(plan, cat, 6)) == {("5", "a"), ("5", "b"), ("5", "plan")}
    moves = spark.createDataFrame([("p", "FETCHED", "COMMITTED", None), ("q", "FETCHED", "NORMALIZED", None)], "episode_uid string, from_stage string, to_stage string, reason string")
    assert found(I.all_of(I.transition_checks(moves), I.transition_checks(moves.limit(0)))) == {("1", "p")}


def test_registry(spark):
    config = {"defaults": {"max_episodes": 5, "enabled": True}, "sources": {"b": {"kind": "segments", "rate": 50}, "a": {"max_episodes": 7}}}
    rows = registry.source_table(spark, config, {"b": {"max_episodes": 1}}).collect()
    assert [(r["source_id"], r["max_episodes"], r["options"]) for r in rows] == [("a", 7, {}), ("b", 1, {"rate": "50"})]
    c = registry.channel_rows({"x": {"action": [{"name": "a"}, {"name": "f", "is_physical": False}, {"name": "g", "max": 1}]}})
    assert [(r[2], r[3], r[-1]) for r in c] == [("a", 0, 0), ("f", 1, None), ("g", 2, 1)]
    made = {r.rule_id: r for r in registry.rules({"ACTION_JERK": {"params": {"max_ratio": 9.0}}, "FPS_DRIFT": {"enabled": False}})}
    assert made["ACTION_JERK"].params["max_ratio"] == 9.0 and "FPS_DRIFT" not in made and len(made) == 10
    with pytest.raises(ValueError):
        registry.rules({"ACTION_JERK": {"params": {"x": 1}}})
