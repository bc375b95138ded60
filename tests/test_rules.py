"""Quality rules against hand-computed cases."""

import pytest

from kinelake.operators import rules as R
from kinelake.operators.rules import CAMERA, CHANNEL

NAN = float("nan")
CAPS = ["has_action", "has_state", "has_gripper", "has_video", "has_camera_pose", "has_termination_signal", "is_segment"]


def tables(spark, t=None, action=None, state=None, is_delta=False, role="end_effector", space="cartesian_2d", lo=0.0, hi=100.0, origin="measured", fps=10.0, clock="real", caps=CAPS, level=R.CONTINUOUS, cameras=None, segment=None, marker=None, state_space="cartesian_2d"):
    n = len(action or state or t or marker or [])
    t = t or [k / 10 for k in range(n)]
    seg = "struct<start_s:double,end_s:double,prev_end_s:double,next_start_s:double,parent_duration_s:double>"
    cap = {c: c in caps for c in CAPS}
    episodes = spark.createDataFrame(
        [("e", "x", fps, clock, n, cap, level, level, cameras, segment, "done" if marker else None)],
        f"episode_uid string, embodiment string, fps_nominal double, timestamp_source string, n_frames long, capabilities struct<{','.join(c + ':boolean' for c in CAPS)}>, action_level string, state_level string, cameras {CAMERA}, segment {seg}, termination_column string",
    )
    rows = []
    if action is not None:
        rows.append(("x", "action", "a", 0, True, is_delta, lo, hi, space, role, origin, "m", 0))
    if state is not None:
        rows.append(("x", "state", "a", 0, True, False, None, None, state_space, "unknown", origin, "m", 0))
    channels = spark.createDataFrame(rows, CHANNEL)
    samples = [("e", "x", s, "a", k, float(t[k]), float(v) if v is not None else None) for s, vs in (("action", action), ("state", state)) if vs is not None for k, v in enumerate(vs)]
    t = [float(x) for x in t]
    frames = [("e", k, t[k], {"done": float(marker[k])} if marker else {}) for k in range(n)]
    return R.Tables(
        episodes, channels, spark.createDataFrame(samples, "episode_uid string, embodiment string, signal string, channel string, frame_idx int, t double, value double"),
        spark.createDataFrame(frames, "episode_uid string, frame_idx int, t double, raw map<string,double>"),
    )


def check(spark, rule_id, params=None, **made):
    row = R.evaluate(tables(spark, **made), R.rule_by_id(rule_id), **(params or {})).collect()
    assert len(row) == 1
    return row[0]["verdict"], {k: round(v, 6) for k, v in row[0]["metrics"].items()}, row[0]["reason"]


def ramp(n, by=0.1):
    return [k * by for k in range(n)]


def test_action_jerk(spark):
    x = ramp(200)
    x[100] += 5
    v, m, _ = check(spark, "ACTION_JERK", action=x)
    assert v == "REVIEW" and m["n_jerks"] == 2 and m["jerk_ratio"] > 8
    d = [0.5] * 200
    d[80] = 6.0
    v, m, _ = check(spark, "ACTION_JERK", action=d, is_delta=True)
    assert v == "REVIEW" and m["n_jerks"] == 1
    assert check(spark, "ACTION_JERK", action=ramp(10))[0] == "SKIPPED"
    assert check(spark, "ACTION_JERK", action=ramp(60))[0] == "PASS"


def test_clock(spark):
    t = [k / 10 + (0.5 if k >= 10 else 0) for k in range(20)]
    v, m, _ = check(spark, "FPS_DRIFT", action=ramp(20), t=t)
    assert v == "FAIL" and m["n_gaps"] == 1 and m["fps_drift"] == 0 and m["max_dt"] == 0.6
    v, m, _ = check(spark, "FPS_DRIFT", action=ramp(20), t=[k / 5 for k in range(20)])
    assert v == "REVIEW" and m["fps_drift"] == 1
    assert check(spark, "FPS_DRIFT", action=ramp(20), fps=None)[0] == "SKIPPED"
    assert check(spark, "TS_MONOTONIC", action=ramp(4), t=[0, 0.1, NAN, 0.3])[0] == "FAIL"
    assert check(spark, "TS_MONOTONIC", action=ramp(4), clock="synthesized@10Hz")[2] == "synthetic_timestamp"
    assert check(spark, "TS_MONOTONIC", action=ramp(1))[:2] == ("PASS", {"n_frames": 1, "n_non_positive_dt": 0})


def test_range_and_downgrade(spark):
    v, m, _ = check(spark, "ACTION_RANGE", action=[0, 100, 101, NAN])
    assert v == "FAIL" and m["n_out_of_range"] == 1 and m["n_non_finite"] == 1
    v, _, reason = check(spark, "ACTION_RANGE", action=[0, 101], origin="estimated")
    assert v == "REVIEW" and reason.endswith("estimated")
    assert check(spark, "ACTION_RANGE", action=[1], caps=[])[2] == "capability_unmet:has_action"
    assert check(spark, "ACTION_RANGE", action=[1], level="episode_label")[2] == "action_level_is_episode_label"


def test_static(spark):
    v, m, _ = check(spark, "STATIC_EPISODE", action=ramp(30, 0.01))
    assert v == "FAIL" and m["travel_fraction"] == 0.0029
    v, m, _ = check(spark, "STATIC_EPISODE", action=ramp(30, 0.01), hi=1.0)
    assert v == "PASS" and m["travel_fraction"] == 0.29
    v, m, _ = check(spark, "STATIC_EPISODE", state=[None] * 30)
    assert v == "PASS" and set(m) == {"n_frames"}
    assert check(spark, "STATIC_EPISODE", action=ramp(19, 5))[0] == "FAIL"
    assert check(spark, "STATIC_EPISODE", action=[1.0] * 30, origin="estimated")[0] == "REVIEW"


def test_gripper(spark):
    x = [0.0] * 80
    x[10], x[20] = 1.0, -1.0
    v, m, _ = check(spark, "GRIPPER_STUCK", action=x, is_delta=True, role="gripper")
    assert v == "PASS" and m["min_gripper_travel"] == 2
    assert check(spark, "GRIPPER_STUCK", action=[1.0] * 80, role="gripper")[0] == "REVIEW"
    assert check(spark, "GRIPPER_STUCK", action=[1.0] * 50, role="gripper")[0] == "SKIPPED"
    assert check(spark, "GRIPPER_STUCK", action=[1.0] * 80)[0] == "ERROR"


def test_echo(spark):
    a = ramp(50)
    s = [x if k < 3 else x + 1 for k, x in enumerate(a)]
    v, m, _ = check(spark, "STATE_ACTION_ECHO", action=a, state=s)
    assert v == "PASS" and m["echo_fraction"] == 0.06
    assert check(spark, "STATE_ACTION_ECHO", action=a, state=a)[0] == "REVIEW"
    assert check(spark, "STATE_ACTION_ECHO", action=a, state=a, state_space="joint_position")[0] == "SKIPPED"
    assert check(spark, "STATE_ACTION_ECHO", action=[1.0] * 5, state=[1.0] * 5)[1]["correlation"] == 0


def test_video(spark):
    cam = lambda n, here=True: [("main", "mp4_sidecar", here, n)]
    v, m, _ = check(spark, "VIDEO_FRAME_MISMATCH", action=ramp(40), cameras=cam(52))
    assert v == "FAIL" and m["n_mismatched"] == 1 and m["max_frame_delta"] == 12
    assert check(spark, "VIDEO_FRAME_MISMATCH", action=ramp(40), cameras=cam(41))[0] == "PASS"
    assert check(spark, "VIDEO_FRAME_MISMATCH", action=ramp(40), cameras=cam(None))[0] == "SKIPPED"
    assert check(spark, "VIDEO_FRAME_MISMATCH", action=ramp(40), cameras=cam(40, False))[0] == "FAIL"


@pytest.mark.parametrize(("at", "verdict", "interior"), [([19, 39], "FAIL", 1), ([39], "PASS", 0), ([], "REVIEW", 0), ([37, 38, 39], "REVIEW", 0)])
def test_termination(spark, at, verdict, interior):
    v, m, _ = check(spark, "TERMINATION_CONSISTENCY", marker=[k in at for k in range(40)], action=ramp(40))
    assert v == verdict and m["n_interior_signals"] == interior


def test_pose(spark):
    v, m, _ = check(spark, "POSE_COVERAGE", state=[1.0] * 4 + [None] * 6 + [1.0] * 10, state_space="camera_translation_abs")
    assert v == "REVIEW" and m["longest_gap_s"] == 0.6 and m["n_unregistered"] == 6
    assert check(spark, "POSE_COVERAGE", state=[1.0] * 9 + [None], state_space="camera_translation_abs")[:2] == ("PASS", {"n_frames": 10, "pose_coverage": 0.9, "longest_gap_s": 0, "n_unregistered": 1})
    assert check(spark, "POSE_COVERAGE", state=[1.0] * 9)[0] == "ERROR"


def test_segment(spark):
    v, m, _ = check(spark, "SEGMENT_BOUNDS", action=ramp(20), segment=(10.0, 12.0, None, 10.5, None))
    assert v == "REVIEW" and m["overlap_fraction"] == 0.75
    assert check(spark, "SEGMENT_BOUNDS", action=ramp(20), segment=(10.0, 9.0, None, None, None))[0] == "FAIL"
    assert check(spark, "SEGMENT_BOUNDS", action=ramp(20), segment=(1.0, 12.0, None, None, 11.0))[0] == "FAIL"
    assert check(spark, "SEGMENT_BOUNDS", action=ramp(20))[0] == "SKIPPED"


def test_roll_up(spark):
    e = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "episode_uid string")
    r = spark.createDataFrame([("a", "FAIL"), ("a", "PASS"), ("b", "ERROR"), ("c", "SKIPPED")], "episode_uid string, verdict string")
    assert dict(map(tuple, R.roll_up(e, r).collect())) == {"a": "FAIL", "b": "REVIEW", "c": "PASS", "d": "PASS"}
