"""The eleven quality rules as DataFrame queries, and the engine around them.

A rule has two parts: `facts`, an aggregate of the samples or frames with one row per episode, and `judge`, column
expressions over an episode and its facts that give (verdict, reason, metrics). So a rule is one join of episodes with
one aggregate, and all eleven are one table of episodes with eleven aggregates beside it. `evaluate` puts the gate in
front of the verdict (a gated episode is SKIPPED with the gate's reason and has no metrics of the rule), the downgrade
behind, and adds n_frames. Metrics that cannot be computed are absent keys, not NULL or 0.

Every aggregate deals its rows out by episode first, in a window over the whole episode; windows by channel or frame
and the final grouping then find them in place, so that samples move once.

Tables: episodes(episode_uid, embodiment, fps_nominal, timestamp_source, n_frames, capabilities struct, action_level,
state_level, cameras, segment, termination_column), channels(embodiment, signal, channel, pos, is_physical, is_delta,
min, max, space, role, origin, phys_ordinal), samples(episode_uid, embodiment, signal, channel, frame_idx, t, value),
frames(episode_uid, frame_idx, t, raw map<string,double>).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.functions import signals as S
from kinelake.operators import order

PASS, FAIL, REVIEW, SKIPPED, ERROR = "PASS", "FAIL", "REVIEW", "SKIPPED", "ERROR"
CONTINUOUS = "per_frame_continuous"
# Spaces that measure an orientation, a camera pose, and actuation.
ROTATIONS = ("ee_rotation_abs", "ee_rotation_delta", "camera_rotation_abs")
POSES = ("camera_translation_abs", "camera_rotation_abs")
GRIPPER = "gripper"
EPISODE = "episode_uid"
#: Schemas of declared channels and of an episode's cameras.
CHANNEL = "embodiment string, signal string, channel string, pos int, is_physical boolean, is_delta boolean, min double, max double, space string, role string, origin string, unit string, phys_ordinal int"
CAMERA = "array<struct<name:string,encoding:string,is_present:boolean,n_frames:bigint>>"


@dataclass(frozen=True)
class Tables:
    episodes: DataFrame
    channels: DataFrame
    samples: DataFrame
    frames: DataFrame


@dataclass(frozen=True)
class Judgement:
    verdict: Column
    reason: Column
    metrics: dict[str, Column]


@dataclass(frozen=True)
class Rule:
    """`judge` gets the facts as a function from a name to a column (NULL where an episode has none) and the parameters.
    Where `facts` are needed for a verdict and an episode has none, it passes with the reason "no frames"."""

    rule_id: str
    facts: Callable[[Tables, dict], DataFrame] | None
    judge: Callable[[Callable[[str], Column], dict], Judgement]
    params: dict = field(default_factory=dict)
    capabilities: tuple[str, ...] = ()
    levels: tuple[str, ...] = ()
    real_clock: bool = False
    needs_facts: bool = True


def metrics(values: dict[str, Column]) -> Column:
    """A map of the metrics that have a value."""
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), v.cast("double").alias("v")) for k, v in values.items()])
    return F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull()))


def _signal(t: Tables, *signals: str, physical: bool = True) -> DataFrame:
    """Samples of signals with what is declared of their channels, and `cid`, a number for each channel of an embodiment, by
    signal and then by place."""
    declared = t.channels.filter(F.col("signal").isin(*signals))
    declared = declared.filter("is_physical") if physical else declared
    place = F.array_position(F.array(*map(F.lit, signals)), F.col("signal")) * (1 << 20) + F.col("pos")
    keep = declared.select("embodiment", "signal", "channel", place.alias("cid"), "is_delta", F.col("min").alias("lo"), F.col("max").alias("hi"), "space", "role", "phys_ordinal")
    return t.samples.join(F.broadcast(keep), ["embodiment", "signal", "channel"]).withColumn("value", S.finite("value"))


def _steps(df: DataFrame) -> DataFrame:
    """Rows with `first`, whether they are a channel's first, and `step`, how far it moved into this frame."""
    w = Window.partitionBy(EPISODE).orderBy("cid", "frame_idx")
    told = df.withColumns({"first": ~F.coalesce(F.lag("cid").over(w) == F.col("cid"), F.lit(False)), "change": S.difference("value", w)})
    return told.withColumn("step", F.when(~F.col("first"), F.abs(F.when(F.col("is_delta"), F.col("value")).otherwise(F.col("change"))))).drop("change")


def _clock(t: Tables) -> DataFrame:
    return t.frames.select(EPISODE, "frame_idx", "t", S.difference("t", S.ordered(EPISODE)).alias("dt"))


def ts_monotonic_facts(t: Tables, p: dict) -> DataFrame:
    return _clock(t).groupBy(EPISODE).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("dt") <= 0).alias("bad"), F.count_if(S.finite("t").isNull()).alias("holes"),
        F.min("dt").alias("lo"), F.percentile("dt", F.lit(0.5)).alias("mid"), F.max("dt").alias("hi"),
    )


def ts_monotonic(f: Callable[[str], Column], p: dict) -> Judgement:
    short = f("n") < 2
    clear = lambda c: F.when(~short & (f("holes") == 0), f(c))  # noqa: E731  with a hole they are not numbers
    return Judgement(
        F.when(~short & (f("bad") + f("holes") > 0), FAIL).otherwise(PASS),
        F.when(short, F.lit("one frame or none")).otherwise(F.format_string("%d steps back or still, %d times missing", f("bad"), f("holes"))),
        {"n_non_positive_dt": f("bad"), "n_non_finite_t": F.when(~short, f("holes")), "min_dt": clear("lo"), "median_dt": clear("mid"), "max_dt": clear("hi")},
    )


def fps_drift_facts(t: Tables, p: dict) -> DataFrame:
    mid = F.percentile("dt", F.lit(0.5)).over(Window.partitionBy(EPISODE))
    gap = (F.col("mid") > 0) & (F.col("dt") > p["gap_factor"] * F.col("mid"))
    return _clock(t).withColumn("mid", mid).groupBy(EPISODE).agg(F.max("mid").alias("mid"), F.count("dt").alias("n"), F.max("dt").alias("hi"), F.count_if(gap).alias("gaps"))


def fps_drift(f: Callable[[str], Column], p: dict) -> Judgement:
    rate = F.col("fps_nominal")
    expected = F.try_divide(F.lit(1.0), rate)
    part, drift = F.try_divide(f("gaps"), f("n")), F.abs(f("mid") - expected) / expected
    none = ~F.coalesce(rate > 0, F.lit(False)) | (f("n") == 0)
    values = {"median_dt": f("mid"), "expected_dt": expected, "fps_drift": drift, "n_gaps": f("gaps"), "gap_fraction": part, "max_dt": f("hi")}
    return Judgement(
        F.when(none, SKIPPED).when(part > p["max_gap_fraction"], FAIL).when((drift > p["max_drift"]) | (f("gaps") > 0), REVIEW).otherwise(PASS),
        F.when(none, F.lit("no declared rate or no steps")).otherwise(F.format_string("%d gaps, drift %.3f", f("gaps"), drift)),
        {k: F.when(~none, v) for k, v in values.items()},
    )


def action_range_facts(t: Tables, p: dict) -> DataFrame:
    v = F.col("value")
    outside = F.coalesce(v < F.col("lo"), F.lit(False)) | F.coalesce(v > F.col("hi"), F.lit(False))
    # by channel first, in numbers alone; names of those that are out are few
    per = _signal(t, "action").groupBy(EPISODE, "channel").agg(F.count_if(v.isNull()).alias("holes"), F.count_if(outside).alias("out"))
    bad = F.collect_list(F.when(F.col("holes") + F.col("out") > 0, F.col("channel")))
    return per.groupBy(EPISODE).agg(F.sum("holes").alias("holes"), F.sum("out").alias("out"), F.count(F.lit(1)).alias("k"), F.array_join(F.sort_array(bad), ", ").alias("who"))


def action_range(f: Callable[[str], Column], p: dict) -> Judgement:
    return Judgement(
        F.when(f("who") != "", FAIL).otherwise(PASS), F.format_string("%d missing, %d out of range: %s", f("holes"), f("out"), f("who")),
        {"n_non_finite": f("holes"), "n_out_of_range": f("out"), "n_physical_channels": f("k")},
    )


def action_jerk_facts(t: Tables, p: dict) -> DataFrame:
    steps = _steps(_signal(t, "action")).filter("NOT first").withColumn("step", F.coalesce("step", F.lit(0.0)))
    channel = Window.partitionBy(EPISODE, "cid")
    told = steps.withColumns({"ref": F.percentile("step", F.lit(0.99)).over(channel), "n": F.count(F.lit(1)).over(channel), "peak": F.max("step").over(channel)})
    near = S.around("step", channel.orderBy("frame_idx"), p["isolation_window"])
    told = told.withColumn("near", near)
    judged = (F.col("n") >= p["min_steps"]) & (F.col("ref") > 0)
    ratio = F.when(judged, F.col("step") / F.col("ref"))
    # the median around a step is only wanted where the step is large
    told = told.withColumn("ratio", ratio).withColumn("alone", F.when((F.col("ratio") > p["max_ratio"]) | (judged & (F.col("step") == F.col("peak"))), S.isolation("step", F.col("near"))))
    hit = (F.col("ratio") > p["max_ratio"]) & (F.col("alone") > p["min_isolation"])
    # ties: the first channel, then the first step
    best = F.max(F.when(F.col("ratio").isNotNull(), F.struct("ratio", (-F.col("phys_ordinal")).alias("c"), (-F.col("frame_idx")).alias("i"), "alone")))
    return told.groupBy(EPISODE).agg(
        best.alias("best"), F.count_if(hit).alias("hits"), F.size(F.collect_set(F.when(F.col("ratio").isNotNull(), F.col("channel")))).alias("k"),
        F.array_join(F.sort_array(F.collect_set(F.when(hit, F.col("channel")))), ", ").alias("who"),
    )


def action_jerk(f: Callable[[str], Column], p: dict) -> Judgement:
    none = f("k") == 0
    return Judgement(
        F.when(none, SKIPPED).when(f("hits") > 0, REVIEW).otherwise(PASS),
        F.when(none, F.lit("no channel with enough varying steps")).otherwise(F.format_string("%d lone jumps: %s", f("hits"), f("who"))),
        {"jerk_ratio": F.when(f("k").isNotNull(), F.coalesce(f("best")["ratio"], F.lit(0.0))), "jerk_isolation": F.when(f("k").isNotNull(), F.coalesce(f("best")["alone"], F.lit(0.0))), "n_jerks": f("hits"), "n_channels_examined": f("k")},
    )


def static_episode_facts(t: Tables, p: dict) -> DataFrame:
    """Of either signal and of both, the part of frames in which nothing moves, and the longest way of a channel."""
    steps = _steps(_signal(t, "action", "state"))
    far = (F.col("hi") > F.col("lo")) & ~F.col("space").isin(*ROTATIONS, GRIPPER)
    way = F.sum("step").over(Window.partitionBy(EPISODE, "cid")) / (F.col("hi") - F.col("lo"))
    told = steps.withColumns({"way": F.when(far, way), "still": F.col("step") == 0})
    of = lambda s, c: F.when(F.col("signal") == s, F.col(c))
    frame = told.groupBy(EPISODE, "frame_idx").agg(*[x for s in ("action", "state") for x in (F.bool_and(of(s, "still")).alias(f"still_{s}"), F.max(of(s, "way")).alias(f"way_{s}"))])
    both = F.when(F.coalesce("still_action", "still_state").isNotNull(), F.coalesce("still_action", F.lit(True)) & F.coalesce("still_state", F.lit(True)))
    share = lambda c: F.avg(c.cast("int"))
    return frame.groupBy(EPISODE).agg(
        share(F.col("still_action")).alias("still_action"), share(F.col("still_state")).alias("still_state"), share(both).alias("still_both"), F.max("way_action").alias("way_action"), F.max("way_state").alias("way_state")
    )


def static_episode(f: Callable[[str], Column], p: dict) -> Judgement:
    a, s = (F.coalesce(F.col(f"{x}_level") == CONTINUOUS, F.lit(False)) for x in ("action", "state"))
    still = F.when(a & s, f("still_both")).when(a, f("still_action")).when(s, f("still_state"))
    travel = F.greatest(F.when(a, f("way_action")), F.when(s, f("way_state")))
    short = F.col("n_frames") < p["min_frames"]
    frozen = F.coalesce(still > p["max_still_fraction"], F.lit(False))
    near = F.coalesce(travel < p["min_travel_fraction"], F.lit(False))
    none = F.array().cast("array<string>")
    read = F.array_distinct(F.concat(F.when(a, F.coalesce("o_action", none)).otherwise(none), F.when(s, F.coalesce("o_state", none)).otherwise(none)))
    derived = (F.size(read) > 0) & ~F.array_contains(read, "measured") & ~short
    return Judgement(
        F.when(~(short | frozen | near), PASS).when(derived, REVIEW).otherwise(FAIL),
        F.concat_ws("; ", F.when(short, F.lit("too short")), F.when(frozen, F.lit("still")), F.when(near, F.lit("hardly moves")), F.when((short | frozen | near) & derived, F.concat(F.lit("downgraded: "), F.array_join(F.sort_array(read), ",")))),
        {"still_fraction": still, "travel_fraction": travel},
    )


def gripper_stuck_facts(t: Tables, p: dict) -> DataFrame:
    per = _signal(t, "action", physical=False).filter("role = 'gripper' AND value IS NOT NULL").groupBy(EPISODE, "channel", "is_delta").agg(F.count_distinct("value").alias("kinds"), F.sum(F.abs("value")).alias("way"))
    stuck = F.when(F.col("is_delta"), F.col("way") == 0).otherwise(F.col("kinds") <= 1)
    return per.groupBy(EPISODE).agg(F.min(F.when(~F.col("is_delta"), F.col("kinds"))).alias("kinds"), F.min(F.when(F.col("is_delta"), F.col("way"))).alias("way"), F.array_join(F.sort_array(F.collect_set(F.when(stuck, F.col("channel")))), ", ").alias("who"))


def gripper_stuck(f: Callable[[str], Column], p: dict) -> Judgement:
    k = F.when(F.col("n_gripper") > 0, F.col("n_gripper"))
    none, short = k.isNull(), F.col("n_frames") <= p["min_frames"]
    value = lambda c: F.when(~none & ~short, f(c))
    return Judgement(
        F.when(none, ERROR).when(short, SKIPPED).when(f("who") != "", REVIEW).otherwise(PASS),
        F.when(none, F.lit("no gripper channel is declared")).when(short, F.lit("too short to expect an actuation")).otherwise(F.concat(F.lit("never actuates: "), F.coalesce(f("who"), F.lit("")))),
        {"n_gripper_channels": k, "min_unique_values": value("kinds"), "min_gripper_travel": value("way")},
    )


def state_action_echo_facts(t: Tables, p: dict) -> DataFrame:
    """In an episode's rows by frame and ordinal a state follows the action that it is compared with."""
    w = Window.partitionBy(EPISODE).orderBy("frame_idx", "phys_ordinal", "is_state")
    before = lambda c: F.lag(c).over(w)
    cells = _signal(t, "action", "state").select(EPISODE, "frame_idx", "phys_ordinal", (F.col("signal") == "state").cast("int").alias("is_state"), F.col("value").alias("state"))
    rows = cells.withColumns({"action": before("state"), "f0": before("frame_idx"), "o0": before("phys_ordinal"), "s0": before("is_state")})
    pairs = rows.filter("is_state = 1 AND s0 = 0 AND f0 = frame_idx AND o0 = phys_ordinal").select(EPISODE, "frame_idx", "phys_ordinal", "action", "state")
    pairs = pairs.withColumn("d", F.abs(F.col("action") - F.col("state")))
    frame = Window.partitionBy(EPISODE, "frame_idx")
    told = pairs.withColumns({"worst": F.max("d").over(frame), "whole": F.min(F.col("d").isNotNull()).over(frame), "k": F.row_number().over(frame.orderBy("phys_ordinal"))}).filter("whole")
    one = F.when(F.col("k") == 1, (F.col("worst") < p["tolerance"]).cast("int"))
    spread = F.stddev_pop("action") * F.stddev_pop("state")
    corr = F.when((F.count(F.lit(1)) >= 2) & (F.stddev_pop("action") > 0) & (F.stddev_pop("state") > 0), F.try_divide(F.covar_pop("action", "state"), spread)).otherwise(0.0)
    return told.groupBy(EPISODE).agg(F.avg(one).alias("echo"), F.max("worst").alias("far"), corr.alias("corr"))


def state_action_echo(f: Callable[[str], Column], p: dict) -> Judgement:
    comparable = F.coalesce((F.col("action_space") == F.col("state_space")) & (F.col("action_dim") == F.col("state_dim")) & (F.col("action_dim") > 0), F.lit(False))
    may = comparable & f("echo").isNotNull()
    return Judgement(
        F.when(~may, SKIPPED).when(f("echo") > p["max_echo_fraction"], REVIEW).otherwise(PASS),
        F.when(~comparable, F.lit("not comparable")).when(~may, F.lit("no frame has both signals")).otherwise(F.format_string("%.3f of frames repeat the state", f("echo"))),
        {k: F.when(may, f(c)) for k, c in (("echo_fraction", "echo"), ("max_abs_difference", "far"), ("correlation", "corr"))},
    )


def video_frame_mismatch(f: Callable[[str], Column], p: dict) -> Judgement:
    cams = F.filter("cameras", lambda c: c["encoding"] == "mp4_sidecar")  # NULL has the size -1 or NULL
    measured = F.filter(cams, lambda c: c["is_present"] & c["n_frames"].isNotNull())
    off = F.coalesce(F.transform(measured, lambda c: F.abs(c["n_frames"] - F.col("n_frames")).cast("long")), F.array().cast("array<long>"))
    missing, bad = F.greatest(F.size(F.filter(cams, lambda c: ~c["is_present"])), F.lit(0)), F.size(F.filter(off, lambda d: d > p["max_frame_delta"]))
    return Judgement(
        F.when((missing > 0) | (bad > 0), FAIL).when(F.size(off) == 0, SKIPPED).otherwise(PASS), F.format_string("%d missing, %d of another length", missing, bad),
        {"n_cameras": F.greatest(F.size(cams), F.lit(0)), "n_missing": missing, "n_measured": F.size(off), "n_mismatched": bad, "max_frame_delta": F.coalesce(F.array_max(off), F.lit(0).cast("long"))},
    )


def termination_facts(t: Tables, p: dict) -> DataFrame:
    named = t.episodes.select(EPISODE, "termination_column").filter("termination_column IS NOT NULL")
    return S.end_markers(t.frames.join(named, EPISODE).withColumn("m", F.try_element_at("raw", F.col("termination_column"))), "m").withColumnRenamed("n_frames", "n")


def termination_consistency(f: Callable[[str], Column], p: dict) -> Judgement:
    run, none = f("terminal_run"), f("n").isNull()
    return Judgement(
        F.when(none, SKIPPED).when(f("n_interior_signals") > 0, FAIL).when((run == 0) | (run > p["max_terminal_run"]), REVIEW).otherwise(PASS),
        F.when(none, F.lit("no end marker or no frames")).otherwise(F.format_string("%d trailing, %d interior markers", run, f("n_interior_signals"))),
        {"n_end_signals": f("n_end_signals"), "terminal_run": run, "n_interior_signals": f("n_interior_signals")},
    )


def pose_coverage_facts(t: Tables, p: dict) -> DataFrame:
    pose = _signal(t, "state").filter(F.col("space").isin(*POSES))
    rows = pose.groupBy(EPISODE, "frame_idx").agg(F.bool_and(F.col("value").isNotNull()).alias("whole"), F.first("t").alias("t"))
    return S.with_gaps(rows, "whole").groupBy(EPISODE).agg(F.avg(F.col("here").cast("int")).alias("part"), F.count_if(~F.col("here")).alias("holes"), F.coalesce(F.max("gap"), F.lit(0.0)).alias("gap"))


def pose_coverage(f: Callable[[str], Column], p: dict) -> Judgement:
    none = f("part").isNull()
    return Judgement(
        F.when(none, ERROR).when((f("part") < p["min_coverage"]) | (f("gap") > p["max_gap_s"]), REVIEW).otherwise(PASS),
        F.when(none, F.lit("no pose channel is declared")).otherwise(F.format_string("coverage %.3f, longest gap %.3f s", f("part"), f("gap"))),
        {"pose_coverage": f("part"), "longest_gap_s": f("gap"), "n_unregistered": f("holes")},
    )


def segment_bounds(f: Callable[[str], Column], p: dict) -> Judgement:
    s = F.col("segment")
    over = lambda a, b: F.greatest(F.coalesce(a - b, F.lit(0.0)), F.lit(0.0))
    d, prev, nxt = s["end_s"] - s["start_s"], over(s["prev_end_s"], s["start_s"]), over(s["end_s"], s["next_start_s"])
    part = F.when(d > 0, F.greatest(prev, nxt) / d).otherwise(0.0)
    none = s.isNull()
    bad = (d <= 0) | (s["start_s"] < 0) | F.coalesce(s["end_s"] > s["parent_duration_s"], F.lit(False))
    values = {"segment_duration_s": d, "overlap_prev_s": prev, "overlap_next_s": nxt, "overlap_fraction": part}
    return Judgement(
        F.when(none, SKIPPED).when(bad, FAIL).when((d < p["min_duration_s"]) | (part > p["max_overlap_fraction"]), REVIEW).otherwise(PASS),
        F.when(none, F.lit("no segment bounds")).otherwise(F.format_string("%.3f s, %.3f overlaps", d, part)),
        {k: F.when(~none, v) for k, v in values.items()},
    )


# The rules' ids, gates and thresholds.
RULES = [
    Rule("TS_MONOTONIC", ts_monotonic_facts, ts_monotonic, real_clock=True),
    Rule("FPS_DRIFT", fps_drift_facts, fps_drift, {"max_drift": 0.05, "gap_factor": 3.0, "max_gap_fraction": 0.01}, real_clock=True),
    Rule("ACTION_RANGE", action_range_facts, action_range, {}, ("has_action",), ("action",)),
    Rule("ACTION_JERK", action_jerk_facts, action_jerk, {"max_ratio": 8.0, "min_isolation": 5.0, "isolation_window": 5, "min_steps": 20}, ("has_action",), ("action",)),
    Rule("STATIC_EPISODE", static_episode_facts, static_episode, {"min_frames": 20, "max_still_fraction": 0.95, "min_travel_fraction": 0.05}, needs_facts=False),
    Rule("GRIPPER_STUCK", gripper_stuck_facts, gripper_stuck, {"min_frames": 50}, ("has_action", "has_gripper"), ("action",), needs_facts=False),
    Rule("STATE_ACTION_ECHO", state_action_echo_facts, state_action_echo, {"tolerance": 1e-9, "max_echo_fraction": 0.9}, ("has_action", "has_state"), ("action", "state"), needs_facts=False),
    Rule("VIDEO_FRAME_MISMATCH", None, video_frame_mismatch, {"max_frame_delta": 1}, ("has_video",), needs_facts=False),
    Rule("TERMINATION_CONSISTENCY", termination_facts, termination_consistency, {"max_terminal_run": 2}, ("has_termination_signal",), needs_facts=False),
    Rule("POSE_COVERAGE", pose_coverage_facts, pose_coverage, {"min_coverage": 0.8, "max_gap_s": 0.5}, ("has_camera_pose",), ("state",), needs_facts=False),
    Rule("SEGMENT_BOUNDS", None, segment_bounds, {"min_duration_s": 0.4, "max_overlap_fraction": 0.5}, ("is_segment",), needs_facts=False),
]


def signal_specs(channels: DataFrame) -> DataFrame:
    """Derived facts of a signal: space (one, none or mixed), is_delta of any physical channel, dim, physical_dim."""
    kinds = _spaces(F.col("is_physical"))
    return channels.groupBy("embodiment", "signal").agg(
        _one_space(kinds).alias("space"),
        F.coalesce(F.bool_or(F.when(F.col("is_physical"), F.col("is_delta"))), F.lit(False)).alias("is_delta"),
        F.count(F.lit(1)).alias("dim"), F.count_if("is_physical").alias("physical_dim"),
    )


def _one_space(kinds: Column) -> Column:
    return F.when(F.size(kinds) == 0, "none").when(F.size(kinds) == 1, kinds[0]).otherwise("mixed")


def _spaces(which: Column) -> Column:
    """The kinds of space of the channels that are meant, as a set."""
    space = F.col("space")
    summary = (
        F.when(space.isin("joint_position", "cartesian_2d"), space)
        .when(space.isin("ee_translation_abs", "ee_rotation_abs"), "ee_pose_abs")
        .when(space.isin("ee_translation_delta", "ee_rotation_delta"), "ee_pose_delta")
        .when(space.isin(*POSES), "camera_pose_abs")
        .when(space.startswith("imu_"), "imu")
        .when(space == GRIPPER, "mixed")
        .otherwise("unknown")
    )
    return F.collect_set(F.when(which, summary))


def declared(channels: DataFrame) -> DataFrame:
    """What rules read of an embodiment as a whole: the origins, the kind of space and the number of physical channels of
    action and state, and the number of gripper channels."""
    facts = [F.count_if((F.col("signal") == "action") & (F.col("role") == "gripper")).alias("n_gripper")]
    for s in ("action", "state"):
        mine = (F.col("signal") == s) & F.col("is_physical")
        of = F.max(F.col("signal") == s)  # a signal without any channel has no space
        facts += [F.collect_set(F.when(mine, F.col("origin"))).alias(f"o_{s}"), F.when(of, _one_space(_spaces(mine))).alias(f"{s}_space"), F.when(of, F.count_if(mine)).alias(f"{s}_dim")]
    return channels.groupBy("embodiment").agg(*facts)


def gate(rule: Rule) -> Column:
    """Why an episode is skipped; NULL if the rule may run."""
    out = F.lit(None).cast("string")
    if rule.real_clock:
        out = F.when(F.coalesce(F.col("timestamp_source") != "real", F.lit(True)), "synthetic_timestamp")
    for s in reversed(rule.levels):
        level = F.coalesce(F.col(f"{s}_level"), F.lit("absent"))
        out = F.when(level != CONTINUOUS, F.concat(F.lit(f"{s}_level_is_"), level)).otherwise(out)
    for c in sorted(rule.capabilities, reverse=True):
        out = F.when(~F.coalesce(F.col("capabilities")[c], F.lit(False)), f"capability_unmet:{c}").otherwise(out)
    return out


def _judged(rule: Rule, facts: str, params: dict) -> Column:
    """struct(rule_id, verdict, reason, metrics) of a row of episodes with declared columns and the struct of facts."""
    f = lambda name: F.col(facts)[name]
    told = rule.judge(f, params)
    verdict, reason, own = told.verdict, told.reason, metrics(told.metrics)
    if rule.needs_facts:
        none = F.col(facts).isNull()
        verdict, reason, own = F.when(none, PASS).otherwise(verdict), F.when(none, "no frames").otherwise(reason), F.when(~none, own)
    if rule.levels:
        read = F.array_distinct(F.concat(*[F.coalesce(F.col(f"o_{s}"), F.array().cast("array<string>")) for s in rule.levels]))
        down = (verdict == FAIL) & (F.size(read) > 0) & ~F.array_contains(read, "measured")
        reason = F.when(down, F.concat(reason, F.lit("; downgraded: "), F.array_join(F.sort_array(read), ","))).otherwise(reason)
        verdict = F.when(down, REVIEW).otherwise(verdict)
    why = gate(rule)
    n = F.create_map(F.lit("n_frames"), F.col("n_frames").cast("double"))
    all_ = F.when(why.isNotNull() | own.isNull(), n).otherwise(F.map_concat(F.map_filter(n, lambda k, v: ~F.map_contains_key(own, k)), own))
    return F.struct(F.lit(rule.rule_id).alias("rule_id"), F.when(why.isNotNull(), SKIPPED).otherwise(verdict).alias("verdict"), F.coalesce(why, reason).alias("reason"), all_.alias("metrics"))


def dealt(t: Tables) -> Tables:
    """The tables with samples and frames dealt out by episode and written once, for many rules: what is known of how a
    written table lies stays known, so that all windows, groupings and joins by episode find their rows in place."""
    return Tables(t.episodes, t.channels, order.dealt(t.samples, EPISODE), order.dealt(t.frames, EPISODE))


def _beside(t: Tables, rules: list[Rule] | None, params: dict | None) -> tuple[DataFrame, list[Column]]:
    """Episodes beside every rule's facts, and every rule's result as a struct over such a row."""
    rules = RULES if rules is None else rules
    t = dealt(t) if len(rules) > 1 else t
    wide = t.episodes.join(F.broadcast(declared(t.channels)), "embodiment", "left")
    results = []
    for rule in rules:
        p = rule.params | (params or {})
        name = f"_{rule.rule_id}"
        if rule.facts is not None:
            found = rule.facts(t, p)
            wide = wide.join(found.select(EPISODE, F.struct(*[c for c in found.columns if c != EPISODE]).alias(name)), EPISODE, "left")
        results.append(_judged(rule, name, p))
    return wide, results


def evaluate_all(t: Tables, rules: list[Rule] | None = None, params: dict | None = None) -> DataFrame:
    """(episode_uid, rule_id, verdict, reason, metrics), one row per episode and rule."""
    wide, results = _beside(t, rules, params)
    if len(results) == 1:
        return wide.select(EPISODE, results[0].alias("r")).select(EPISODE, "r.*")
    return wide.select(EPISODE, F.inline(F.array(*results)))


def evaluate(t: Tables, rule: Rule, **params) -> DataFrame:
    """(episode_uid, rule_id, verdict, reason, metrics), one row per episode."""
    return evaluate_all(t, [rule], params)


def roll_up(episodes: DataFrame, results: DataFrame) -> DataFrame:
    """(episode_uid, qc_verdict) of every episode: FAIL before REVIEW and ERROR before PASS."""
    had = results.groupBy("episode_uid").agg(F.bool_or(F.col("verdict") == FAIL).alias("f"), F.bool_or(F.col("verdict").isin(REVIEW, ERROR)).alias("r"))
    return episodes.select("episode_uid").join(had, "episode_uid", "left").select("episode_uid", F.when(F.col("f"), FAIL).when(F.col("r"), REVIEW).otherwise(PASS).alias("qc_verdict"))


def roll_up_all(t: Tables, rules: list[Rule] | None = None, params: dict | None = None) -> DataFrame:
    """`roll_up` of `evaluate_all`, from the row in which an episode's facts stand side by side: results are not made into
    rows and grouped again, their reasons and metrics are not made, and episodes are read once less."""
    wide, results = _beside(t, rules, params)
    had = lambda *v: F.greatest(*[F.coalesce(r["verdict"].isin(*v), F.lit(False)) for r in results], F.lit(False), F.lit(False))
    return wide.select(EPISODE, F.when(had(FAIL), FAIL).when(had(REVIEW, ERROR), REVIEW).otherwise(PASS).alias("qc_verdict"))


def rule_by_id(rule_id: str) -> Rule:
    return next(r for r in RULES if r.rule_id == rule_id)
