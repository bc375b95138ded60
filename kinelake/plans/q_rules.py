"""Queries of the quality rules and time-series operators over the event stream and the order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelake.functions import signals as S
from kinelake.operators import long_episodes, stats
from kinelake.operators import rules as R
from kinelake.plans import surrogate as V
from kinelake.sources import segments, tfrecord
from kinelake.sources import vector_parquet as P

E = f"""
WITH e AS (SELECT CAST(user_id AS VARCHAR) AS uid, user_id AS u, event_type, value, ts, event_id,
       row_number() OVER w - 1 AS i, (epoch_us(ts) - first_value(epoch_us(ts)) OVER w) / 1e6 AS t
     FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
ep AS (SELECT uid, u, count(*) AS n, max(t) AS last_t FROM e GROUP BY uid, u),
dt AS (SELECT uid, u, i, t, t - lag(t) OVER (PARTITION BY uid ORDER BY i) AS dt FROM e),
steps AS (SELECT * FROM (SELECT uid, u, i, value, abs(CASE WHEN u % 2 = 1 THEN value ELSE value - lag(value) OVER (PARTITION BY uid ORDER BY i) END) AS step FROM e) WHERE i > 0)
"""
L = """
WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) AS uid, l_orderkey AS k, l_quantity AS q, l_discount AS d, l_tax AS x, l_returnflag AS f,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS i FROM lineitem),
ep AS (SELECT uid, k, count(*) AS n FROM l GROUP BY uid, k)
"""
ACTION_GATE = "CASE WHEN u % 7 = 0 THEN 'capability_unmet:has_action' WHEN u % 13 = 0 THEN 'action_level_is_episode_label' END"
CLOCK_GATE = "CASE WHEN u % 9 = 0 THEN 'synthetic_timestamp' END"


def rule_query(tables, rule_id: str, names: list[str], digits: int = 6, **params):
    def run(spark, sf_dir: str) -> DataFrame:
        out = R.evaluate(tables(spark, sf_dir), R.rule_by_id(rule_id), **params)
        gate = F.when((F.col("verdict") == R.SKIPPED) & (F.col("reason").startswith("capability") | F.col("reason").contains("level_is") | (F.col("reason") == "synthetic_timestamp")), F.col("reason"))
        return out.select("episode_uid", "verdict", gate.alias("gate"), *[F.round(F.try_element_at("metrics", F.lit(m)), digits).alias(m) for m in ["n_frames", *names]])

    return run


def rule_sql(ctes: str, gate: str, verdict: str, names: dict[str, str], source: str, n: str = "n", digits: int = 6) -> str:
    """One row per episode; values are null where the gate holds or the value is."""
    values = ", ".join(f"CASE WHEN gate IS NULL THEN round(CAST({v} AS DOUBLE), {digits}) END AS {k}" for k, v in names.items())
    return f"{ctes}, s AS ({source}), g AS (SELECT *, {gate} AS gate FROM s) SELECT uid AS episode_uid, CASE WHEN gate IS NOT NULL THEN 'SKIPPED' ELSE {verdict} END AS verdict, gate, CAST({n} AS DOUBLE) AS n_frames, {values} FROM g"


QUERIES: dict = {}


def add(name: str, run, sql: str | None) -> None:
    QUERIES[name] = (run, sql)


add("q_ts_monotonic", rule_query(V.event_tables, "TS_MONOTONIC", ["n_non_positive_dt", "n_non_finite_t", "min_dt", "median_dt", "max_dt"], 7), rule_sql(
    E, CLOCK_GATE, "CASE WHEN n >= 2 AND bad > 0 THEN 'FAIL' ELSE 'PASS' END",
    {"n_non_positive_dt": "bad", "n_non_finite_t": "CASE WHEN n >= 2 THEN 0 END", "min_dt": "lo", "median_dt": "mid", "max_dt": "hi"},
    "SELECT uid, u, count(*) AS n, count(*) FILTER (dt <= 0) AS bad, min(dt) AS lo, quantile_cont(dt, 0.5) AS mid, max(dt) AS hi FROM dt GROUP BY uid, u", digits=7,
))
_RATE = "(1.0::DOUBLE / 21600)"
add("q_fps_drift", rule_query(V.event_tables, "FPS_DRIFT", ["median_dt", "expected_dt", "fps_drift", "n_gaps", "gap_fraction", "max_dt"], 7), rule_sql(
    E, CLOCK_GATE, "CASE WHEN u % 8 = 0 OR m = 0 THEN 'SKIPPED' WHEN gaps / m > 0.01 THEN 'FAIL' WHEN drift > 0.05 OR gaps > 0 THEN 'REVIEW' ELSE 'PASS' END",
    {k: f"CASE WHEN u % 8 <> 0 AND m > 0 THEN {v} END" for k, v in {"median_dt": "mid", "expected_dt": "expected", "fps_drift": "drift", "n_gaps": "gaps", "gap_fraction": "gaps / m", "max_dt": "hi"}.items()},
    f"""SELECT *, abs(mid - expected) / expected AS drift FROM (SELECT uid, u, count(*) AS n, count(dt) AS m, any_value(mid) AS mid, max(dt) AS hi, 1.0::DOUBLE / {_RATE} AS expected,
        CASE WHEN any_value(mid) > 0 THEN count(*) FILTER (dt > 3.0 * mid) ELSE 0 END AS gaps
        FROM dt JOIN (SELECT uid AS uid2, quantile_cont(dt, 0.5) AS mid FROM dt GROUP BY uid) ON uid = uid2 GROUP BY uid, u)""", digits=7,
))
add("q_action_range", rule_query(V.line_tables, "ACTION_RANGE", ["n_non_finite", "n_out_of_range", "n_physical_channels"]), rule_sql(
    L, "NULL::VARCHAR", "CASE WHEN bad > 0 THEN 'FAIL' ELSE 'PASS' END", {"n_non_finite": "0", "n_out_of_range": "bad", "n_physical_channels": "2"},
    "SELECT uid, count(*) AS n, count(*) FILTER (q < 1 OR q > 48) + count(*) FILTER (d < 0 OR d > 0.09) AS bad FROM l GROUP BY uid",
))
add("q_action_range_downgraded", rule_query(V.event_tables, "ACTION_RANGE", ["n_non_finite", "n_out_of_range", "n_physical_channels"]), rule_sql(
    E, ACTION_GATE, "CASE WHEN bad = 0 THEN 'PASS' WHEN u % 2 = 1 THEN 'REVIEW' ELSE 'FAIL' END", {"n_non_finite": "0", "n_out_of_range": "bad", "n_physical_channels": "1"},
    "SELECT uid, u, count(*) AS n, count(*) FILTER (value < 0.02 OR value > 300) AS bad FROM e GROUP BY uid, u",
))
_JERK = """SELECT ep.uid, u, n, coalesce(j.k, 0) AS k, hits, ratio, alone FROM ep LEFT JOIN (
  SELECT uid, 1 AS k, count(*) FILTER (ratio > 1.0 AND alone > 2.0) AS hits, max(ratio) AS ratio, arg_max(alone, (ratio, -i)) AS alone FROM (
    SELECT uid, i, step / ref AS ratio, CASE WHEN len(near) = 0 THEN 1.0 WHEN mid <= 0 THEN CASE WHEN step > 0 THEN 1e9 ELSE 1.0 END ELSE least(step / mid, 1e9) END AS alone FROM (
      SELECT *, CAST(list_median(near) AS DOUBLE) AS mid FROM (
        SELECT s.uid, i, step, ref, list_concat(coalesce(list(step) OVER (PARTITION BY s.uid ORDER BY i ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING), []), coalesce(list(step) OVER (PARTITION BY s.uid ORDER BY i ROWS BETWEEN 2 FOLLOWING AND 5 FOLLOWING), [])) AS near
        FROM steps s JOIN (SELECT uid, quantile_cont(step, 0.99) AS ref, count(*) AS m FROM steps GROUP BY uid) r ON s.uid = r.uid WHERE m >= 20 AND ref > 0)))
  GROUP BY uid) j ON ep.uid = j.uid"""
add("q_action_jerk", rule_query(V.event_tables, "ACTION_JERK", ["jerk_ratio", "jerk_isolation", "n_jerks", "n_channels_examined"], 5, max_ratio=1.0, min_isolation=2.0), rule_sql(
    E, ACTION_GATE, "CASE WHEN k = 0 THEN 'SKIPPED' WHEN hits > 0 THEN 'REVIEW' ELSE 'PASS' END",
    {"jerk_ratio": "coalesce(ratio, 0)", "jerk_isolation": "coalesce(alone, 0)", "n_jerks": "coalesce(hits, 0)", "n_channels_examined": "k"}, _JERK, digits=5,
))
add("q_static_episode", rule_query(V.line_tables, "STATIC_EPISODE", ["still_fraction", "travel_fraction"], min_frames=3, max_still_fraction=0.4, min_travel_fraction=0.2), rule_sql(
    L, "NULL::VARCHAR", "CASE WHEN n < 3 OR coalesce(still > 0.4, false) OR coalesce(travel < 0.2, false) THEN 'FAIL' ELSE 'PASS' END", {"still_fraction": "still", "travel_fraction": "travel"},
    """SELECT uid, count(*) AS n, avg(CASE WHEN i > 0 THEN CAST(dq = 0 AND ds = 0 AND dd = 0 AS INT) END) AS still, greatest(sum(dq) / 47, sum(dd) / 0.09) AS travel FROM (
         SELECT uid, i, abs(q - lag(q) OVER w) AS dq, abs(d - lag(d) OVER w) AS dd, abs(s - lag(s) OVER w) AS ds FROM (SELECT *, q + CASE WHEN f = 'A' THEN 1.0 ELSE 0.0 END AS s FROM l) WINDOW w AS (PARTITION BY uid ORDER BY i)) GROUP BY uid""",
))
add("q_gripper_stuck", rule_query(V.event_tables, "GRIPPER_STUCK", ["n_gripper_channels", "min_unique_values", "min_gripper_travel"], 4), rule_sql(
    E, "CASE WHEN u % 7 = 0 THEN 'capability_unmet:has_action' WHEN u % 3 = 0 THEN 'capability_unmet:has_gripper' WHEN u % 13 = 0 THEN 'action_level_is_episode_label' END",
    "CASE WHEN n <= 50 THEN 'SKIPPED' WHEN (u % 2 = 0 AND kinds <= 1) OR (u % 2 = 1 AND way = 0) THEN 'REVIEW' ELSE 'PASS' END",
    {"n_gripper_channels": "1", "min_unique_values": "CASE WHEN u % 2 = 0 AND n > 50 THEN kinds END", "min_gripper_travel": "CASE WHEN u % 2 = 1 AND n > 50 THEN way END"},
    "SELECT uid, u, count(*) AS n, count(DISTINCT value) AS kinds, sum(abs(value)) AS way FROM e GROUP BY uid, u", digits=4,
))
add("q_state_action_echo", rule_query(V.line_tables, "STATE_ACTION_ECHO", ["echo_fraction", "max_abs_difference", "correlation"]), rule_sql(
    L, "CASE WHEN k % 10 = 0 THEN 'capability_unmet:has_state' END", "CASE WHEN echo > 0.9 THEN 'REVIEW' ELSE 'PASS' END", {"echo_fraction": "echo", "max_abs_difference": "far", "correlation": "c"},
    """SELECT uid, k, n, echo, far, CASE WHEN sa > 0 AND sb > 0 THEN cov / (sa * sb) ELSE 0 END AS c FROM (
         SELECT uid, k, count(*) AS n, avg(CAST(f <> 'A' AS INT)) AS echo, max(CASE WHEN f = 'A' THEN 1.0 ELSE 0.0 END) AS far FROM l GROUP BY uid, k)
       JOIN (SELECT uid AS uid2, stddev_pop(a) AS sa, stddev_pop(b) AS sb, covar_pop(a, b) AS cov FROM (
         SELECT uid, q AS a, q + CASE WHEN f = 'A' THEN 1.0 ELSE 0.0 END AS b FROM l UNION ALL SELECT uid, d, d FROM l) GROUP BY uid) ON uid = uid2""",
))
add("q_video_mismatch", rule_query(V.event_tables, "VIDEO_FRAME_MISMATCH", ["n_cameras", "n_missing", "n_measured", "n_mismatched", "max_frame_delta"]), rule_sql(
    E, "CASE WHEN u % 4 = 0 THEN 'capability_unmet:has_video' END", "CASE WHEN gone OR (measured AND u % 3 > 1) THEN 'FAIL' WHEN NOT measured THEN 'SKIPPED' ELSE 'PASS' END",
    {"n_cameras": "1", "n_missing": "CAST(gone AS INT)", "n_measured": "CAST(measured AS INT)", "n_mismatched": "CAST(measured AND u % 3 > 1 AS INT)", "max_frame_delta": "CASE WHEN measured THEN u % 3 ELSE 0 END"},
    "SELECT uid, u, n, u % 10 = 1 AS gone, u % 10 <> 1 AND u % 10 <> 2 AS measured FROM ep",
))
add("q_termination", rule_query(V.event_tables, "TERMINATION_CONSISTENCY", ["n_end_signals", "terminal_run", "n_interior_signals"]), rule_sql(
    E, "CASE WHEN u % 5 = 0 THEN 'capability_unmet:has_termination_signal' END", "CASE WHEN u % 12 = 5 THEN 'SKIPPED' WHEN k > run THEN 'FAIL' WHEN run = 0 OR run > 2 THEN 'REVIEW' ELSE 'PASS' END",
    {k: f"CASE WHEN u % 12 <> 5 THEN {v} END" for k, v in {"n_end_signals": "k", "terminal_run": "run", "n_interior_signals": "k - run"}.items()},
    "SELECT uid, u, count(*) AS n, count(*) FILTER (event_type = 'error') AS k, count(*) - 1 - coalesce(max(i) FILTER (event_type <> 'error'), -1) AS run FROM e GROUP BY uid, u",
))
_GAP = """SELECT ep.uid, u, n, part, holes, coalesce(gap, 0) AS gap FROM ep JOIN (SELECT uid, avg(CAST(event_type <> 'error' AS INT)) AS part, count(*) FILTER (event_type = 'error') AS holes FROM e GROUP BY uid) c ON ep.uid = c.uid
  LEFT JOIN (SELECT uid, max(stop - start) AS gap FROM (SELECT uid, min(t) AS start, coalesce(any_value(nxt), any_value(last_t)) AS stop FROM (
     SELECT e.uid, e.t, e.i, e.i - row_number() OVER (PARTITION BY e.uid ORDER BY e.i) AS island, last_t, (SELECT min(p.t) FROM e p WHERE p.uid = e.uid AND p.i > e.i AND p.event_type <> 'error') AS nxt
     FROM e JOIN ep ON e.uid = ep.uid WHERE e.event_type = 'error') GROUP BY uid, island) GROUP BY uid) g ON ep.uid = g.uid"""
add("q_pose_coverage_gap", rule_query(V.event_tables, "POSE_COVERAGE", ["pose_coverage", "longest_gap_s", "n_unregistered"], 7, max_gap_s=200000.0), rule_sql(
    E, "CASE WHEN u % 6 = 0 THEN 'capability_unmet:has_camera_pose' END", "CASE WHEN part < 0.8 OR gap > 200000 THEN 'REVIEW' ELSE 'PASS' END", {"pose_coverage": "part", "longest_gap_s": "gap", "n_unregistered": "holes"}, _GAP, digits=7,
))
_SEG = """SELECT *, CASE WHEN d > 0 THEN greatest(prev, nxt) / d ELSE 0 END AS part FROM (SELECT *, e1 - s0 AS d, greatest(coalesce(p1 - s0, 0), 0) AS prev, greatest(coalesce(e1 - x0, 0), 0) AS nxt FROM (
  SELECT uid, u, n, u % 17 = 3 AS none, CAST(u % 5 - CASE WHEN u % 19 = 0 THEN 6 ELSE 0 END AS DOUBLE) AS s0, u % 5 + n / 40.0::DOUBLE AS e1, CASE WHEN u % 3 <> 0 THEN u % 5 + 0.25::DOUBLE END AS p1,
    CASE WHEN u % 4 <> 0 THEN u % 5 + n / 40.0::DOUBLE - u % 2 END AS x0, CASE WHEN u % 7 <> 2 THEN 6.0 END AS parent FROM ep))"""
add("q_segment_bounds", rule_query(V.event_tables, "SEGMENT_BOUNDS", ["segment_duration_s", "overlap_prev_s", "overlap_next_s", "overlap_fraction"]), rule_sql(
    E, "CASE WHEN u % 11 = 0 THEN 'capability_unmet:is_segment' END", "CASE WHEN none THEN 'SKIPPED' WHEN d <= 0 OR s0 < 0 OR coalesce(e1 > parent, false) THEN 'FAIL' WHEN d < 0.4 OR part > 0.5 THEN 'REVIEW' ELSE 'PASS' END",
    {k: f"CASE WHEN NOT none THEN {v} END" for k, v in {"segment_duration_s": "d", "overlap_prev_s": "prev", "overlap_next_s": "nxt", "overlap_fraction": "part"}.items()}, _SEG,
))


def gate_reasons(spark, sf_dir):
    t = V.event_tables(spark, sf_dir)
    e = t.episodes
    each = None
    for rule in R.RULES:
        one = e.select(F.lit(rule.rule_id).alias("rule_id"), R.gate(rule).alias("reason"))
        each = one if each is None else each.unionByName(one)
    return each.filter("reason IS NOT NULL").groupBy("rule_id", "reason").agg(F.count(F.lit(1)).alias("n"))


_GATES = {
    "TS_MONOTONIC": CLOCK_GATE, "FPS_DRIFT": CLOCK_GATE, "ACTION_RANGE": ACTION_GATE, "ACTION_JERK": ACTION_GATE,
    "GRIPPER_STUCK": "CASE WHEN u % 7 = 0 THEN 'capability_unmet:has_action' WHEN u % 3 = 0 THEN 'capability_unmet:has_gripper' WHEN u % 13 = 0 THEN 'action_level_is_episode_label' END",
    "STATE_ACTION_ECHO": ACTION_GATE, "VIDEO_FRAME_MISMATCH": "CASE WHEN u % 4 = 0 THEN 'capability_unmet:has_video' END",
    "TERMINATION_CONSISTENCY": "CASE WHEN u % 5 = 0 THEN 'capability_unmet:has_termination_signal' END", "POSE_COVERAGE": "CASE WHEN u % 6 = 0 THEN 'capability_unmet:has_camera_pose' END",
    "SEGMENT_BOUNDS": "CASE WHEN u % 11 = 0 THEN 'capability_unmet:is_segment' END",
}
add("q_gate_reasons", gate_reasons, f"{E} SELECT rule_id, reason, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS rule_id, {v} AS reason FROM ep" for k, v in _GATES.items()) + ") WHERE reason IS NOT NULL GROUP BY ALL")


def rollup(spark, sf_dir):
    """Over all eleven rules."""
    return R.roll_up_all(V.event_tables(spark, sf_dir))


# The verdicts of all rules with their own parameters, over the event stream
_STILL = """SELECT uid, u, count(*) AS n, avg(CASE WHEN i > 0 AND (u % 13 <> 0 OR sc IS NOT NULL) THEN CAST((u % 13 = 0 OR sv = 0) AND coalesce(sc = 0, true) AS INT) END) AS still, CASE WHEN u % 13 <> 0 THEN sum(sv) / 299.98 END AS travel FROM (
  SELECT uid, u, i, CASE WHEN i > 0 THEN abs(CASE WHEN u % 2 = 1 THEN value ELSE value - lag(value) OVER w END) END AS sv, abs(cam - lag(cam) OVER w) AS sc
  FROM (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS cam FROM e) WINDOW w AS (PARTITION BY uid ORDER BY i)) GROUP BY uid, u"""
_FROZEN = "coalesce(still > 0.95, false) OR coalesce(travel < 0.05, false)"
_VERDICTS = {
    "TS_MONOTONIC": QUERIES["q_ts_monotonic"][1], "FPS_DRIFT": QUERIES["q_fps_drift"][1], "ACTION_RANGE": QUERIES["q_action_range_downgraded"][1],
    "ACTION_JERK": rule_sql(E, ACTION_GATE, "CASE WHEN k = 0 THEN 'SKIPPED' WHEN hits > 0 THEN 'REVIEW' ELSE 'PASS' END", {"k": "k"}, _JERK.replace("ratio > 1.0 AND alone > 2.0", "ratio > 8.0 AND alone > 5.0")),
    # what an odd user's episode reads is estimated; its state has no limits
    "STATIC_EPISODE": rule_sql(E, "NULL::VARCHAR", f"CASE WHEN n < 20 THEN 'FAIL' WHEN {_FROZEN} THEN CASE WHEN u % 2 = 1 THEN 'REVIEW' ELSE 'FAIL' END ELSE 'PASS' END", {"still": "still"}, _STILL),
    "GRIPPER_STUCK": QUERIES["q_gripper_stuck"][1],
    # spaces of action and state differ, so that nothing is compared
    "STATE_ACTION_ECHO": f"{E} SELECT uid AS episode_uid, 'SKIPPED' AS verdict FROM ep",
    "VIDEO_FRAME_MISMATCH": QUERIES["q_video_mismatch"][1], "TERMINATION_CONSISTENCY": QUERIES["q_termination"][1],
    "POSE_COVERAGE": rule_sql(E, "CASE WHEN u % 6 = 0 THEN 'capability_unmet:has_camera_pose' END", "CASE WHEN part < 0.8 OR gap > 0.5 THEN 'REVIEW' ELSE 'PASS' END", {"part": "part"}, _GAP),
    "SEGMENT_BOUNDS": QUERIES["q_segment_bounds"][1],
}
_RESULTS = " UNION ALL ".join(f"SELECT episode_uid, '{k}' AS rule_id, verdict FROM ({v})" for k, v in _VERDICTS.items())
add("q_rule_results", lambda s, d: R.evaluate_all(V.event_tables(s, d)).select("episode_uid", "rule_id", "verdict"), _RESULTS)
add("q_rollup", rollup, f"WITH r AS ({_RESULTS}) SELECT episode_uid, CASE WHEN bool_or(verdict = 'FAIL') THEN 'FAIL' WHEN bool_or(verdict IN ('REVIEW', 'ERROR')) THEN 'REVIEW' ELSE 'PASS' END AS qc_verdict FROM r GROUP BY episode_uid")

_STATS = "count(*) AS count, count(*) FILTER (v IS NULL) AS n_nan, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, min(v) AS min, max(v) AS max, round(quantile_cont(v, 0.01), 6) AS p1, round(quantile_cont(v, 0.99), 6) AS p99"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p1", "p99")})


add("q_channel_stats", lambda s, d: _rounded(stats.channel_stats(V.event_tables(s, d).samples)),
    f"{E} SELECT uid AS episode_uid, signal, channel, {_STATS} FROM (SELECT uid, 'action' AS signal, 'value' AS channel, value AS v FROM e UNION ALL SELECT uid, 'state', 'cam', CASE WHEN event_type <> 'error' THEN value END FROM e) GROUP BY ALL")


def vector_unpack(spark, sf_dir):
    v = V.table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("pos", "value"))
    return _rounded(v.groupBy("label", "pos").agg(*S.summary("value")))


add("q_vector_unpack", vector_unpack, f"SELECT label, CAST(pos AS INT) AS pos, {_STATS} FROM (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(0, len(embedding))) AS pos FROM embeddings) GROUP BY label, pos")


def recorded(spark, sf_dir) -> DataFrame:
    """Events as frames of a vector dataset: timestamp, index."""
    f = V.event_frames(spark, sf_dir)
    return f.select("episode_uid", "user_id", F.col("t").alias("timestamp"), F.col("frame_idx").alias("index"), F.col("frame_idx").alias("frame_index"), (F.col("event_type") == "click").alias("next.success"))


def effective_fps(spark, sf_dir):
    return P.effective_fps(recorded(spark, sf_dir), F.lit(V.RATE)).withColumn("fps", F.round("fps", 10))


add("q_effective_fps", effective_fps, f"{E} SELECT uid AS episode_uid, round(CASE WHEN mid > 0 THEN 1.0 / mid ELSE {_RATE} END, 10) AS fps FROM (SELECT uid, quantile_cont(dt, 0.5) AS mid FROM dt GROUP BY uid)")


def clock_test(spark, sf_dir):
    """Is a clock exactly frame / rate in single precision? Every third user's clock is made so."""
    made = (F.col("frame_index") / F.lit(10.0)).cast("float")
    return P.timestamp_source(recorded(spark, sf_dir).withColumn("timestamp", F.when(F.col("user_id") % 3 == 0, made).otherwise(F.col("timestamp").cast("float"))), 10)


add("q_clock_test", clock_test, f"{E} SELECT uid AS episode_uid, CASE WHEN bool_and(CASE WHEN u % 3 = 0 THEN CAST(i / 10.0::DOUBLE AS FLOAT) ELSE CAST(t AS FLOAT) END = CAST(i / 10.0::DOUBLE AS FLOAT)) THEN 'synthesized@10Hz' ELSE 'real' END AS timestamp_source FROM e GROUP BY uid")
add("q_boundary", lambda s, d: P.boundary(recorded(s, d)).select("episode_uid", "success", "adjudicator"), "SELECT CAST(user_id AS VARCHAR) AS episode_uid, bool_or(event_type = 'click') AS success, 'environment' AS adjudicator FROM events GROUP BY user_id")


def rebased(spark, sf_dir):
    """Time since a user's first event, by the events' own numbers."""
    e = V.table(spark, sf_dir, "events").select("user_id", "event_id", V.micros("ts").alias("us"))
    return e.select("event_id", S.rebased(F.col("us"), ["user_id"], "event_id").alias("since"))


add("q_rebased", rebased, "SELECT event_id, epoch_us(ts) - first_value(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY event_id) AS since FROM events")


def steps_of(spark, sf_dir) -> DataFrame:
    """Users as records: of every step whether it is last (an error) and its pose, which stands still below 50."""
    f = V.event_frames(spark, sf_dir)
    step = F.struct("frame_idx", (F.col("event_type") == "error").cast("double").alias("last"), F.array(F.when(F.col("value") < 50, 0.0).otherwise(F.col("value"))).alias("pose"), (F.col("event_type") == "click").cast("double").alias("end"))
    return f.groupBy("episode_uid").agg(F.sort_array(F.collect_list(step)).alias("s")).select("episode_uid", "s.last", "s.pose", "s.end")


def trim_tail(spark, sf_dir):
    """Steps kept when the trailing run of last steps that stand still is padding."""
    return steps_of(spark, sf_dir).select("episode_uid", tfrecord.kept_steps(F.col("last"), F.col("pose")).cast("long").alias("n_kept"), F.size("last").cast("long").alias("n_frames"))


add("q_trim_tail", trim_tail, f"{E} SELECT uid AS episode_uid, CAST(coalesce(max(i + 1) FILTER (NOT (event_type = 'error' AND value < 50)), 0) AS BIGINT) AS n_kept, count(*) AS n_frames FROM e GROUP BY uid")
add("q_record_boundary", lambda s, d: steps_of(s, d).select("episode_uid", tfrecord.boundary(F.col("last"), F.col("end")).alias("truncated")), "SELECT CAST(user_id AS VARCHAR) AS episode_uid, bool_or(event_type = 'error') AND NOT bool_or(event_type = 'click') AS truncated FROM events GROUP BY user_id")


def neighbours(spark, sf_dir):
    f = V.event_frames(spark, sf_dir).select(F.col("user_id").alias("video_id"), "event_id", F.col("event_id").alias("file_pos"), F.col("us").alias("start_s"), (F.col("us") + (F.col("value") * 1e9).cast("long")).alias("stop_s"))
    return segments.with_neighbours(f).select("event_id", F.col("prev_end_s").alias("prev_stop"), F.col("next_start_s").alias("next_start"))


add("q_neighbours", neighbours, "SELECT event_id, lag(stop) OVER w AS prev_stop, lead(start) OVER w AS next_start FROM (SELECT user_id, event_id, epoch_us(ts) AS start, epoch_us(ts) + CAST(trunc(value * 1e9) AS BIGINT) AS stop FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY start, event_id)")


def span_by_unit(spark, sf_dir):
    """The largest span over channels of each unit."""
    t = V.line_tables(spark, sf_dir)
    span = t.samples.join(F.broadcast(t.channels.select("embodiment", "signal", "channel", "unit")), ["embodiment", "signal", "channel"]).groupBy("episode_uid", "unit", "signal", "channel").agg((F.max("value") - F.min("value")).alias("span"))
    return span.groupBy("episode_uid", "unit").agg(F.round(F.max("span"), 6).alias("span"))


add("q_span_by_unit", span_by_unit, f"{L} SELECT uid AS episode_uid, unit, round(max(span), 6) AS span FROM (SELECT uid, 'px' AS unit, max(q) - min(q) AS span FROM l GROUP BY uid UNION ALL SELECT uid, 'px', max(s) - min(s) FROM (SELECT uid, q + CASE WHEN f = 'A' THEN 1.0 ELSE 0.0 END AS s FROM l) GROUP BY uid UNION ALL SELECT uid, 'normalized', max(d) - min(d) FROM l GROUP BY uid UNION ALL SELECT uid, 'normalized', max(x) - min(x) FROM l GROUP BY uid) GROUP BY uid, unit")


def travel(spark, sf_dir):
    """Path length over present values alone: holes are dropped before differences are taken."""
    f = V.event_frames(spark, sf_dir).filter("event_type <> 'error'")
    d = f.select("episode_uid", F.abs(S.difference("value", S.ordered("episode_uid"))).alias("d"))
    return d.groupBy("episode_uid").agg(F.round(F.coalesce(F.sum("d"), F.lit(0.0)), 4).alias("travel"))


add("q_travel_present", travel, f"{E} SELECT uid AS episode_uid, round(coalesce(sum(d), 0), 4) AS travel FROM (SELECT uid, abs(value - lag(value) OVER (PARTITION BY uid ORDER BY i)) AS d FROM e WHERE event_type <> 'error') GROUP BY uid")


def step_ratios(spark, sf_dir):
    t = V.event_frames(spark, sf_dir).withColumn("step", F.abs(S.difference("value", S.ordered("episode_uid")))).filter("step IS NOT NULL")
    p = lambda q: F.percentile("step", F.lit(q))
    a = t.groupBy("episode_uid").agg(F.max("step").alias("m"), p(0.5).alias("p50"), p(0.99).alias("p99"), p(0.999).alias("p999"))
    return a.select("episode_uid", *[F.round(F.try_divide("m", c), 4).alias(f"max_over_{c}") for c in ("p50", "p99", "p999")])


add("q_step_ratios", step_ratios, f"{E} SELECT uid AS episode_uid, round(m / nullif(p50, 0), 4) AS max_over_p50, round(m / nullif(p99, 0), 4) AS max_over_p99, round(m / nullif(p999, 0), 4) AS max_over_p999 FROM (SELECT uid, max(step) AS m, quantile_cont(step, 0.5) AS p50, quantile_cont(step, 0.99) AS p99, quantile_cont(step, 0.999) AS p999 FROM (SELECT uid, abs(value - lag(value) OVER (PARTITION BY uid ORDER BY i)) AS step FROM e) WHERE step IS NOT NULL GROUP BY uid)")


def bit_equal(spark, sf_dir):
    t = V.line_tables(spark, sf_dir).samples
    cell = t.groupBy("episode_uid", "frame_idx", "channel").agg(F.max(F.when(F.col("signal") == "action", F.col("value"))).alias("a"), F.max(F.when(F.col("signal") == "state", F.col("value"))).alias("s"))
    return cell.filter("a IS NOT NULL AND s IS NOT NULL").groupBy("episode_uid").agg(F.round(F.avg((F.col("a") == F.col("s")).cast("int")), 6).alias("equal_fraction"))


add("q_bit_equal", bit_equal, f"{L} SELECT uid AS episode_uid, round(avg(x), 6) AS equal_fraction FROM (SELECT uid, CAST(f <> 'A' AS INT) AS x FROM l UNION ALL SELECT uid, 1 FROM l) GROUP BY uid")


def termination_patterns(spark, sf_dir):
    """How often an episode ends on a marker, and how many are before its last frame."""
    f = V.event_frames(spark, sf_dir).withColumn("m", (F.col("event_type") == "error").cast("int"))
    a = f.groupBy("episode_uid").agg(F.max_by("m", "frame_idx").alias("last"), F.sum("m").alias("k"))
    return a.groupBy("last", (F.col("k") - F.col("last")).alias("n_mid")).agg(F.count(F.lit(1)).alias("n"))


add("q_termination_patterns", termination_patterns, f"{E} SELECT last, n_mid, count(*) AS n FROM (SELECT uid, arg_max(CAST(event_type = 'error' AS INT), i) AS last, CAST(sum(CAST(event_type = 'error' AS INT)) AS BIGINT) - arg_max(CAST(event_type = 'error' AS INT), i) AS n_mid FROM e GROUP BY uid) GROUP BY ALL")


def marker_offsets(spark, sf_dir):
    f = V.event_frames(spark, sf_dir)
    n = F.count(F.lit(1)).over(Window.partitionBy("episode_uid"))
    off = f.withColumn("offset", n - 1 - F.col("frame_idx")).filter("event_type = 'error'")
    return off.groupBy("episode_uid").agg(F.array_join(F.sort_array(F.collect_list("offset")), ",").alias("offsets"))


add("q_marker_offsets", marker_offsets, f"{E} SELECT e.uid AS episode_uid, string_agg(CAST(n - 1 - i AS VARCHAR), ',' ORDER BY n - 1 - i) AS offsets FROM e JOIN ep ON e.uid = ep.uid WHERE event_type = 'error' GROUP BY e.uid")


def segment_overlap(spark, sf_dir):
    """Neighbouring intervals whose overlap is over half of the shorter one, per user."""
    w = Window.partitionBy("user_id").orderBy("us", "event_id")
    f = V.event_frames(spark, sf_dir).select("user_id", "event_id", F.col("us").alias("us"), (F.col("value") * 2000).alias("len"), (F.col("us") / 1e6).alias("s"))
    nxt = f.withColumn("s2", F.lead("s").over(w)).withColumn("len2", F.lead("len").over(w)).filter("s2 IS NOT NULL")
    common, shorter = F.least(F.col("s") + F.col("len"), F.col("s2") + F.col("len2")) - F.greatest("s", "s2"), F.least("len", "len2")
    over = S.ieee_quotient(common, shorter)  # of empty intervals too, as SQL has it
    return nxt.groupBy("user_id").agg(F.count_if(over > 0.5).alias("n_over_half"), F.count_if(over > 0).alias("n_overlap"), F.count(F.lit(1)).alias("n_pairs"))


add("q_segment_overlap_sym", segment_overlap, "SELECT user_id, count(*) FILTER (x > 0.5) AS n_over_half, count(*) FILTER (x > 0) AS n_overlap, count(*) AS n_pairs FROM (SELECT user_id, (least(s + len, s2 + len2) - greatest(s, s2)) / least(len, len2) AS x FROM (SELECT *, lead(s) OVER w AS s2, lead(len) OVER w AS len2 FROM (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS s, value * 2000 AS len FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id)) WHERE s2 IS NOT NULL) GROUP BY user_id")


def constant_channels(spark, sf_dir):
    t = V.line_tables(spark, sf_dir)
    nd = t.samples.filter("signal = 'action'").groupBy("episode_uid", "channel").agg(F.count_distinct("value").alias("kinds"))
    return nd.groupBy("channel").agg(F.count_if(F.col("kinds") == 1).alias("n_constant"), F.count(F.lit(1)).alias("n"))


add("q_constant_channels", constant_channels, f"{L} SELECT channel, count(*) FILTER (k = 1) AS n_constant, count(*) AS n FROM (SELECT 'quantity' AS channel, count(DISTINCT q) AS k FROM l GROUP BY uid UNION ALL SELECT 'discount', count(DISTINCT d) FROM l GROUP BY uid UNION ALL SELECT 'tax', count(DISTINCT x) FROM l GROUP BY uid) GROUP BY channel")


def _parts(spark, sf_dir) -> DataFrame:
    return V.event_frames(spark, sf_dir).select("episode_uid", "frame_idx", "t", (F.col("event_type") != "click").alias("here"))


def long_clock(spark, sf_dir):
    """Clock facts of users as episodes, in parts of 64 frames."""
    return long_episodes.clock(_parts(spark, sf_dir), size=64).withColumns({c: F.round(c, 7) for c in ("lo", "mid", "hi")})


add("q_long_clock", long_clock, f"""{E}, m AS (SELECT uid AS uid2, quantile_cont(dt, 0.5) AS mid FROM dt GROUP BY uid)
SELECT uid AS episode_uid, count(*) AS n, count(*) FILTER (dt <= 0) AS bad, CAST(0 AS BIGINT) AS holes, round(min(dt), 7) AS lo, round(any_value(mid), 7) AS mid, round(max(dt), 7) AS hi, count(dt) AS n_dt, count(*) FILTER (mid > 0 AND dt > 3.0 * mid) AS gaps FROM dt JOIN m ON uid = uid2 GROUP BY uid""")


def long_gaps(spark, sf_dir):
    """Runs of clicks as gaps, in parts of 64 frames."""
    return long_episodes.pose_coverage(_parts(spark, sf_dir), "here", size=64).withColumns({c: F.round(c, 6) for c in ("part", "gap")})


add("q_long_gaps", long_gaps, f"""{E}, h AS (SELECT uid, i, t, event_type <> 'click' AS here FROM e),
g AS (SELECT uid, here, NOT here AND coalesce(lag(here) OVER a, true) AS starts, t, coalesce(min(CASE WHEN here THEN t END) OVER b, max(t) OVER b) AS nxt FROM h WINDOW a AS (PARTITION BY uid ORDER BY i), b AS (PARTITION BY uid ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT uid AS episode_uid, round(avg(CAST(here AS INT)), 6) AS part, count(*) FILTER (NOT here) AS holes, round(coalesce(max(CASE WHEN starts THEN nxt - t END), 0.0), 6) AS gap FROM g GROUP BY uid""")
