"""The canonical tables as views over the star schema and the event stream.

events: an episode is a user, a frame an event, with the value as action and, unless the event is an error, as an
estimated or measured camera pose. lineitem: an episode is an order, a frame a line, with price as action and quantity
times a factor as state. Both are plain projections, so that filters and columns reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.operators.order import spread
from kinelake.operators.rules import CAMERA, CHANNEL, CONTINUOUS, Tables

#: Declared rate of the event stream's episodes: one event in six hours.
RATE = 1 / 21600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: Column | str) -> Column:
    """Microseconds of a timestamp without zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST({ts} AS TIMESTAMP_NTZ))")


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt out by the uid itself, so that whatever is by episode later finds its rows in place
    w = Window.partitionBy("episode_uid").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props").withColumn("episode_uid", F.col("user_id").cast("string"))
    e = e.withColumn("frame_idx", F.row_number().over(w) - 1).withColumn("us", micros("ts"))
    return e.withColumn("t", (F.col("us") - F.first("us").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))) / 1e6)


def event_embodiment(user: Column) -> Column:
    return F.when(user % 2 == 0, "even").otherwise("odd")


def event_tables(spark: SparkSession, sf_dir: str) -> Tables:
    f = event_frames(spark, sf_dir)
    user = F.col("user_id")
    n = F.col("n_frames")
    caps = F.struct(
        (user % 7 != 0).alias("has_action"), F.lit(True).alias("has_state"), (user % 3 != 0).alias("has_gripper"), (user % 4 != 0).alias("has_video"),
        (user % 5 != 0).alias("has_termination_signal"), (user % 6 != 0).alias("has_camera_pose"), (user % 11 != 0).alias("is_segment"),
    )
    episodes = f.groupBy("episode_uid", "user_id").agg(F.count(F.lit(1)).alias("n_frames"), F.max("t").alias("last_t")).select(
        "episode_uid", "user_id", event_embodiment(user).alias("embodiment"), F.when(user % 8 != 0, F.lit(RATE)).alias("fps_nominal"),
        F.when(user % 9 == 0, "synthesized@10Hz").otherwise("real").alias("timestamp_source"), "n_frames", caps.alias("capabilities"),
        F.when(user % 13 == 0, "episode_label").otherwise(CONTINUOUS).alias("action_level"), F.lit(CONTINUOUS).alias("state_level"),
        F.array(
            F.struct(F.lit("main").alias("name"), F.lit("mp4_sidecar").alias("encoding"), (user % 10 != 1).alias("is_present"), F.when(user % 10 != 2, n + user % 3).alias("n_frames")),
            F.struct(F.lit("side").alias("name"), F.lit("inline").alias("encoding"), F.lit(True).alias("is_present"), F.lit(0).cast("long").alias("n_frames")),
        ).cast(CAMERA).alias("cameras"),
        F.when(user % 12 != 5, F.lit("error")).alias("termination_column"),
        F.when(user % 17 != 3, F.struct(
            (user % 5 - F.when(user % 19 == 0, 6).otherwise(0)).cast("double").alias("start_s"), (user % 5 + n / 40).cast("double").alias("end_s"),
            F.when(user % 3 != 0, user % 5 + 0.25).cast("double").alias("prev_end_s"), F.when(user % 4 != 0, user % 5 + n / 40 - user % 2).cast("double").alias("next_start_s"),
            F.when(user % 7 != 2, F.lit(6.0)).alias("parent_duration_s"),
        )).alias("segment"),
    )
    rows = []
    for e, delta, origin in (("even", False, "measured"), ("odd", True, "estimated")):
        rows.append((e, "action", "value", 0, True, delta, 0.02, 300.0, "cartesian_2d", "gripper", origin, "px", 0))
        rows.append((e, "action", "flag", 1, False, False, None, None, "flag", "control_flag", origin, None, None))
        rows.append((e, "state", "cam", 0, True, False, None, None, "camera_translation_abs", "unknown", origin, "m", 0))
    channels = spark.createDataFrame(rows, CHANNEL)
    base = f.withColumn("embodiment", event_embodiment(user))
    cell = F.array(
        F.struct(F.lit("action").alias("signal"), F.lit("value").alias("channel"), F.col("value").alias("value")),
        F.struct(F.lit("state").alias("signal"), F.lit("cam").alias("channel"), F.when(F.col("event_type") != "error", F.col("value")).alias("value")),
    )
    samples = base.select("episode_uid", "embodiment", "frame_idx", "t", F.inline(cell))
    frames = f.select("episode_uid", "frame_idx", "t", F.create_map(F.lit("error"), (F.col("event_type") == "error").cast("double")).alias("raw"))
    return Tables(episodes, channels, samples, frames)


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def line_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("episode_uid").orderBy(*LINE_ORDER)
    columns = ["l_orderkey", *LINE_ORDER, "l_quantity", "l_discount", "l_tax", "l_returnflag"]
    lines = table(spark, sf_dir, "lineitem").select(*columns).withColumn("episode_uid", F.col("l_orderkey").cast("string"))
    return spread(lines, lines.count(), "episode_uid").withColumn("frame_idx", F.row_number().over(w) - 1)


def line_tables(spark: SparkSession, sf_dir: str) -> Tables:
    f = line_frames(spark, sf_dir)
    key = F.col("episode_uid").cast("long")
    caps = F.struct(F.lit(True).alias("has_action"), (key % 10 != 0).alias("has_state"), F.lit(True).alias("has_gripper"))
    episodes = f.groupBy("episode_uid").agg(F.count(F.lit(1)).alias("n_frames")).select(
        "episode_uid", F.lit("order").alias("embodiment"), F.lit(None).cast("double").alias("fps_nominal"), F.lit("real").alias("timestamp_source"), "n_frames", caps.alias("capabilities"),
        F.lit(CONTINUOUS).alias("action_level"), F.lit(CONTINUOUS).alias("state_level"), F.lit(None).cast(CAMERA).alias("cameras"), F.lit(None).cast("string").alias("termination_column"),
    )
    rows = [
        ("order", "action", "quantity", 0, True, False, 1.0, 48.0, "cartesian_2d", "end_effector", "measured", "px", 0),
        ("order", "action", "discount", 1, True, False, 0.0, 0.09, "cartesian_2d", "end_effector", "measured", "normalized", 1),
        ("order", "action", "tax", 2, False, False, 0.0, 0.01, "flag", "gripper", "measured", "normalized", None),
        ("order", "state", "quantity", 0, True, False, None, None, "cartesian_2d", "unknown", "measured", "px", 0),
        ("order", "state", "discount", 1, True, False, None, None, "cartesian_2d", "unknown", "measured", "normalized", 1),
    ]
    moved = F.when(F.col("l_returnflag") == "A", 1.0).otherwise(0.0)
    cell = F.array(*[F.struct(F.lit(s).alias("signal"), F.lit(c).alias("channel"), v.alias("value")) for s, c, v in (
        ("action", "quantity", F.col("l_quantity")), ("action", "discount", F.col("l_discount")), ("action", "tax", F.col("l_tax")),
        ("state", "quantity", F.col("l_quantity") + moved), ("state", "discount", F.col("l_discount")),
    )])
    samples = f.select("episode_uid", F.lit("order").alias("embodiment"), "frame_idx", F.col("frame_idx").cast("double").alias("t"), F.inline(cell))
    frames = f.select("episode_uid", "frame_idx", F.col("frame_idx").cast("double").alias("t"), F.create_map(F.lit("tax"), F.col("l_tax")).alias("raw"))
    return Tables(episodes, spark.createDataFrame(rows, CHANNEL), samples, frames)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as catalog rows: frames are lines, the embodiment is the customer's region, the task their segment."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_frames"))
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    o = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("o_orderkey")
    return o.select(
        key.cast("string").alias("episode_uid"), F.concat(F.lit("s"), (key % 3).cast("string")).alias("source_id"), F.when(key % 11 != 0, F.col("r_name")).alias("embodiment"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("task"), F.coalesce("n_frames", F.lit(0)).alias("n_frames"), (F.col("o_totalprice") / 1000).alias("duration_s"),
        F.when(F.col("o_orderstatus") == "F", "PASS").when(F.col("o_orderstatus") == "O", "REVIEW").otherwise("FAIL").alias("qc_verdict"),
        F.element_at(F.array(*map(F.lit, ("DISCOVERED", "FETCHED", "NORMALIZED", "QC_DONE", "COMMITTED", "COMMITTED", "FAILED"))), (key % 7 + 1).cast("int")).alias("status"),
        F.when(key % 13 != 0, key.cast("string")).alias("content_hash"), F.when(key % 5 != 0, "1.1").otherwise("1.0").alias("schema_version"),
        F.when(key % 4 != 0, "a@2").otherwise("a@1").alias("adapter_version"), F.when(key % 6 != 0, "2.1").otherwise("2.0").alias("ruleset_version"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as recorded results: a user's result of a rule (the event's type) at a time, with the event's props."""
    e = table(spark, sf_dir, "events")
    verdict = F.element_at(F.array(*map(F.lit, ("PASS", "PASS", "REVIEW", "FAIL", "SKIPPED", "ERROR"))), (F.col("event_id") % 6 + 1).cast("int"))
    return e.select(
        F.col("user_id").cast("string").alias("episode_uid"), F.col("event_type").alias("rule_id"), F.concat(F.lit("run"), (F.col("event_id") % 4).cast("string")).alias("run_id"), F.col("ts").alias("created_at"), F.col("event_id").alias("seq"),
        verdict.alias("verdict"), F.when(verdict == "SKIPPED", F.element_at(F.array(F.lit("short"), F.lit(""), F.lit(None)), (F.col("event_id") % 3 + 1).cast("int"))).alias("reason"),
        F.map_concat(F.from_json("props", "map<string,double>"), F.create_map(F.lit("value"), F.col("value"))).alias("metrics"),
    )


def result_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "events").select("user_id").distinct()
    return u.select(F.col("user_id").cast("string").alias("episode_uid"), F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string")).alias("source_id"))
