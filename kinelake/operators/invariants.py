"""Invariants of the canonical tables as queries: each gives (invariant, subject, detail) rows, none if all is well.

Numbers are those of the survey's list. Checks of one table are one pass of predicates; checks across tables are anti
joins on distinct keys, which stay as small as the declared channels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.operators.history import bad_transitions
from kinelake.operators.rules import CONTINUOUS, GRIPPER, ROTATIONS

# Vocabularies of clocks and frame numbers.
CLOCKS = ("real", "annotation_seconds")
SYNTHESIZED = r"^synthesized@[0-9]+(\.[0-9]+)?Hz$"
DERIVED = r"^derived_from_seconds@[0-9]+(\.[0-9]+)?$"


def _broken(df: DataFrame, subject: str, checks: dict[int | str, tuple[Column, str]]) -> DataFrame:
    """Rows for every check whose predicate holds; a NULL predicate does not."""
    found = F.filter(F.array(*[F.when(p, F.struct(F.lit(str(k)).alias("invariant"), F.lit(d).alias("detail"))) for k, (p, d) in checks.items()]), lambda x: x.isNotNull())
    each = df.select(F.col(subject).alias("subject"), F.explode(found).alias("x"))
    return each.select("x.invariant", "subject", "x.detail")


def episode_checks(episodes: DataFrame) -> DataFrame:
    """Row-wise ones: those whose columns the table has."""
    has = set(episodes.columns)
    c, cap = F.col, lambda n: F.coalesce(F.col("capabilities")[n], F.lit(False))
    fields = set(episodes.schema["capabilities"].dataType.names) if "capabilities" in has else set()
    checks: dict[int | str, tuple[Column, str]] = {}
    for s in ("action", "state"):
        if f"{s}_level" in has and f"has_{s}" in fields:
            checks[f"3{s}"] = (((c(f"{s}_level") == "absent") == cap(f"has_{s}")), f"{s} level contradicts has_{s}")
    if {"cameras"} <= has and "has_video" in fields:
        checks[11] = (cap("has_video") & ~F.coalesce(F.exists("cameras", lambda x: x["encoding"] == "mp4_sidecar"), F.lit(False)), "has_video without a video file")
    if "truncated" in has:
        checks[7] = (c("truncated") & (c("end_reason") == "success"), "truncated and ended by success")
    if "adjudicator" in has:
        checks[14] = ((c("adjudicator") == "none") & c("success").isNotNull(), "success that nobody judged")
    if "timestamp_source" in has:
        checks["clock"] = (~(c("timestamp_source").isin(*CLOCKS) | c("timestamp_source").rlike(SYNTHESIZED)), "unknown timestamp_source")
    if "frame_index_source" in has:
        checks[15] = (~((c("frame_index_source") == "upstream") | c("frame_index_source").rlike(DERIVED)), "derived frame index without its rate")
    if "segment" in has and "is_segment" in fields:
        checks[18] = (c("segment").isNotNull() & ~cap("is_segment"), "segment without is_segment")
    if "termination_column" in has and "has_termination_signal" in fields:
        bad = ~cap("has_termination_signal")
        if "raw_columns" in has:
            bad = bad | ~F.array_contains("raw_columns", c("termination_column"))
        checks[19] = (c("termination_column").isNotNull() & bad, "end marker that is not declared")
    if {"source_id", "upstream_id"} <= has:
        checks["uid"] = (c("episode_uid") != F.concat_ws(":", "source_id", "upstream_id"), "uid is not source:upstream")
    return _broken(episodes, "episode_uid", checks)


def channel_checks(channels: DataFrame) -> DataFrame:
    has, c = set(channels.columns), F.col
    named = channels.withColumn("_name", F.concat_ws(".", "embodiment", "signal", "channel"))
    checks: dict[int | str, tuple[Column, str]] = {"limits": (c("min") > c("max"), "min above max"), "prefix": (c("channel").rlike(r"^(action|state|raw)\."), "name carries a column prefix")}
    if "gripper" in has:
        checks[8] = ((c("role") == GRIPPER) != c("gripper").isNotNull(), "gripper metadata without the role, or the reverse")
    if "rotation" in has:
        checks[10] = (c("space").isin(*ROTATIONS) != c("rotation").isNotNull(), "rotation metadata without the space, or the reverse")
    out = _broken(named, "_name", checks)
    w = Window.partitionBy("embodiment", "signal", "channel")
    twice = named.withColumn("_k", F.count(F.lit(1)).over(w)).filter("_k > 1").select(F.lit("name").alias("invariant"), F.col("_name").alias("subject"), F.lit("channel declared twice").alias("detail")).distinct()
    out = out.unionByName(twice)
    if "group" in has:
        same = F.struct(*[F.coalesce(F.col(x).cast("string"), F.lit("\x00")) for x in ("space", "frame", "unit", "origin") if x in has])
        odd = channels.filter("`group` IS NOT NULL").groupBy("embodiment", "signal", "group").agg(F.count_distinct(same).alias("k")).filter("k > 1")
        out = out.unionByName(odd.select(F.lit("16").alias("invariant"), F.concat_ws(".", "embodiment", "signal", "group").alias("subject"), F.lit("channels of a group disagree").alias("detail")))
    return out


def column_checks(episodes: DataFrame, channels: DataFrame, samples: DataFrame) -> DataFrame:
    """Channels that are declared and not stored, or stored and not declared, for signals that have frames."""
    level = F.create_map(F.lit("action"), F.col("action_level"), F.lit("state"), F.col("state_level"))
    due = episodes.join(F.broadcast(channels.select("embodiment", "signal", "channel")), "embodiment").filter(level[F.col("signal")] == CONTINUOUS).select("episode_uid", "signal", "channel")
    have = samples.select("episode_uid", "signal", "channel").distinct()
    name = F.concat_ws(".", "episode_uid", "signal", "channel").alias("subject")
    missing = due.join(have, ["episode_uid", "signal", "channel"], "left_anti").select(F.lit("2").alias("invariant"), name, F.lit("declared and not stored").alias("detail"))
    return missing.unionByName(have.join(due, ["episode_uid", "signal", "channel"], "left_anti").select(F.lit("2").alias("invariant"), name, F.lit("stored and not declared").alias("detail")))


def stream_checks(streams: DataFrame) -> DataFrame:
    """Streams whose own clock goes back."""
    w = Window.partitionBy("episode_uid", "stream_id", "channel").orderBy("sample_idx")
    back = streams.withColumn("_b", F.lag("t").over(w) > F.col("t")).filter("_b")
    return back.select(F.lit("17").alias("invariant"), F.concat_ws(".", "episode_uid", "stream_id").alias("subject"), F.lit("time goes back").alias("detail")).distinct()


def plan_checks(entries: DataFrame, episodes: DataFrame, budget: int) -> DataFrame:
    """Whole episodes, each once, within the budget."""
    e = entries.join(episodes.select("episode_uid", F.col("n_frames").alias("_whole")), "episode_uid", "left")
    cut = e.filter(~F.col("n_frames").eqNullSafe(F.col("_whole"))).select(F.lit("5").alias("invariant"), F.col("episode_uid").alias("subject"), F.lit("not a whole episode").alias("detail"))
    twice = entries.groupBy("episode_uid").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.lit("5").alias("invariant"), F.col("episode_uid").alias("subject"), F.lit("taken twice").alias("detail"))
    over = entries.agg(F.sum("n_frames").alias("s")).filter(F.col("s") > budget).select(F.lit("5").alias("invariant"), F.lit("plan").alias("subject"), F.lit("over budget").alias("detail"))
    return cut.unionByName(twice).unionByName(over)


def transition_checks(changes: DataFrame, subject: str = "episode_uid") -> DataFrame:
    return bad_transitions(changes).select(F.lit("1").alias("invariant"), F.col(subject).cast("string").alias("subject"), F.concat_ws(" to ", "from_stage", "to_stage").alias("detail"))


def all_of(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
