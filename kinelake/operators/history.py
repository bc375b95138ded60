"""Results as append-only history, upserts without MERGE, and the incremental work-list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.operators.order import numbered

# Stages in order, and what a stale episode goes back to.
STAGES = ("DISCOVERED", "FETCHED", "NORMALIZED", "QC_DONE", "COMMITTED")
FRESH, REDO_NORMALIZE, REDO_QC = "FRESH", "REDO_NORMALIZE", "REDO_QC"


def latest(rows: DataFrame, keys: tuple[str, ...] = ("episode_uid", "rule_id"), at: str = "created_at", seq: str = "seq") -> DataFrame:
    """The newest row of each key; of equal times the one recorded last. Every task keeps one row a key before rows are
    shuffled, so that history moves once for each key and task. `statelog` keeps snapshots of it beside."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, seq)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in rows.columns])


def newest(rows: DataFrame, at: str = "started_at", seq: str = "seq") -> DataFrame:
    """The one newest row of all."""
    return rows.orderBy(F.desc(at), F.desc(seq)).limit(1)


def first_of(discovered: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first n episodes of each group, with their place."""
    return numbered(discovered, [group], order, "place").filter(F.col("place") <= n)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """source's rows in place of target's with the same keys, and all others of target."""
    return target.join(source.select(*keys).distinct(), keys, "left_anti").unionByName(source)


def new_episodes(discovered: DataFrame, catalog: DataFrame) -> DataFrame:
    return discovered.join(catalog.select("episode_uid"), "episode_uid", "left_anti")


def staleness(schema_version: str, adapter_version: Column, ruleset_version: str, upstream_hash: Column | None = None) -> Column:
    """Which part of a committed episode is out of date; columns content_hash, meta, schema_version, ... are its row's."""
    moved = F.lit(False) if upstream_hash is None else F.coalesce(upstream_hash != F.col("content_hash"), F.lit(False))
    old = F.col("content_hash").isNull() | moved | ~F.col("schema_version").eqNullSafe(F.lit(schema_version)) | ~F.col("adapter_version").eqNullSafe(adapter_version)
    return F.when(old, REDO_NORMALIZE).when(~F.col("ruleset_version").eqNullSafe(F.lit(ruleset_version)), REDO_QC).otherwise(FRESH)


def work_list(discovered: DataFrame, catalog: DataFrame, schema_version: str, adapter_version: Column, ruleset_version: str) -> DataFrame:
    """(episode_uid, action, from_stage): what a run has to do; a fresh episode is not in it, so that nothing is written.

    A new or failed episode starts anew, an unfinished one goes on from its stage, a stale one goes back."""
    have = catalog.withColumn("_known", F.lit(True))
    both = discovered.select("episode_uid").join(have, "episode_uid", "left")
    stale = staleness(schema_version, adapter_version, ruleset_version)
    action = F.when(F.col("_known").isNull(), "NEW").when(F.col("status") == "FAILED", "RETRY").when(F.col("status") != "COMMITTED", "RESUME").otherwise(stale)
    stage = F.when(F.col("action").isin("NEW", "RETRY"), "DISCOVERED").when(F.col("action") == "RESUME", F.col("status")).when(F.col("action") == REDO_NORMALIZE, "FETCHED").when(F.col("action") == REDO_QC, "NORMALIZED")
    return both.withColumn("action", action).filter(F.col("action") != FRESH).select("episode_uid", "action", stage.alias("from_stage"))


def stage_rank(stage: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, STAGES)), stage) - 1


def bad_transitions(changes: DataFrame) -> DataFrame:
    """Changes (from_stage, to_stage, reason) that are not one step on, to FAILED, or back with a reason."""
    a, b = stage_rank(F.col("from_stage")), stage_rank(F.col("to_stage"))
    fine = (F.col("to_stage") == "FAILED") | (b == a + 1) | ((b <= a) & (F.coalesce("reason", F.lit("")) != "")) | ((F.col("from_stage") == "FAILED") & (F.col("to_stage") == "DISCOVERED"))
    return changes.filter(~F.coalesce(fine, F.lit(False)))


def recover(runs: DataFrame, state: DataFrame, readable: DataFrame, now: Column) -> dict[str, DataFrame]:
    """What a restart has to mend: open runs to close, the run it goes on from, episodes whose artifact is unreadable."""
    open_ = runs.filter("finished_at IS NULL").orderBy("started_at", "seq")
    broken = state.filter(F.col("status").isin("NORMALIZED", "QC_DONE")).join(readable.select("episode_uid"), "episode_uid", "left_anti")
    return {"interrupted": open_.withColumn("status", F.lit("INTERRUPTED")).withColumn("finished_at", now), "resumed_from": newest(open_), "demoted": broken.withColumn("status", F.lit("FETCHED"))}
