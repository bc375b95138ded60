"""Distribution statistics: per channel of an episode, and of the latest quality metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.functions import signals as S
from kinelake.operators.history import latest
from kinelake.operators.order import few, settled
from kinelake.operators.quantiles import quantiles


def channel_stats(samples: DataFrame, keys: tuple[str, ...] = ("episode_uid", "signal", "channel")) -> DataFrame:
    """Summary of each channel of each episode, over one aggregation."""
    return samples.groupBy(*keys).agg(*S.summary("value"))


def channel_stats_map(samples: DataFrame) -> DataFrame:
    """(episode_uid, stats): one map of summaries by signal.channel."""
    each = channel_stats(samples)
    fields = [c for c in each.columns if c not in ("episode_uid", "signal", "channel")]
    entry = F.struct(F.concat_ws(".", "signal", "channel").alias("key"), F.struct(*fields).alias("value"))
    return each.groupBy("episode_uid").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("stats"))


def metric_samples(results: DataFrame, episodes: DataFrame) -> DataFrame:
    """(source_id, rule_id, metric, value): every finite metric of the latest result of each episode and rule."""
    rows = latest(results).join(episodes.select("episode_uid", "source_id"), "episode_uid")
    each = rows.select("source_id", "rule_id", F.explode("metrics").alias("metric", "value"))
    return each.withColumn("value", S.finite("value")).filter("value IS NOT NULL")


#: Values of a group of which one task may hold the distinct ones.
IN_A_TASK = 1_000_000


def distributions(rows: DataFrame, keys: list[str], value: str = "value", in_a_task: int = IN_A_TASK) -> DataFrame:
    """The summary of each group's values. Quantiles of a group of more than `in_a_task` values are selected by counting
    (see `quantiles`), so that no task has such a group; both ways are exact."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = settled(sizes.filter(F.col("_n") > in_a_task).drop("_n"))
    if not large.take(1):
        return rows.groupBy(*keys).agg(*S.summary(value))
    large = few(large)  # one in `in_a_task` rows at most
    small = rows.join(large, keys, "left_anti").groupBy(*keys).agg(*S.summary(value))
    mine = rows.join(large, keys, "left_semi").withColumn(value, S.finite(value))
    exact = ("p1", "p99")
    plain = mine.groupBy(*keys).agg(*[c for c, name in zip(S.summary(value), S.SUMMARY, strict=True) if name not in exact])
    selected = quantiles(mine, keys, value, {"p1": 0.01, "p99": 0.99})
    return small.unionByName(plain.join(selected, keys, "left"))


def metric_distributions(results: DataFrame, episodes: DataFrame, in_a_task: int = IN_A_TASK) -> DataFrame:
    """The summary of every metric of every rule and source."""
    return distributions(metric_samples(results, episodes), ["source_id", "rule_id", "metric"], in_a_task=in_a_task)
