"""Facts of episodes in parts against those of whole episodes."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kinelake.functions import signals as S
from kinelake.operators import long_episodes as E


def table(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def frames(spark):
    rnd = random.Random(6)
    rows = []
    for e, n in (("a", 53), ("b", 1), ("c", 20), ("d", 12)):
        k, t = 0, 0.0
        for _ in range(n):
            k += rnd.choice([1, 1, 1, 3])
            t += rnd.choice([0.1, 0.1, 0.1, 0.0, 2.0])
            rows.append((e, k, None if e == "c" and k % 11 == 0 else t, rnd.random() < (0.0 if e == "d" else 0.4), rnd.choice([0.0, 0.0, 1.0, None]) if k < 40 else 1.0, rnd.gauss(0, 1)))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "episode_uid string, frame_idx long, t double, here boolean, m double, step double").cache()


def test_clocks_in_parts(frames):
    dt = frames.select("episode_uid", "frame_idx", "t", S.difference("t", S.ordered("episode_uid")).alias("dt"))
    mid = F.percentile("dt", F.lit(0.5)).over(Window.partitionBy("episode_uid"))
    gap = (F.col("mid") > 0) & (F.col("dt") > 3.0 * F.col("mid"))
    want = dt.withColumn("mid", mid).groupBy("episode_uid").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("dt") <= 0).alias("bad"), F.count_if(S.finite("t").isNull()).alias("holes"), F.min("dt").alias("lo"), F.first("mid").alias("mid"), F.max("dt").alias("hi"), F.count("dt").alias("n_dt"), F.count_if(gap).alias("gaps"),
    )
    for size in (4, 1 << 20):
        assert table(E.clock(frames, size=size)) == table(want)


@pytest.mark.parametrize("size", [1, 5, 1000])
def test_gaps_in_parts(frames, size):
    whole = frames.filter("t IS NOT NULL")
    assert table(E.gaps(whole, "here", size=size)) == table(S.with_gaps(whole, "here"))


def test_markers_and_lone_steps_in_parts(frames):
    assert table(E.end_markers(frames, "m")) == table(S.end_markers(frames, "m"))
    w = S.ordered("episode_uid")
    want = frames.select("episode_uid", "frame_idx", "step", S.isolation("step", S.around("step", w, 5)).alias("alone"))
    assert table(E.isolation(frames, ["episode_uid"], 5, size=7)) == table(want)


def test_a_part_is_all_that_a_task_has(spark):
    long = spark.range(5000).select(F.lit("a").alias("episode_uid"), F.col("id").alias("frame_idx"), (F.col("id") / 10).alias("t"))
    rows = E.parted(long, ["episode_uid"], size=100, reach=3)
    sizes = {r["part"]: (r["n"], r["own"]) for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if("own").alias("own")).collect()}
    own = [v for v in sizes.values() if v[1]]  # behind the last part there are guests alone
    assert len(own) == 50 and {v[1] for v in own} == {100} and max(v[0] for v in own) == 106
