"""Facts of episodes that are too long for one task: rows dealt out by ranges of frames instead of by episode.

Rows are numbered along each episode (a distributed order) and cut into parts of `size` rows. A window that looks `reach`
rows back or ahead needs no more than that many guests from the parts on either side, which are copied in and left out
of what comes of it. What an episode's parts have to tell each other beyond that, such as the time of the next frame that
is there, is one row a part, put together over an episode's few parts. Medians and other quantiles are selected by
counting (see `quantiles`). The results are those of the rules' own facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.functions import signals as S
from kinelake.operators.order import numbered, settled
from kinelake.operators.quantiles import quantiles

#: Rows of a part.
SIZE = 1 << 20
EPISODE = S.EPISODE


def parted(rows: DataFrame, keys: list[str], by: str = "frame_idx", size: int = SIZE, reach: int = 1) -> DataFrame:
    """Rows with `pos` (from 0 along `by`, within keys), `part`, and `own`: false for guests, rows of a neighbouring part
    at most `reach` rows away, so that a window over (keys, part) sees all that it may look at."""
    at = numbered(rows, keys, [by], "pos").withColumn("pos", F.col("pos") - 1)
    home = F.floor(F.col("pos") / size)
    near = F.array_distinct(F.array(home, F.floor(F.greatest(F.col("pos") - reach, F.lit(0)) / size), F.floor((F.col("pos") + reach) / size)))
    return at.withColumn("part", F.explode(near)).withColumn("own", F.col("part") == home)


def _window(keys: list[str]):
    return Window.partitionBy(*keys, "part").orderBy("pos")


def steps(frames: DataFrame, size: int = SIZE) -> DataFrame:
    """(episode_uid, frame_idx, t, dt) of every frame: the time since the frame before."""
    rows = parted(frames.select(EPISODE, "frame_idx", "t"), [EPISODE], size=size)
    told = rows.withColumn("dt", S.difference("t", _window([EPISODE])))
    return told.filter("own").select(EPISODE, "frame_idx", "t", "dt")


def clock(frames: DataFrame, gap_factor: float = 3.0, size: int = SIZE) -> DataFrame:
    """(episode_uid, n, bad, holes, lo, mid, hi, n_dt, gaps): what the rules of clocks and rates read."""
    dt = settled(steps(frames, size))
    mid = quantiles(dt, [EPISODE], "dt", {"mid": 0.5})
    gap = (F.col("mid") > 0) & (F.col("dt") > gap_factor * F.col("mid"))
    # a row an episode against its rows: the one side is never split in two by a key that occurs once there
    told = dt.join(mid, EPISODE, "left")
    return told.groupBy(EPISODE).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("dt") <= 0).alias("bad"), F.count_if(S.finite("t").isNull()).alias("holes"),
        F.min("dt").alias("lo"), F.first("mid").alias("mid"), F.max("dt").alias("hi"), F.count("dt").alias("n_dt"), F.count_if(gap).alias("gaps"),
    )


def gaps(frames: DataFrame, present: Column | str, t: Column | str = "t", size: int = SIZE) -> DataFrame:
    """(episode_uid, t, here, gap) as of `signals.with_gaps`: in the first frame of each run of missing ones the time to the
    next present frame, or to the last frame."""
    column = lambda x: F.col(x) if isinstance(x, str) else x
    rows = settled(parted(frames.select(EPISODE, "frame_idx", column(t).alias("t"), column(present).alias("here")), [EPISODE], size=size))
    keys = [EPISODE]
    there = F.when(F.col("here"), F.col("t"))
    each = rows.filter("own").groupBy(*keys, "part").agg(F.min_by("t", F.when(F.col("here"), F.col("pos"))).alias("t1"), F.bool_or("here").alias("some"), F.max_by("t", "pos").alias("end"))
    later = Window.partitionBy(*keys).orderBy(F.desc("part"))  # a row a part
    nxt = F.last(F.when(F.col("some"), F.struct("t1")), ignorenulls=True).over(later.rowsBetween(Window.unboundedPreceding, -1))
    told = each.select(*keys, "part", nxt.alias("after"), F.first("end").over(later.rowsBetween(Window.unboundedPreceding, 0)).alias("end"))
    w = _window(keys)
    ahead = Window.partitionBy(*keys, "part").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("starts", ~F.col("here") & F.coalesce(F.lag("here").over(w), F.lit(True))).withColumn("next_t", F.last(there, ignorenulls=True).over(ahead))
    seen = seen.filter("own").join(told, [*keys, "part"])
    return seen.select(*keys, "t", "here", F.when(F.col("starts"), F.coalesce("next_t", F.col("after.t1"), "end") - F.col("t")).alias("gap"))


def pose_coverage(poses: DataFrame, present: Column | str, size: int = SIZE) -> DataFrame:
    """(episode_uid, part, holes, gap): the part of frames with a pose, those without, and the longest gap."""
    told = gaps(poses, present, size=size)
    return told.groupBy(EPISODE).agg(F.avg(F.col("here").cast("int")).alias("part"), F.count_if(~F.col("here")).alias("holes"), F.coalesce(F.max("gap"), F.lit(0.0)).alias("gap"))


def end_markers(frames: DataFrame, marker: Column | str) -> DataFrame:
    """(episode_uid, n_frames, n_end_signals, terminal_run, n_interior_signals) as of `signals.end_markers`; places alone say
    how long the last run is, so that no window is needed."""
    marked = F.coalesce(S.finite(marker) != 0, F.lit(False))
    at = numbered(frames.select(EPISODE, "frame_idx", marked.alias("m")), [EPISODE], ["frame_idx"], "pos")
    n, last = F.count(F.lit(1)), F.max(F.when(~F.col("m"), F.col("pos")))
    a = at.groupBy(EPISODE).agg(n.alias("n_frames"), F.count_if("m").alias("n_end_signals"), (n - F.coalesce(last, F.lit(0))).alias("terminal_run"))
    return a.withColumn("n_interior_signals", F.col("n_end_signals") - F.col("terminal_run"))


def isolation(steps_: DataFrame, keys: list[str], reach: int, size: int = SIZE) -> DataFrame:
    """Rows (keys, frame_idx, step) with `alone`, a step over the median of those around it, by `reach` rows either way."""
    rows = parted(steps_.select(*keys, "frame_idx", "step"), keys, size=size, reach=reach)
    told = rows.withColumn("near", S.around("step", _window(keys), reach))
    return told.filter("own").select(*keys, "frame_idx", "step", S.isolation("step", F.col("near")).alias("alone"))
