"""Column expressions over time-ordered samples: steps, islands, isolation, finite-only statistics.

All are built-in expressions or windows partitioned by episode (and channel), so that one exchange by episode serves
every one of them. Missing values are NULL; NaN and infinities count as missing (`finite`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPISODE = "episode_uid"
#: The largest isolation that is reported, in place of infinity.
MOST_ISOLATED = 1e9


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def finite(x: Column | str) -> Column:
    """The value if it is a finite number, else NULL."""
    x = _c(x).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def ordered(*keys: str, by: str = "frame_idx"):
    return Window.partitionBy(*keys).orderBy(by)


def difference(x: Column | str, window) -> Column:
    """The change since the row before; NULL in the first row."""
    return _c(x) - F.lag(_c(x)).over(window)


def step(x: Column | str, is_delta: Column | str, window) -> Column:
    """How far a channel moved into this frame: a delta channel's own value, any other's change. NULL in the first."""
    first = F.row_number().over(window) == 1
    return F.when(~first, F.abs(F.when(_c(is_delta), _c(x)).otherwise(difference(x, window))))


def rebased(t: Column | str, keys: list[str], by: str = "frame_idx") -> Column:
    """Time since the first frame."""
    whole = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return _c(t) - F.first(_c(t)).over(whole)


def median_of(values: Column) -> Column:
    """The median of an array without NULLs; NULL if it is empty."""
    ordered_ = F.array_sort(values)
    n = F.size(ordered_)
    return F.when(n > 0, (F.get(ordered_, F.floor((n - 1) / 2).cast("int")) + F.get(ordered_, F.floor(n / 2).cast("int"))) / 2)


def around(x: Column | str, window, reach: int) -> Column:
    """The values of the rows around, as an array: itself and its two neighbours are left out, and rows beyond the edge."""
    near = [f(_c(x), k).over(window) for f in (F.lag, F.lead) for k in range(2, reach + 1)]
    return F.array_compact(F.array(*near))


def isolation(x: Column | str, near: Column) -> Column:
    """A step over the median of the steps around it; 1 with none around."""
    base = median_of(near)
    still = F.when(_c(x) > 0, MOST_ISOLATED).otherwise(1.0)
    return F.when(base.isNull(), 1.0).when(base <= 0, still).otherwise(F.least(F.try_divide(_c(x), base), F.lit(MOST_ISOLATED)))


#: Columns of a summary, in order.
SUMMARY = ("count", "n_nan", "mean", "std", "min", "max", "p1", "p99")


def summary(x: Column | str, prefix: str = "") -> list[Column]:
    """count, n_nan, mean, std (of the population), min, max, p1, p99; all but the counts over finite values alone."""
    v = finite(x)
    named = {
        "count": F.count(F.lit(1)),
        "n_nan": F.count_if(v.isNull()),
        "mean": F.avg(v),
        "std": F.stddev_pop(v),
        "min": F.min(v),
        "max": F.max(v),
        "p1": F.percentile(v, F.lit(0.01)),
        "p99": F.percentile(v, F.lit(0.99)),
    }
    return [c.alias(prefix + k) for k, c in named.items()]


def with_gaps(frames: DataFrame, present: Column | str, t: Column | str = "t", key: str = EPISODE) -> DataFrame:
    """(key, t, here, gap): in the first frame of each run of missing ones the time to the next present frame, or to the
    last frame."""
    w = ordered(key)
    back = Window.partitionBy(key).orderBy(F.desc("frame_idx")).rowsBetween(Window.unboundedPreceding, 0)
    here = frames.select(key, "frame_idx", _c(t).alias("t"), _c(present).alias("here"))
    told = here.withColumn("starts", ~F.col("here") & F.coalesce(F.lag("here").over(w), F.lit(True)))
    told = told.withColumn("next_t", F.last(F.when(F.col("here"), F.col("t")), ignorenulls=True).over(back)).withColumn("last_t", F.first("t").over(back))
    return told.select(key, "t", "here", F.when(F.col("starts"), F.coalesce("next_t", "last_t") - F.col("t")).alias("gap"))


def end_markers(frames: DataFrame, marker: Column | str, key: str = EPISODE) -> DataFrame:
    """(key, n_frames, n_end_signals, terminal_run, n_interior_signals) of a per-frame end marker."""
    marked = F.coalesce(finite(marker) != 0, F.lit(False))
    here = frames.select(key, "frame_idx", marked.alias("m"), (F.row_number().over(ordered(key)) - 1).alias("i"))
    n, last = F.count(F.lit(1)), F.max(F.when(~F.col("m"), F.col("i")))
    agg = here.groupBy(key).agg(n.alias("n_frames"), F.count_if("m").alias("n_end_signals"), (n - 1 - F.coalesce(last, F.lit(-1))).alias("terminal_run"))
    return agg.withColumn("n_interior_signals", F.col("n_end_signals") - F.col("terminal_run"))


def timecode_seconds(text: Column | str) -> Column:
    """Seconds of HH:MM:SS.ff."""
    part = F.split(_c(text), ":")
    return part[0].cast("double") * 3600 + part[1].cast("double") * 60 + part[2].cast("double")


def frame_range(start: Column, stop: Column, fps: Column) -> tuple[Column, Column]:
    """First and last frame of an interval in seconds, inclusive; at least one frame."""
    first = (start * fps).cast("int")
    return first, F.greatest(first, (stop * fps).cast("int"))


def ieee_quotient(a: Column, b: Column) -> Column:
    """a / b of doubles where b may be 0: an infinity with the signs' product, or NaN for 0 / 0; NaN is the largest value."""
    by_zero = F.when((a == 0) | F.isnan(a), float("nan")).otherwise(F.signum(a) * F.when(b.cast("string") == "-0.0", float("-inf")).otherwise(float("inf")))
    return F.when(b == 0, F.when(a.isNotNull(), by_zero)).otherwise(F.try_divide(a, b))


def canonical_digest(parts: list[Column | str]) -> Column:
    """One hash of an ordered list of columns, NULLs told from empty texts."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(_c(p).cast("string"), F.lit("\x00")) for p in parts]), 256)
