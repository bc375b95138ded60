"""Annotated segments of long recordings: intervals from CSV, camera poses by frame, inertial samples by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.functions import signals as S
from kinelake.operators.order import n_ranges, settled, spread

# Columns that are read, and their types; the inertial files' columns by stream.
SEGMENT = {"narration_id": "string", "participant_id": "string", "video_id": "string", "start_timestamp": "string", "stop_timestamp": "string", "start_frame": "long", "stop_frame": "long", "narration": "string", "verb": "string", "verb_class": "int", "noun": "string", "noun_class": "int"}
VIDEO = {"video_id": "string", "duration": "double", "fps": "double", "resolution": "string"}
INERTIAL = {"gyro": ("gyro", ("GyroX", "GyroY", "GyroZ")), "accel": ("accl", ("AcclX", "AcclY", "AcclZ"))}
#: An interval join meets in buckets of so many milliseconds at least.
BUCKET_MS = 10_000


def _csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Columns of a CSV by the names in its header, wherever they stand; one that is not there is an error."""
    rows = spark.read.csv(path, header=True)
    return rows.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with their bounds in seconds and their place in the file."""
    rows = _csv(spark, path, SEGMENT)
    return rows.withColumn("file_pos", F.monotonically_increasing_id()).withColumn("start_s", S.timecode_seconds("start_timestamp")).withColumn("stop_s", S.timecode_seconds("stop_timestamp"))


def read_videos(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, duration, fps, height, width); a resolution that says nothing is 0 by 0."""
    v = _csv(spark, path, VIDEO)
    size = lambda k: F.coalesce(F.when(F.col("resolution").rlike("^[0-9]+x[0-9]+$"), F.split("resolution", "x")[k].cast("int")), F.lit(0))
    return v.select("video_id", "duration", "fps", size(1).alias("height"), size(0).alias("width"))


def read_inertial(spark: SparkSession, root: str) -> DataFrame:
    """(video_id, stream_id, ms, x, y, z) of all sensors' files <video>-<sensor>.csv below a root, columns by name."""
    out = None
    for stream, (file, columns) in INERTIAL.items():
        which = {"pathGlobFilter": f"*-{file}.csv", "recursiveFileLookup": True}
        if not spark.read.format("binaryFile").options(**which).load(root).select("path").take(1):  # no such files
            continue
        rows = spark.read.csv(root, header=True, **which)
        name = F.regexp_extract(F.input_file_name(), rf"([^/]+)-{file}[.]csv$", 1)
        one = rows.select(name.alias("video_id"), F.lit(stream).alias("stream_id"), F.col("Milliseconds").cast("double").alias("ms"), *[F.col(c).cast("double").alias(a) for c, a in zip(columns, "xyz", strict=True)])
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], "video_id string, stream_id string, ms double, x double, y double, z double") if out is None else out


def discover(segments: DataFrame, videos: DataFrame, wanted: list[str], source_id: str) -> DataFrame:
    """Segments of the wanted videos, in turns over them, with their neighbours' bounds, the video's length and rate, and
    their frames at the extraction rate. The list must not be empty, and every video must be known."""
    if not wanted:
        raise ValueError("name the videos to take")
    known = {r[0] for r in videos.filter(F.col("video_id").isin(wanted)).select("video_id").collect()}  # of those asked for
    if set(wanted) - known:
        raise ValueError(f"no such videos: {', '.join(sorted(set(wanted) - known))}")
    turns = round_robin(with_neighbours(segments.filter(F.col("video_id").isin(wanted))), wanted)
    both = turns.join(F.broadcast(videos.filter(F.col("video_id").isin(wanted))), "video_id")  # as many rows as were asked for
    rate = extraction_fps(F.col("fps"))
    first, last = S.frame_range(F.col("start_s"), F.col("stop_s"), rate)
    place = (F.col("turn") - 1) * len(wanted) + F.col("video_pos")
    return both.withColumns({"episode_uid": F.concat(F.lit(f"{source_id}:"), "narration_id"), "place": place, "extraction_fps": rate, "first_frame": first, "last_frame": last})


def duration_facts(segments: DataFrame, videos: DataFrame, short_s: float = 0.4) -> DataFrame:
    """(video_id, n, n_short, n_past_end, n_overlap, n_over_half): how long segments are, how many end behind their video,
    and how many overlap the next one by more than half of the shorter of the two."""
    w = Window.partitionBy("video_id").orderBy("start_s", "stop_s")
    length = F.col("stop_s") - F.col("start_s")
    nxt = F.least("stop_s", F.lead("stop_s").over(w)) - F.greatest("start_s", F.lead("start_s").over(w))
    nxt = F.when(F.lead("start_s").over(w).isNotNull(), nxt)
    shorter = F.greatest(F.least(length, F.lead(length).over(w)), F.lit(1e-9))
    told = segments.select("video_id", "stop_s", length.alias("d"), nxt.alias("o"), (nxt / shorter).alias("part"))
    over = F.col("o") > 0
    end = videos.select("video_id", "duration")
    return told.join(end, "video_id", "left").groupBy("video_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("d") < short_s).alias("n_short"), F.count_if(F.col("stop_s") > F.col("duration")).alias("n_past_end"), F.count_if(over).alias("n_overlap"), F.count_if(over & (F.col("part") > 0.5)).alias("n_over_half")
    )


def rate_search(segments: DataFrame, videos: DataFrame, flat: tuple[float, ...] = (60.0, 50.0, 60000 / 1001)) -> DataFrame:
    """(rate, reproduced): the part of segments whose own frame numbers a rate gives within one: the videos' rates, flat
    ones, and the extraction rate."""
    both = segments.join(videos.select("video_id", "fps"), "video_id")
    named = {"official": F.col("fps"), **{f"flat {r:g}": F.lit(r) for r in flat}, "extraction": extraction_fps(F.col("fps"))}
    near = lambda r: F.coalesce((F.abs(F.floor(F.col("start_s") * r) - F.col("start_frame")) <= 1) & (F.abs(F.floor(F.col("stop_s") * r) - F.col("stop_frame")) <= 1), F.lit(False))
    one = both.agg(*[F.avg(near(r).cast("int")).alias(k) for k, r in named.items()])
    return one.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, named)), F.array(*[F.col(f"`{k}`") for k in named]))).alias("rate", "reproduced"))


def rate_histogram(videos: DataFrame, digits: int = 2) -> DataFrame:
    """(fps, n, seconds): how many videos have each rate, and how long they are together; a rate that is missing is one."""
    return videos.groupBy(F.round("fps", digits).alias("fps")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("duration"), F.lit(0.0)).alias("seconds"))


def pose_coverage(poses: DataFrame, videos: DataFrame) -> DataFrame:
    """(video_id, n_posed, coverage, step_min, step_median, step_max): how much of a video has a pose, and how far apart."""
    k = F.regexp_extract("frame_key", r"([0-9]+)[.]", 1).cast("int")
    step = k - F.lag(k).over(Window.partitionBy("video_id").orderBy(k))
    told = poses.select("video_id", step.alias("step"))
    a = told.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_posed"), F.min("step").alias("step_min"), F.percentile("step", F.lit(0.5)).alias("step_median"), F.max("step").alias("step_max"))
    frames = F.floor(F.col("duration") * F.col("fps"))
    return a.join(videos, "video_id").select("video_id", "n_posed", F.try_divide("n_posed", frames).alias("coverage"), "step_min", "step_median", "step_max")


def inertial_facts(samples: DataFrame) -> DataFrame:
    """(video_id, stream_id, n, hz, p50, p99, largest, mean_norm, unit): rate and size of a sensor's samples, and the unit
    that these sizes can only be in: a hand turns at a few rad/s, and a head at rest feels about 9.8 m/s^2."""
    size = F.array(*[F.abs(F.col(c)) for c in "xyz"])
    norm = F.sqrt(sum(F.col(c) * F.col(c) for c in "xyz"))
    each = samples.select("video_id", "stream_id", "ms", norm.alias("norm"), F.explode(size).alias("v"))
    a = each.groupBy("video_id", "stream_id").agg((F.count(F.lit(1)) / 3).cast("long").alias("n"), ((F.max("ms") - F.min("ms")) / 1000).alias("span"), F.percentile("v", F.lit(0.5)).alias("p50"), F.percentile("v", F.lit(0.99)).alias("p99"), F.max("v").alias("largest"), F.avg("norm").alias("mean_norm"))
    gyro = F.col("stream_id") == "gyro"
    unit = F.when(gyro & (F.col("largest") < 40), "rad/s").when(gyro, "deg/s").when(F.col("mean_norm").between(7, 12), "m/s^2").otherwise("unknown")
    return a.select("video_id", "stream_id", "n", F.try_divide("n", "span").alias("hz"), "p50", "p99", "largest", "mean_norm", unit.alias("unit"))


def extraction_fps(official: Column) -> Column:
    """The rate that frames were extracted at: 50 for an official 50, otherwise 60."""
    return F.when(official == 50, 50.0).otherwise(60.0)


def with_neighbours(segments: DataFrame) -> DataFrame:
    """The end of the segment before and the start of the next one of the same video, in order of start."""
    w = Window.partitionBy("video_id").orderBy("start_s", "file_pos")
    return segments.withColumn("prev_end_s", F.lag("stop_s").over(w)).withColumn("next_start_s", F.lead("start_s").over(w))


def round_robin(segments: DataFrame, videos: list[str]) -> DataFrame:
    """Turns over the videos in the given order; ends with the video that has the fewest segments."""
    pos = F.array_position(F.array(*map(F.lit, videos)), F.col("video_id")) - 1
    w = Window.partitionBy("video_id").orderBy("file_pos")
    own = segments.filter(F.col("video_id").isin(videos)).withColumn("turn", F.row_number().over(w)).withColumn("video_pos", pos)
    counts = own.groupBy("video_id").agg(F.count(F.lit(1)).alias("c"))
    least = counts.agg(F.when(F.count(F.lit(1)) == len(videos), F.min("c")).otherwise(0).alias("_least"))
    return own.crossJoin(F.broadcast(least)).filter("turn <= _least").drop("_least")  # one row


def frame_bounds(segments: DataFrame) -> DataFrame:
    """(episode_uid, video_id, first, last, n): of each segment the ends and the number of the frames that `frames_of` makes,
    without making them: one row in, one row out, however long a segment is."""
    first, last = S.frame_range(F.col("start_s"), F.col("stop_s"), F.col("fps"))
    told = segments.select("episode_uid", "video_id", first.cast("long").alias("first"), last.cast("long").alias("last"))
    return told.withColumn("n", F.col("last") - F.col("first") + 1)


def frames_of(segments: DataFrame) -> DataFrame:
    """(episode_uid, video_id, frame_idx, frame_no, t): every frame of each segment at the extraction rate."""
    first, last = S.frame_range(F.col("start_s"), F.col("stop_s"), F.col("fps"))
    each = segments.select("episode_uid", "video_id", "fps", first.alias("first"), F.explode(F.sequence(first, last)).alias("frame_no"))
    return each.select("episode_uid", "video_id", (F.col("frame_no") - F.col("first")).alias("frame_idx"), "frame_no", ((F.col("frame_no") - F.col("first")) / F.col("fps")).alias("t"))


def pose_table(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, frame_key, pose) from one JSON file per video; a pose without seven numbers fails where it is used."""
    raw = spark.read.schema("images map<string,array<double>>").option("multiLine", "true").json(path).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("video_id"), F.explode("images").alias("frame_key", "pose"))
    seven = F.when(F.size("pose") == 7, F.col("pose")).otherwise(F.raise_error(F.lit("a camera pose has seven numbers")).cast("array<double>"))
    return raw.withColumn("pose", seven)


def with_pose(frames: DataFrame, poses: DataFrame, n_rows: int | None = None) -> DataFrame:
    """Frames with their pose, NULL where the reconstruction has none. Pose files count frames from 1. Where the number of
    frames is told, they are dealt out to as many tasks as it asks for."""
    keyed = frames.withColumn("frame_key", F.format_string("frame_%010d.jpg", F.col("frame_no") + 1))
    if n_rows is not None:
        keyed = spread(keyed, n_rows, "video_id", "frame_key")
    return keyed.join(poses, ["video_id", "frame_key"], "left").drop("frame_key")


def slice_samples(samples: DataFrame, segments: DataFrame) -> DataFrame:
    """Samples (video_id, ms, ...) within each segment, both ends included, on the sensor's own clock.

    An interval join: both sides meet in buckets of time as long as segments are in the mean (BUCKET_MS at least), so that
    it is an equi-join in which a segment stands in about two buckets, however long segments are."""
    s = segments.select("episode_uid", "video_id", "start_s", (F.col("start_s") * 1000).alias("_a"), (F.col("stop_s") * 1000).alias("_b"))
    mean = s.agg(F.avg(F.col("_b") - F.col("_a"))).first()[0]
    bucket = max(BUCKET_MS, int(mean or 0))
    s = s.withColumn("_k", F.explode(F.sequence(F.floor(F.col("_a") / bucket), F.floor(F.col("_b") / bucket))))
    joined = samples.withColumn("_k", F.floor(F.col("ms") / bucket)).join(s, ["video_id", "_k"]).filter("ms BETWEEN _a AND _b")
    w = Window.partitionBy("episode_uid").orderBy("ms")
    return joined.withColumn("t", F.col("ms") / 1000 - F.col("start_s")).withColumn("sample_idx", F.row_number().over(w) - 1).drop("_a", "_b", "_k", "start_s")


def slice_facts(samples: DataFrame, segments: DataFrame) -> DataFrame:
    """(episode_uid, n, last_t, last_idx): how many samples `slice_samples` gives an episode, and the largest t and place,
    without making slices, which are as many as segments times samples where these lie close.

    Samples are counted by time, and times and ends of segments are put in one order by video, in ranges: what a segment
    has is the difference of the counts at its ends. Episodes without samples are not there."""
    a, b = F.col("start_s") * 1000, F.col("stop_s") * 1000
    none = F.lit(None)
    times = samples.groupBy("video_id", F.col("ms").cast("double").alias("at")).agg(F.count(F.lit(1)).alias("c"))
    times = times.select("video_id", "at", F.lit(1).alias("kind"), none.cast("string").alias("episode_uid"), none.cast("double").alias("start_s"), none.cast("double").alias("stop_s"), "c")
    ends = segments.select("video_id", F.inline(F.array(F.struct(a.alias("at"), F.lit(0).alias("kind")), F.struct(b.alias("at"), F.lit(2).alias("kind")))), "episode_uid", "start_s", "stop_s", F.lit(0).cast("long").alias("c"))
    marks = times.unionByName(ends.filter("start_s IS NOT NULL AND stop_s IS NOT NULL")).filter("video_id IS NOT NULL AND at IS NOT NULL")
    by = ["video_id", "at", "kind", "episode_uid", "start_s", "stop_s"]
    dealt = marks.repartitionByRange(n_ranges(marks.sparkSession), *by).sortWithinPartitions(*by)
    rows = settled(dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)))
    seen = F.max(F.when(F.col("kind") == 1, F.col("at")))
    part = rows.groupBy("video_id", "_range").agg(F.sum("c").alias("_c"), seen.alias("_seen"))
    before = Window.partitionBy("video_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    told = part.select("video_id", "_range", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.max("_seen").over(before).alias("_seen"))
    here = Window.partitionBy("video_id", "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumns({"upto": F.sum("c").over(here), "last": seen.over(here)}).filter("kind <> 1")
    run = run.join(told, ["video_id", "_range"]).withColumns({"upto": F.col("upto") + F.col("_before"), "last": F.coalesce("last", "_seen")})
    stop = F.col("kind") == 2
    each = run.groupBy("episode_uid", "video_id", "start_s", "stop_s").agg(F.sum(F.when(stop, F.col("upto")).otherwise(-F.col("upto"))).alias("n"), F.max(F.when(stop, F.col("last"))).alias("last"))
    each = each.filter("n > 0").withColumn("t", F.col("last") / 1000 - F.col("start_s"))
    return each.groupBy("episode_uid").agg(F.sum("n").alias("n"), F.max("t").alias("last_t"), (F.sum("n") - 1).cast("int").alias("last_idx"))


def available_layers(segments: DataFrame, inventory: DataFrame, layers: list[str]) -> DataFrame:
    """(episode_uid, layers, missing): which enabled layers a video has; a layer that is absent is told, not an error."""
    have = inventory.groupBy("video_id").agg(F.collect_set("layer").alias("_have"))
    want = F.array(*map(F.lit, layers))
    got = segments.join(have, "video_id", "left").withColumn("_have", F.coalesce("_have", F.array().cast("array<string>")))
    return got.select("episode_uid", F.array_intersect(want, "_have").alias("layers"), F.array_except(want, "_have").alias("missing"))


def transforms(layers: DataFrame) -> DataFrame:
    """(episode_uid, transforms): that a segment was cut out of its recording, and each enabled layer that it has not."""
    make = lambda op, what: F.struct(F.lit(op).alias("op"), what.alias("layer"))
    absent = F.transform("missing", lambda x: make("layer_absent", x))
    return layers.select("episode_uid", F.concat(F.array(make("slice_segment", F.lit(None).cast("string"))), absent).alias("transforms"))
