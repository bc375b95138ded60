"""Episodes of record shards: discovery from dataset metadata, one record by its place, and the canonical tables.

A record is one episode; a feature holds all its steps in one flat list (`features` as read by `tfrecord`). Records carry
no clock: time is the step over a declared rate. Trailing boundary steps are trimmed, and what they held is kept beside
the episode.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.functions import signals as S
from kinelake.sources import tfrecord as R

# The container that is read, the order in which an action's parts are laid side by side with their
# widths, the parts that are a pose, and the names of other step features.
FORMAT = "tfrecord"
ACTION = {"steps/action/world_vector": 3, "steps/action/rotation_delta": 3, "steps/action/gripper_closedness_action": 1, "steps/action/terminate_episode": 1}
POSE = ("steps/action/world_vector", "steps/action/rotation_delta")
STATE = "steps/observation/robot_state"
INSTRUCTION = "steps/observation/natural_language_instruction"
LAST, TERMINAL, REWARD = "steps/is_last", "steps/is_terminal", "steps/reward"


def dataset(spark: SparkSession, root: str) -> tuple[dict, dict]:
    """dataset_info.json and features.json; a container that is not read here is an error."""
    info, features = (json.loads(spark.read.text(f"{root}/{n}.json", wholetext=True).first()[0]) for n in ("dataset_info", "features"))
    if info.get("fileFormat") != FORMAT:
        raise ValueError(f"{root} is {info.get('fileFormat')!r}, and only {FORMAT!r} is read")
    return info, features


def discover(spark: SparkSession, info: dict, source_id: str, split: str = "train") -> DataFrame:
    """(episode_uid, upstream_id, split, shard_name, shard_index, index_in_shard, layout): an episode is named by its
    running number in the split, which follows from the shards' lengths alone."""
    found = {s.get("name"): s for s in info.get("splits", [])}
    if split not in found:
        raise ValueError(f"no split {split!r}; there are {', '.join(sorted(map(str, found)))}")
    lengths = [int(n) for n in found[split]["shardLengths"]]
    layout = f"{split}:{len(lengths)}-shards@{info['version']}"
    each = R.discover(spark, split, lengths, source_id)
    name = F.format_string(f"{info['name']}-{split}.tfrecord-%05d-of-{len(lengths):05d}", F.col("shard"))
    return each.select("episode_uid", F.substring_index("episode_uid", ":", -1).alias("upstream_id"), F.lit(split).alias("split"), name.alias("shard_name"), F.col("shard").alias("shard_index"), F.col("shard_index").alias("index_in_shard"), F.lit(layout).alias("layout"))


def payload(stream: BinaryIO, wanted: int) -> bytes:
    """One record of a shard; those before it are passed over by their lengths, and nothing behind it is read."""
    for k in range(wanted + 1):
        head = stream.read(12)
        if len(head) < 12:
            raise IndexError(f"the shard has {k} records, none with number {wanted}")
        (n,) = struct.unpack_from("<Q", head)
        if k < wanted:
            stream.seek(n + 4, 1)
    data = stream.read(n)
    if len(data) < n:
        raise IndexError(f"the shard ends inside record {wanted}")
    return data


def fetch(refs: DataFrame, root: str) -> DataFrame:
    """(episode_uid, record): single records (shard_name, index_in_shard) of shards below a root that executors mount."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, name, k in zip(*(batch.column(c).to_pylist() for c in ("episode_uid", "shard_name", "index_in_shard")), strict=True):
                with open(f"{root.removeprefix('file://')}/{name}", "rb") as f:
                    yield pa.RecordBatch.from_arrays([pa.array([uid]), pa.array([payload(f, k)], pa.binary())], names=["episode_uid", "record"])

    return refs.select("episode_uid", "shard_name", "index_in_shard").mapInArrow(run, "episode_uid string, record binary")


def actions(n: Column) -> Column:
    """An array of steps, each an array of all action numbers in the fixed order; a part of another width is an error."""

    def part(name: str, width: int) -> Column:
        m = R.reshaped(R.numbers(name), n)
        odd = F.exists(m, lambda row: F.size(row) != width)
        return F.when(m.isNull() | odd, F.raise_error(F.lit(f"{name} is not {width} wide")).cast("array<array<double>>")).otherwise(m)

    parts = [part(k, w) for k, w in ACTION.items()]
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(*[F.get(p, i) for p in parts]))


def assembled(records: DataFrame) -> DataFrame:
    """records (episode_uid, features) with n_upstream, n_frames (steps kept), action, state (arrays of steps) and task."""
    n = R.step_count()
    poses = F.transform(F.sequence(F.lit(0), F.col("n_upstream") - 1), lambda i: F.concat(*[F.coalesce(F.get(R.reshaped(R.numbers(k), F.col("n_upstream")), i), F.array().cast("array<double>")) for k in POSE]))
    last = R.numbers(LAST)
    known = records.withColumn("n_upstream", F.coalesce(n, F.raise_error(F.lit("no feature tells the number of steps")).cast("int")))
    kept = known.withColumn("n_frames", F.when(last.isNull(), F.col("n_upstream")).otherwise(R.kept_steps(last, poses)))
    cut = lambda m: F.slice(m, 1, F.col("n_frames"))
    text = F.transform(F.try_element_at("features", F.lit(INSTRUCTION))["bytes"], lambda b: b.cast("string"))
    return kept.withColumns({"action": cut(actions(F.col("n_upstream"))), "state": cut(R.reshaped(R.numbers(STATE), F.col("n_upstream"))), "task": R.instruction(text)})


def samples(episodes: DataFrame, channels: DataFrame, embodiment: str, control_hz: float) -> DataFrame:
    """Canonical samples of assembled episodes: numbers by position, time as the step over the declared rate."""
    step = F.arrays_zip("action", "state")
    each = episodes.select("episode_uid", F.posexplode(step).alias("frame_idx", "s"))
    cell = each.select("episode_uid", "frame_idx", F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), F.col(f"s.{s}").alias("v")) for s in ("action", "state")])).alias("c"))
    wide = cell.select("episode_uid", "frame_idx", "c.signal", F.posexplode("c.v").alias("pos", "value"))
    declared = channels.filter(F.col("embodiment") == embodiment).select("embodiment", "signal", "pos", "channel")
    return wide.join(F.broadcast(declared), ["signal", "pos"]).select("episode_uid", "embodiment", "signal", "channel", "frame_idx", (F.col("frame_idx") / F.lit(float(control_hz))).alias("t"), S.finite("value").alias("value"))


def check_widths(episodes: DataFrame, channels: DataFrame, embodiment: str) -> DataFrame:
    """(signal, width, declared) where steps are not as wide as channels are declared."""
    declared = channels.filter(F.col("embodiment") == embodiment).groupBy("signal").agg(F.count(F.lit(1)).alias("declared"))
    got = [episodes.select(F.lit(s).alias("signal"), F.explode(F.array_distinct(F.transform(s, F.size))).alias("width")).distinct() for s in ("action", "state")]
    return got[0].unionByName(got[1]).join(declared, "signal", "left").filter(~F.col("width").eqNullSafe(F.col("declared")))


def scalar_names(dropped: tuple[str, ...] = ()) -> Column:
    """Features with one number a step that nothing else reads, in order of names."""
    used = [*ACTION, STATE, INSTRUCTION, *dropped]
    many = lambda f: F.when(f["kind"] == "float", F.size(f["floats"])).when(f["kind"] == "int64", F.size(f["ints"]))
    fits = F.map_filter("features", lambda k, f: k.startswith("steps/") & ~k.isin(*used) & (many(f) == F.col("n_upstream")))
    return F.array_sort(F.map_keys(fits))


def raw_frames(episodes: DataFrame, control_hz: float, dropped: tuple[str, ...] = ()) -> DataFrame:
    """(episode_uid, frame_idx, t, raw): every such scalar of the kept steps, without the prefix of steps or observations."""
    value = lambda k: F.when(F.element_at("features", k)["kind"] == "float", F.element_at("features", k)["floats"]).otherwise(F.element_at("features", k)["ints"].cast("array<double>"))
    short = lambda k: F.regexp_replace(k, "^steps/(observation/)?", "")
    listed = episodes.withColumn("_names", scalar_names(dropped))
    lists = listed.select("episode_uid", "n_frames", F.transform("_names", short).alias("k"), F.transform("_names", value).alias("v"))
    each = lists.filter("n_frames > 0").select("episode_uid", "k", "v", F.explode(F.sequence(F.lit(0), F.col("n_frames") - 1)).alias("frame_idx"))
    raw = F.map_from_arrays("k", F.transform("v", lambda a: S.finite(F.get(a, F.col("frame_idx")))))
    return each.select("episode_uid", "frame_idx", (F.col("frame_idx") / F.lit(float(control_hz))).alias("t"), raw.alias("raw"))


def trimmed(episodes: DataFrame) -> DataFrame:
    """(episode_uid, n_trimmed, rewards, terminal, terminal_reward, has_termination_signal): what the steps that were
    trimmed held, the largest reward of all steps, and whether an end marker is left on a step that was kept."""
    rest = lambda name, of: F.coalesce(F.transform(F.slice(R.numbers(name), F.col("n_frames") + 1, F.col("n_upstream")), of), F.array().cast("array<double>" if of is _same else "array<boolean>"))
    marks = F.slice(R.numbers(TERMINAL), F.lit(1), F.col("n_frames"))
    return episodes.select(
        "episode_uid", (F.col("n_upstream") - F.col("n_frames")).alias("n_trimmed"), rest(REWARD, _same).alias("rewards"), rest(TERMINAL, lambda x: x != 0).alias("terminal"),
        F.array_max(R.numbers(REWARD)).alias("terminal_reward"), F.coalesce(F.exists(marks, lambda x: x != 0), F.lit(False)).alias("has_termination_signal"),
    )


def _same(x: Column) -> Column:
    return x


def boundary(episodes: DataFrame) -> DataFrame:
    """(episode_uid, is_truncated, end_reason): truncated if it has a last step and none that is terminal; not known
    unless both are recorded."""
    last, terminal = R.numbers(LAST), R.numbers(TERMINAL)
    cut = F.when(last.isNotNull() & terminal.isNotNull(), R.boundary(last, terminal))
    return episodes.select("episode_uid", cut.alias("is_truncated"), F.when(cut, "truncated").otherwise("unknown").alias("end_reason"))


def observation_features(features: dict) -> dict:
    """The observations that features.json declares; none if it has another shape."""
    node = features
    for k in ("featuresDict", "features", "steps", "sequence", "feature", "featuresDict", "features", "observation", "featuresDict", "features"):
        node = node.get(k) if isinstance(node, dict) else None
    return node or {}


def cameras(episodes: DataFrame, features: dict) -> DataFrame:
    """(episode_uid, cameras): declared images, present if the record really holds bytes of one."""
    declared = []
    for name, node in sorted(observation_features(features).items()):
        if "image" in node:
            size = [int(d) for d in node["image"].get("shape", {}).get("dimensions", [])]
            declared.append((name, "wrist" if "hand" in name or "wrist" in name else "static", *(size[:2] if len(size) > 1 else (0, 0)), size[2] if len(size) > 2 else 0))
    held = lambda name: F.coalesce(F.exists(F.try_element_at("features", F.lit(f"steps/observation/{name}"))["bytes"], lambda b: F.octet_length(b) > 0), F.lit(False))
    one = [F.struct(F.lit(n).alias("name"), F.lit(m).alias("mount"), F.lit(h).alias("height"), F.lit(w).alias("width"), F.lit(c).alias("channels"), F.lit("inline").alias("encoding"), held(n).alias("is_present")) for n, m, h, w, c in declared]
    kind = "array<struct<name:string,mount:string,height:int,width:int,channels:int,encoding:string,is_present:boolean>>"
    return episodes.select("episode_uid", (F.array(*one) if one else F.array().cast(kind)).alias("cameras"))


def transforms(episodes: DataFrame, dropped: tuple[str, ...] = ()) -> DataFrame:
    """(episode_uid, transforms): what was done to an episode on its way, in order; (op, n, columns). Needs cameras."""
    make = lambda op, n, columns: F.struct(F.lit(op).alias("op"), n.cast("int").alias("n"), columns.alias("columns"))
    none = F.array().cast("array<string>")
    steps = [
        F.when(F.lit(bool(dropped)), make("drop_channels", F.lit(None), F.array(*map(F.lit, dropped)) if dropped else none)),
        F.when(F.col("n_upstream") > F.col("n_frames"), make("trim_trailing_steps", F.col("n_upstream") - F.col("n_frames"), none)),
        F.when(F.size("cameras") > 0, make("drop_inline_frames", F.lit(None), F.transform("cameras", lambda c: c["name"]))),
    ]
    return episodes.select("episode_uid", F.array_compact(F.array(*steps)).alias("transforms"))
