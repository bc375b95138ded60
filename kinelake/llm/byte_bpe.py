"""Byte-level BPE encoding and decoding with overlapping chunks.

A text of at most `chunk` characters is one piece. A longer one is dealt out as chunks that overlap by `overlap`
characters. Every chunk is pre-tokenised by itself, in parallel; a chunk and the one before it resynchronise at the
first boundary that both have in their overlap, and from there on both see the same pre-tokens, since a match depends
only on what follows it. Texts are cut at these boundaries, and the pieces are encoded in parallel and put together in
order; only their ids meet by text. Cuts are taken only behind a pre-token that ends in a character other than white
space, as white space is the one pre-token that looks at the character behind it. Where an overlap has no common boundary (one pre-token longer than
the overlap), the rest of that text stays one piece: slower, with the same ids.

Decoding concatenates the bytes of the ids; it never fails, also not on ids that part a character. `encode` can decode
what it has encoded beside it, so that ids need not go to Python once more.

Defined results: null and empty texts have no ids; repeated rows are each encoded alike; an empty table gives an empty
one; further columns are kept as they are, but one that is called as an output gives way to it; texts of any length are
encoded whole.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelake.llm import textkit as K
from kinelake.llm.store import keep, quoted

CHUNK, OVERLAP = 1 << 14, 1 << 9


@functools.lru_cache(maxsize=2)
def encoder(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _forget() -> None:
    """An encoder is made in a tenth of a second; workers that go on to something else need not hold it."""
    encoder.cache_clear()


@functools.lru_cache(maxsize=2)
def _pattern(pattern: str):
    import regex

    return regex.compile(pattern)


def cuts(text: str, at: int, end: bool, pattern: str, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Boundaries of a chunk that starts at `at`: those within the overlap with the chunk before it, and with the one
    behind it. A match that reaches the end of the chunk's text may be longer in the whole text; it and its end are
    left out unless the text ends there."""
    head: list[int] = [at] if at == 0 else []
    tail: list[int] = []
    for m in _pattern(pattern).finditer(text):
        e = m.end()
        if e >= len(text) - 1 and not end:
            break
        if not text[e - 1].isspace():
            if at and e < overlap:
                head.append(at + e)
            if chunk <= e < chunk + overlap:
                tail.append(at + e)
    return head, tail


def _pretokenise(pattern: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "_text"):
                found = [cuts(t, k * chunk, k == n - 1, pattern, chunk, overlap) for t, k, n in zip(*(part.column(c).to_pylist() for c in ("_text", "_k", "_n")), strict=True)]
                both = [pa.array([x[i] for x in found], pa.list_(pa.int64())) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("_row", "_n", "_k")] + both, names=["_row", "_n", "_k", "_head", "_tail"])
        K.tidy()

    return run


def _encode(ranks, pattern: str, both: bool):
    """What `told` asks: the ids of texts, and the bytes that they decode to if asked for."""

    def what(texts: pa.Array) -> list[pa.Array]:
        coder = encoder(ranks.value, pattern)
        ids = [coder.encode_ordinary(t) if t else [] for t in texts.to_pylist()]
        out = [pa.array([np.array(x, "<u4").tobytes() for x in ids], pa.binary())]
        return out + [pa.array(list(map(coder.decode_bytes, ids)), pa.binary())] if both else out

    return what


def _broadcast(spark, path: str):
    """The rank file (a vocabulary, under 1 MB) for all executors; the driver alone needs to have it."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids", columns: list[str] | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, decoded: str | None = None) -> DataFrame:
    """The columns asked for (all by default), `out`: a binary of little-endian unsigned 32-bit ids, and `decoded`, if it is
    named: the bytes that these ids decode to."""
    spark = docs.sparkSession
    made = [out] if decoded is None else [out, decoded]
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() not in {m.lower() for m in made}]
    names = {c: f"_c{i}" for i, c in enumerate(columns)}
    flat = docs.select(*[F.col(quoted(c)).alias(n) for c, n in names.items()], F.col(quoted(text)).alias("_text"))
    ranks = _broadcast(spark, ranks_path)
    kept = list(names.values())
    whole = flat.filter(F.coalesce(F.length("_text"), F.lit(0)) <= chunk)
    what, fields = _encode(ranks, pattern, decoded is not None), {"_ids": "binary", "_back": "binary"}
    fields = fields if decoded is not None else {"_ids": "binary"}
    short = K.told(whole, "_text", what, fields, done=_forget).select(*kept, *fields)

    n = F.ceil(F.length("_text") / chunk).cast("int")
    # written, as numbers of rows are only good for as long as rows come in one order, and they are read twice
    long = keep(flat.filter(F.length("_text") > chunk).withColumn("_row", F.monotonically_increasing_id()).withColumn("_n", n), "long", result=True)
    piece = long.select(
        "_row", "_n", F.struct(*kept).alias("_kept"), "_text", F.posexplode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_k", "_"),
    ).select(
        "_row", "_n", "_k", F.when(F.col("_k") == 0, F.col("_kept")).alias("_kept"), F.col("_text").substr(F.col("_k") * chunk + 1, F.lit(chunk + overlap)).alias("_text"),
    ).repartition(_parts(spark), "_row", "_k")
    # boundaries alone meet by text; the chunks stay where they are and are cut there
    seen = piece.mapInArrow(_pretokenise(pattern, chunk, overlap), "_row long, _n int, _k int, _head array<bigint>, _tail array<bigint>")
    by = Window.partitionBy("_row").orderBy("_k")
    cut = F.when(F.col("_k") == 0, F.lit(0).cast("long")).otherwise(F.array_min(F.array_intersect("_head", F.lag("_tail").over(by))))
    synced = seen.withColumn("_cut", cut).withColumn("_ok", F.min(F.col("_cut").isNotNull()).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    runs = synced.withColumn("_run", F.sum(F.col("_ok").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    nxt = runs.withColumn("_end", F.when(F.lead("_ok").over(by), F.lead("_cut").over(by)))
    start = F.when(F.col("_ok"), F.col("_cut")).otherwise(F.col("_k") * chunk)
    stop = F.coalesce("_end", F.when(F.col("_k") == F.col("_n") - 1, F.lit(1 << 40)).otherwise((F.col("_k") + 1) * chunk))
    many = F.count(F.lit(1)).over(Window.partitionBy("_row", "_run"))
    plan = nxt.select("_row", "_k", "_run", many.alias("_many"), (start - F.col("_k") * chunk + 1).cast("int").alias("_from"), F.least(stop - start, F.lit(1 << 30)).cast("int").alias("_size"))
    parts = piece.join(plan, ["_row", "_k"]).select("_row", "_run", "_many", "_k", "_kept", F.expr("substring(_text, _from, _size)").alias("_part"))
    alone = parts.filter("_many = 1").select("_row", "_run", "_kept", F.col("_part").alias("_text"))
    # chunks that one pre-token holds together
    held = (
        parts.filter("_many > 1").groupBy("_row", "_run").agg(F.array_sort(F.collect_list(F.struct("_k", "_part"))).alias("_parts"), F.max("_kept").alias("_kept"))
        .select("_row", "_run", "_kept", F.array_join("_parts._part", "").alias("_text"))
    )
    done = K.told(alone.unionByName(held), "_text", _encode(ranks, pattern, False), {"_ids": "binary"}, done=_forget).drop("_text")
    joined = done.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_run", "_ids"))).alias("_all"), F.max("_kept").alias("_kept"))
    whole_ids = joined.select(*[F.col("_kept")[c].alias(c) for c in kept], F.aggregate("_all", F.unhex(F.lit("")), lambda a, x: F.concat(a, x["_ids"])).alias("_ids"))
    result = short.unionByName(whole_ids if decoded is None else K.told(whole_ids, "_ids", _decode(ranks, pattern), {"_back": "binary"}, done=_forget))
    return result.select(*[F.col(n).alias(c) for c, n in names.items()], *[F.col(f).alias(m) for f, m in zip(fields, made, strict=True)])


def _parts(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and `out`: the bytes of the ids, one after the other."""
    return K.told(encoded, ids, _decode(_broadcast(encoded.sparkSession, ranks_path), pattern), {out: "binary"}, done=_forget)


def _decode(ranks, pattern: str):
    def what(column: pa.Array) -> list[pa.Array]:
        table = encoder(ranks.value, pattern).decode_bytes
        return [pa.array([table(np.frombuffer(x, "<u4").tolist()) if x else b"" for x in column.to_pylist()], pa.binary())]

    return what


def digest(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def production() -> tuple[str, str]:
    import public_tokenizers as P

    return P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN


def op4_byte_bpe(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    ranks, pattern = production()
    return digest(encode(table(spark, sf_dir, "documents"), ranks, pattern, columns=["doc_id"], decoded="decoded"))
