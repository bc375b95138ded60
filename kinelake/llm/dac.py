"""Token ids as directly addressable codes.

A block of ids is split into levels of 8-bit chunks, lowest first. A level has one chunk for each id that reaches it
and a bitmap whose bit says that the id goes on in the next level; a rank directory of one running count per 512 bits
turns a place in a level into its place in the next one. Any id is read with one rank per level; nothing else of the
block is decoded.

Layout of a block, little-endian: b"DAC1", n ids (u64), n levels (u32), then for each level: n chunks (u64), the
chunks, the bitmap (n / 64 rounded up, u64 words), the directory (u32 per 8 words, and the total).

Files: one shard per range of document ids, in ascending order, holding blocks of at most `block_tokens` ids (a longer
document is a block of its own) with each document's id and length. The shards are written as one Parquet table whose
rows are blocks, so that any store that Spark writes to holds them and a failed task's files never count. Parquet adds
no compression, so that a block in memory is its codes. `read` takes each document out of its block by one rank per
level (`Codes.span`), `tokens_at` any token by its place in the whole corpus (`Codes.get`).

Defined results: null and empty texts have only the end id; repeated document ids keep one entry each, ordered by a
hash of their texts and then their ids; null document ids come first; an empty table gives no files' rows. An id that
very many rows share is parted over several shards by that hash.
"""

from __future__ import annotations

import functools
import hashlib
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelake.llm import textkit as K

BLOCK_TOKENS = 1 << 18
END_ID = 1
#: Words whose ids a worker keeps; the table starts anew when it is full.
CACHE_WORDS = 1_500_000
#: Letters below this code point are taken as Latin ones, whose lower case and normal form are settled.
LATIN = 0x250
MAGIC = b"DAC1"
#: Punctuation that is parted from a letter before it, and small letters.
TAIL, SMALL = np.zeros(256, bool), np.zeros(256, bool)
TAIL[list(b".,!?;:%$#&*|()\"-+=/")] = True
SMALL[97:123] = True
#: What a null document id counts as in the order of ids.
NONE = -(2**63)


def pack(ids: np.ndarray) -> bytes:
    ids = np.asarray(ids, np.uint32)
    levels, rest = [], ids
    while True:
        more = rest >= 256
        bits = np.zeros((len(rest) + 63) // 64 * 64, np.uint8)
        bits[: len(rest)] = more
        words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.bitwise_count(words).astype(np.uint32)
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(ones, np.arange(0, len(ones), 8)) if len(ones) else ones)]).astype("<u4")
        levels += [np.uint64(len(rest)).tobytes(), (rest & 255).astype(np.uint8).tobytes(), words.tobytes(), ranks.tobytes()]
        rest = rest[more] >> np.uint32(8)
        if not len(rest):
            break
    return b"".join([MAGIC, np.uint64(len(ids)).tobytes(), np.uint32(len(levels) // 4).tobytes(), *levels])


class Codes:
    """A packed block, read in place."""

    def __init__(self, block: bytes):
        if block[:4] != MAGIC:
            raise ValueError("not a block of codes")
        self.n = int(np.frombuffer(block, "<u8", 1, 4)[0])
        at, self.levels = 16, []
        for _ in range(int(np.frombuffer(block, "<u4", 1, 12)[0])):
            n = int(np.frombuffer(block, "<u8", 1, at)[0])
            chunks = np.frombuffer(block, np.uint8, n, at + 8)
            at += 8 + n
            words = np.frombuffer(block, "<u8", (n + 63) // 64, at)
            at += words.nbytes
            ranks = np.frombuffer(block, "<u4", (len(words) + 7) // 8 + 1, at)
            at += ranks.nbytes
            self.levels.append((chunks, words, ranks))

    def get(self, at: np.ndarray) -> np.ndarray:
        """The ids at these places, by one rank in each level that they reach."""
        at = np.asarray(at, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("no such token")
        out = np.zeros(len(at), np.uint32)
        who = np.arange(len(at))
        for k, (chunks, words, ranks) in enumerate(self.levels):
            out[who] |= chunks[at].astype(np.uint32) << np.uint32(8 * k)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            more = (words[word] >> bit) & np.uint64(1) == 1
            who, at, word, bit = who[more], at[more], word[more], bit[more]
            if not len(who):
                break
            rank = ranks[word >> 3].astype(np.int64)
            for step in range(7):
                inside = (word & 7) > step
                rank += np.where(inside, np.bitwise_count(words[np.where(inside, (word & ~7) + step, word)]), 0)
            at = rank + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
        return out

    def span(self, a: int, b: int) -> np.ndarray:
        """The ids at places a to b - 1: a range of each level, found by one rank; nothing else is read."""
        if not 0 <= a <= b <= self.n:
            raise IndexError("no such tokens")
        out = np.zeros(b - a, np.uint32)
        who: np.ndarray | None = None  # of the ids that reach this level, all at first
        for k, (chunks, words, ranks) in enumerate(self.levels):
            here = chunks[a:b].astype(np.uint32) << np.uint32(8 * k)
            if who is None:
                out |= here
            else:
                out[who] |= here
            bits = np.unpackbits(words[a >> 6 : (b + 63) >> 6].view(np.uint8), bitorder="little")[a & 63 : (a & 63) + b - a]
            more = np.flatnonzero(bits)
            if not len(more):
                break
            who = more if who is None else who[more]
            a = self._rank(words, ranks, a)
            b = a + len(more)
        return out

    @staticmethod
    def _rank(words: np.ndarray, ranks: np.ndarray, at: int) -> int:
        """The number of ones before a place."""
        word, bit = at >> 6, at & 63
        count = int(ranks[word >> 3]) + int(np.bitwise_count(words[word & ~7 : word]).sum())
        return count + (int(words[word]) & ((1 << bit) - 1)).bit_count() if bit else count


class WordEncoder:
    """Ids of texts by a tokenizer that treats what white space parts separately; each word is encoded once.

    Words are found and looked up by hash, many at a time, A-Z as a-z. Punctuation behind a letter at the end of a word
    is a word of its own, as the tokenizer's pattern parts the two. Where case may count (a special string of the
    tokenizer, or a capital before a character beyond ASCII, which might combine with the small letter alone) a word
    is taken as it is. Words of Latin letters need no more of the tokenizer than its model; many are handed to it at
    once and told apart by the tokens that end a word. All others go through the whole tokenizer.
    """

    def __init__(self, tokenizer: str, limit: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_str(tokenizer)
        self.literal = Tokenizer.from_str(tokenizer)  # for words that are a special string but for their case
        self.literal.encode_special_tokens = True
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = getattr(self.whole.model, "end_of_word_suffix", None) or "</w>"
        self.ends = np.zeros(max(self.whole.get_vocab().values()) + 1, bool)
        for word, i in self.whole.get_vocab().items():
            self.ends[i] = word.endswith(suffix)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.visible = {c: level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x80, LATIN))}
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.table, self.known = K.Table(max(8, (2 * self.limit).bit_length())), 0
        self.flat, self.at = np.zeros(1 << 16, np.uint16 if len(self.ends) <= 1 << 16 else np.uint32), np.zeros(1 << 12, np.int64)

    def plain(self, word: bytes) -> str | None:
        """A word of Latin letters as the model reads it; None for any other."""
        if word.isalpha():
            return word.decode()
        text = word.decode()
        if text.isalpha() and max(text) < chr(LATIN):
            low = "".join(map(str.lower, text))
            if max(low) < chr(LATIN):
                return "".join(self.visible.get(c, c) for c in low)
        return None

    def learn(self, hashes: np.ndarray, words: list[bytes], exact: np.ndarray) -> None:
        """Adds words, A-Z in lower case but for those that are taken exactly."""
        easy: list[str] = []
        order: list[int] = []
        rest: list[int] = []
        for k, w in enumerate(words):
            seen = None if exact[k] else self.plain(w)
            if seen is None:
                rest.append(k)
            else:
                easy.append(seen)
                order.append(k)
        ids: list[np.ndarray] = []
        size: list[np.ndarray] = []
        place: list[int] = []
        for i in range(0, len(easy), 2048):
            some = easy[i : i + 2048]
            found = np.array(self.model.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            stop = np.flatnonzero(self.ends[found]) + 1
            if len(stop) != len(some) or stop[-1] != len(found):
                rest += order[i : i + 2048]
                continue
            place += order[i : i + 2048]
            ids.append(found)
            size.append(np.diff(stop, prepend=0))
        for tokenizer, group in ((self.whole, [k for k in rest if exact[k]]), (self.literal, [k for k in rest if not exact[k]])):
            for i in range(0, len(group), 2048):
                some = group[i : i + 2048]
                found = [e.ids for e in tokenizer.encode_batch_fast([words[k].decode() for k in some], add_special_tokens=False)]
                place += some
                ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
                size.append(np.array([len(x) for x in found], np.int64))
        new, total = np.concatenate(ids), int(self.at[self.known])
        if total + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(new)), self.flat.dtype)])
        if self.known + len(words) >= len(self.at):
            self.at = np.concatenate([self.at, np.zeros(max(len(self.at), len(words)), np.int64)])
        self.flat[total : total + len(new)] = new
        self.at[self.known + 1 : self.known + len(words) + 1] = total + np.cumsum(np.concatenate(size))
        self.table.add(hashes[np.array(place)], self.known)
        self.known += len(words)

    def words(self, texts: pa.Array) -> tuple[K.Words, np.ndarray]:
        """The words of the texts, and which of them are taken exactly."""
        data, at = K.raw(texts)
        starts, ends, bounds = K.spans(data, at, K.NOT_SPACE)
        exact = np.zeros(len(starts), bool)
        exact[np.searchsorted(starts, np.flatnonzero((data[:-1] >= 65) & (data[:-1] <= 90) & (data[1:] >= 128)), "right") - 1] = True
        whole = data.tobytes()
        for s in self.special:
            i = whole.find(s)
            while i >= 0:
                exact[np.searchsorted(starts, i, "right") - 1] = True
                i = whole.find(s, i + 1)
        if len(starts):
            last = np.maximum.accumulate(np.where(TAIL[data], -1, np.arange(len(data), dtype=np.int32)))
            cut = last[ends - 1].astype(np.int64) + 1
            part = (cut > starts) & (cut < ends) & SMALL[K.FOLD[data[cut - 1]]] & ~exact
            count = 1 + part
            first = np.cumsum(count) - count
            starts, ends, exact = np.repeat(starts, count), np.repeat(ends, count), np.repeat(exact, count)
            starts[first[part] + 1] = ends[first[part]] = cut[part]
            bounds = np.append(first, len(starts))[bounds]
        hashes = K.hash_spans(data, starts, ends)
        hashes[exact] = [int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]].data, digest_size=8).digest(), "little") for k in np.flatnonzero(exact).tolist()]
        return K.Words(data, starts, ends, hashes, bounds), exact

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and where each text's start."""
        w, exact = self.words(texts)
        row = self.table.find(w.hashes)
        new = np.flatnonzero(row < 0)
        if len(new):
            hashes, first = np.unique(w.hashes[new], return_index=True)
            if self.known + len(hashes) > self.limit and self.known:
                self.clear()
                new = np.arange(len(row))
                hashes, first = np.unique(w.hashes, return_index=True)
                if len(hashes) > self.limit:  # one long text may have more
                    self.table = K.Table((2 * len(hashes)).bit_length())
            first = new[first]
            self.learn(hashes, [w.data[w.starts[k] : w.ends[k]].tobytes() if exact[k] else w.text(k) for k in first.tolist()], exact[first])
            row[new] = self.table.find(w.hashes[new])
        size = self.at[row + 1] - self.at[row]
        total = np.concatenate([[0], np.cumsum(size)])
        count = np.diff(w.bounds)
        doc_at = total[w.bounds] + np.arange(len(w.bounds))
        out = np.full(int(doc_at[-1]), END_ID, np.uint32)
        shift = np.repeat(np.arange(len(count)), count)
        out[K.ragged(total[:-1] + shift, size)] = self.flat[K.ragged(self.at[row], size)]
        return out, doc_at


@functools.lru_cache(maxsize=1)
def word_encoder(tokenizer: str) -> WordEncoder:
    """One for all tasks of a worker, so that words stay known."""
    return WordEncoder(tokenizer)


def _narrow(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """Each text's ids between the encoder and the writer: two bytes for every id if all fit, and four otherwise, with
    the width in the last byte."""
    width = 2 if int(ids.max(initial=0)) < 1 << 16 else 4
    size = np.diff(at) * width
    ends = np.cumsum(size + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, width, np.uint8)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = ids.astype(f"<u{width}").view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(out)])


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[-1]}", (len(data) - 1) // data[-1]).astype(np.uint32)


def shard_of(cut: np.ndarray, key: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """The shard of each id: how many cuts are not above it; an id that is m cuts at once is parted evenly by `tie`."""
    low, high = np.searchsorted(cut, key, "left"), np.searchsorted(cut, key, "right")
    more = high - low
    part = (tie.astype(np.float64) / 2.0**64 + 0.5) * more
    return low + np.where(more > 0, 1 + np.clip(part.astype(np.int64), 0, np.maximum(more - 1, 0)), 0)


def encode(docs: DataFrame, tokenizer_path: str, edges: list[int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, tie (a hash of the text), shard (its range of document ids) and ids with the end id, packed for the way
    to the writer."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())
    cut = np.array(edges, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer.value)
        for batch in batches:
            for part in K.slices(batch):
                ids, at = encoder.encode(part.column("text"))
                key = part.column("doc_id").fill_null(NONE).to_numpy(zero_copy_only=False)
                tie = part.column("tie")
                shard = shard_of(cut, key, tie.to_numpy())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), tie, pa.array(shard, pa.int32()), _narrow(ids, at)], names=["doc_id", "tie", "shard", "ids"])
        K.tidy()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    return rows.mapInArrow(run, "doc_id long, tie long, shard int, ids binary")


BLOCK = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("before", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("codes", T.BinaryType()),
    ]
)


def _blocks(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, before, held, docs, ids = None, 0, 0, 0, [], []

        def flush():
            nonlocal number, before, held, docs, ids
            if docs:
                row = [[shard], [number], [before], [held], [docs], [[len(x) for x in ids]], [pack(np.concatenate(ids))]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _arrow(BLOCK), strict=True)], names=BLOCK.names)
                number, before, held, docs, ids = number + 1, before + held, 0, [], []

        for batch in batches:
            for s, d, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "ids")), strict=True):
                x = _wide(data)
                if s != shard or held + len(x) > block_tokens:
                    yield from flush()
                if s != shard:
                    shard, number, before = s, 0, 0
                docs.append(d)
                ids.append(x)
                held += len(x)
        yield from flush()
        K.tidy()

    return run


def _arrow(schema: T.StructType) -> list[pa.DataType]:
    plain = {T.IntegerType(): pa.int32(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary(), T.ArrayType(T.LongType()): pa.list_(pa.int64())}
    return [plain[f.dataType] for f in schema]


def edges(docs: DataFrame, n: int, doc_id: str = "doc_id") -> list[int]:
    """At most n - 1 document ids that part the documents into ranges of like size; an id is there as often as it would
    fill ranges by itself."""
    if n < 2:
        return []
    at = ", ".join(f"{k / n:.6f}d" for k in range(1, n))
    found = docs.agg(F.expr(f"percentile_approx(coalesce(CAST(`{doc_id}` AS BIGINT), {NONE}), array({at}), {10 * n})")).first()[0]
    return sorted(found or [])


def write(docs: DataFrame, tokenizer_path: str, path: str, n_shards: int, block_tokens: int = BLOCK_TOKENS, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encodes the documents and writes the shards in ascending order of document ids."""
    cut = edges(docs, n_shards, doc_id)
    encoded = encode(docs, tokenizer_path, cut, doc_id, text)
    placed = encoded.repartitionById(len(cut) + 1, F.col("shard")).sortWithinPartitions("shard", "doc_id", "tie", "ids")
    placed.mapInArrow(_blocks(block_tokens), BLOCK).write.option("compression", "none").parquet(path)


def _opened(spark, path: str):
    """The blocks, and for each shard the number of ids in all shards before it; the driver holds one count per shard."""
    blocks = spark.read.schema(BLOCK).parquet(path)
    base, total = {}, 0
    for shard, n in sorted(blocks.groupBy("shard").agg(F.sum("n_tokens")).toLocalIterator()):
        base[shard] = total
        total += n
    return blocks, base


def read(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files alone."""
    blocks, base = _opened(spark, path)
    bases = spark.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                b = {c: batch.column(c)[k] for c in ("shard", "before", "doc_ids", "lengths", "codes")}
                codes = Codes(b["codes"].as_buffer().to_pybytes())
                length = b["lengths"].values.to_numpy()
                at = np.concatenate([[0], np.cumsum(length)])
                crc = [zlib.crc32(codes.span(x, y).astype("<u4", copy=False)) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                start = at[:-1] + b["before"].as_py() + bases.value[b["shard"].as_py()]
                yield pa.RecordBatch.from_arrays([b["doc_ids"].values, pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
        K.tidy()

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_at(places: DataFrame, path: str, place: str = "place") -> DataFrame:
    """(place, token): the ids at these places of the whole corpus, null where there is none. Places meet the range that
    a block holds; each id is then read by one rank per level."""
    spark = places.sparkSession
    blocks, base = _opened(spark, path)
    bases = spark.createDataFrame([(k, v) for k, v in base.items()], "shard int, base long")
    held = blocks.join(F.broadcast(bases), "shard").select((F.col("base") + F.col("before")).alias("low"), "n_tokens", "codes")
    # buckets of as many ids as a block has at least, so that a block and a place meet by equality
    bucket = BLOCK_TOKENS
    held = held.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("low") / bucket), F.floor((F.col("low") + F.greatest("n_tokens", F.lit(1)) - 1) / bucket))))
    asked = places.select(F.col(place).cast("long").alias("place")).withColumn("bucket", F.floor(F.col("place") / bucket))
    near = (held["bucket"] == asked["bucket"]) & (asked["place"] >= held["low"]) & (asked["place"] < held["low"] + held["n_tokens"])
    met = asked.join(held.select("bucket", "low", "n_tokens"), near, "left").select("place", "low")

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        at = left.column("place").to_numpy()
        if not right.num_rows:
            return pa.table({"place": at, "token": pa.nulls(len(at), pa.int64())})
        low = right.column("low")[0].as_py()
        return pa.table({"place": at, "token": Codes(right.column("codes")[0].as_py()).get(at - low).astype(np.int64)})

    codes = blocks.join(F.broadcast(bases), "shard").select((F.col("base") + F.col("before")).alias("low"), "codes")
    return met.groupBy("low").cogroup(codes.join(met.select("low").distinct(), "low", "left_semi").groupBy("low")).applyInArrow(run, "place long, token long")


def op8_dac_tokens(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    from kinelake.llm.store import n_partitions, new_path, table

    path = new_path(spark, "dac")
    write(table(spark, sf_dir, "documents"), P.path("word_bpe_49k.json"), path, n_partitions(spark))
    return read(spark, path)
