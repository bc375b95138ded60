"""Vectorised byte and word handling shared by the text operators.

Words are found and hashed on the UTF-8 bytes of a whole Arrow batch with a fixed number of numpy passes, so the cost
is a few nanoseconds a byte and there is no Python object per word. Work is cut into slices of whole documents, which
bounds a worker's memory; a document longer than a slice is a slice of its own.

A word's hash is taken eight bytes at a time, each step a bijection of all that came before, so that no pattern of
bytes cancels out; words over LONG bytes are hashed by blake2b. Two words share 64 bits by chance alone.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.llm.store import fresh, quoted

#: Bytes of text that are tokenised at once, and bytes of a word that are hashed eight at a time.
SLICE_BYTES = 2 << 20
LONG = 64
_BASE = np.uint64(0x9E3779B97F4A7C55)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _fold() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


#: Byte -> byte with A-Z in lower case.
FOLD = _fold()
#: Bytes of words that are parted by white space, and of words of letters, digits and anything beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ITEM = np.zeros(256, bool)
ITEM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finisher)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


#: The first bytes of a little-endian word of eight, by their number.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_STEP = np.uint64(0xD1342543DE82EF95)


@dataclass
class Words:
    """Words of consecutive documents: byte ranges in `data`, 64-bit hashes, and each document's range of words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def text(self, k: int) -> bytes:
        return FOLD[self.data[self.starts[k] : self.ends[k]]].tobytes()


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (a null is empty), and each text's start, with the end of the last."""
    texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type):
        width = np.int64
    else:
        width = np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, width, len(texts) + 1, texts.offset * np.dtype(width).itemsize).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes that `inside` marks, none across two texts; each text's range of runs."""
    mark = inside[data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mark[:-1]
    before[at[:-1][at[:-1] < n]] = False
    starts = np.flatnonzero(mark & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mark[1:]
    last = at[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(mark & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hashes of byte ranges; A-Z count as a-z if `fold`."""
    size = ends - starts
    out = mix((size + 1).astype(np.uint64) * _BASE)
    if not len(size):
        return out
    low = np.zeros(len(data) + 8, np.uint8)
    if fold:
        np.take(FOLD, data, out=low[: len(data)])
    else:
        low[: len(data)] = data
    eights = np.ndarray(len(data) + 1, "<u8", low.data, strides=(1,))
    live = np.flatnonzero((size > 0) & (size <= LONG))
    at, rest = starts[live], size[live]
    while len(live):
        out[live] = mix(out[live] * _STEP + (eights[at] & _FIRST[np.minimum(rest, 8)]))
        more = rest > 8
        live, at, rest = live[more], at[more] + 8, rest[more] - 8
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(low[starts[k] : ends[k]].data, digest_size=8).digest(), "little")
    return out


def words(texts: pa.Array, inside: np.ndarray = NOT_SPACE) -> Words:
    data, at = raw(texts)
    starts, ends, bounds = spans(data, at, inside)
    return Words(data, starts, ends, hash_spans(data, starts, ends), bounds)


def hash_word(word: bytes) -> int:
    """The hash that `words` gives to one word."""
    data = np.frombuffer(word, np.uint8)
    return int(hash_spans(data, np.array([0]), np.array([len(data)]))[0]) if word else 0


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's runs of n words, repeats included, and each document's range; a document of fewer
    words has one, its whole sequence; one without words has none."""
    h, bounds = w.hashes, w.bounds
    size = np.diff(bounds)
    count = np.where(size >= n, size - n + 1, np.minimum(size, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    total = int(at[-1])
    doc = np.repeat(np.arange(len(size)), count)
    pos = np.arange(total) - at[doc] + bounds[:-1][doc]
    long = size[doc] >= n
    out = np.zeros(total, np.uint64)
    factor = np.uint64(1)
    for k in range(n):
        factor = np.uint64((int(factor) * int(_BASE)) & (2**64 - 1))
        here = long | (k < size[doc])
        out += np.where(here, h[np.minimum(pos + k, max(len(h) - 1, 0))], np.uint64(0)) * factor
    short = np.where(long, n, size[doc]).astype(np.uint64)
    return mix(out + short), at


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most `limit` bytes of text, or one row."""
    _lean()
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


class Table:
    """Numbers of distinct 64-bit hashes by open addressing; a hash of 0 stands for a free place and is not found."""

    def __init__(self, bits: int):
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.rows = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def add(self, hashes: np.ndarray, first: int) -> None:
        """New hashes, none twice, with numbers from `first` on."""
        at = (hashes >> self.shift).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = self.keys[at[left]] == 0
            put = left[free]
            self.keys[at[put]] = hashes[put]
            won = self.keys[at[put]] == hashes[put]
            self.rows[at[put[won]]] = put[won] + first
            left = np.concatenate([left[~free], put[~won]])
            at[left] = (at[left] + 1) & self.mask

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it is unknown."""
        at = (hashes >> self.shift).astype(np.int64)
        key = self.keys[at]
        hit = key == hashes
        out = np.where(hit, self.rows[at], -1).astype(np.int64)
        left = np.flatnonzero(~hit & (key != 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            here = at[left]
            key = self.keys[here]
            hit = key == hashes[left]
            out[left[hit]] = self.rows[here[hit]]
            left = left[~hit & (key != 0)]
        return out


@functools.cache
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library
        return None


@functools.cache
def _lean() -> None:
    """Large arrays are mapped, and so go back to the system as soon as they are freed; else workers keep them."""
    if _libc():
        _libc().mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD


def tidy() -> None:
    """Gives memory that is no longer used back to the system; workers are kept between tasks."""
    pa.default_memory_pool().release_unused()
    if _libc():
        _libc().malloc_trim(0)


def told(docs: DataFrame, text: str, what: Callable[[pa.Array], list[pa.Array]], fields: dict[str, str], limit: int = SLICE_BYTES, done: Callable[[], None] | None = None) -> DataFrame:
    """The columns of docs and, for each text, the fields (name: type) that `what` gives for an array of texts.

    The text alone goes to Python, which reads `limit` bytes at once, and the fields alone come back. A column of docs
    with the name of a field gives way to it. At the end of a task `done` gives up what a worker need not keep."""
    names = list(fields)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.StructArray.from_arrays(what(part.column(0)), names=names) for part in slices(pa.RecordBatch.from_arrays([batch], names=["t"]), "t", limit)]
            yield pa.concat_arrays(parts) if parts else pa.StructArray.from_arrays(what(batch), names=names)
        if done:
            done()
        tidy()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(run, "struct<" + ", ".join(f"{n}: {t}" for n, t in fields.items()) + ">").asNondeterministic()  # else filters would run it again
    own = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    made = fresh("_told", docs.columns)
    found = docs.withColumn(made, udf(F.col(quoted(text))))
    return found.select(*[F.col(quoted(c)) for c in own], *[F.col(made)[n].alias(n) for n in names])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of each range, one range after the other."""
    at = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - at, lengths)


def crc_remainder(ids: pa.Array, modulus: int) -> np.ndarray:
    """crc32(id as text) mod modulus; a null id counts as an empty text."""
    import zlib

    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % modulus for i in ids.to_pylist()], np.int64)
