"""Benchmark decontamination with an FM-index for each shard of training text.

Phrases are the windows of `window` consecutive words of a benchmark item (a shorter item is one window). Documents of
SHARD bytes together, or one longer document, are a shard. Words that no phrase has become separators, and runs between
separators that are shorter than the shortest phrase are left out of the index, since no phrase fits there; both steps
are exact. All phrases are searched backwards at once, located by sampled suffix positions, and their spans merged per
document.

The benchmark is the query set: it is read in blocks of at most `block_windows` windows (an item that has
more is cut into runs), each block a broadcast of bounded size that is searched in all shards. Where there are several, what was found is written after each, and the
block's broadcast is given up before the next one is made. Texts go to Python to be searched and do not come back; those
with a hit go there once more to be cut.

Defined results: null and empty texts have no words and are never hit; repeated documents are each reported; an empty
table gives an empty one, an empty benchmark hits nothing; items without words are ignored; a null item_id counts as
the text "null"; columns of docs called as an output give way to it; texts of any length are searched whole, one longer
than a slice in a shard of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelake.llm import textkit as K
from kinelake.llm.fm_index import FMIndex
from kinelake.llm.store import keep, quoted

WINDOW = 10
BLOCK_WINDOWS = 200_000
SHARD = 4 << 20
OUT = "n_words", "hit_spans", "hit_bytes", "hit_items"
FIELDS = {"_n_words": "bigint", "_spans": "array<bigint>", "_bytes": "array<bigint>", "_items": "array<string>"}


class Phrases:
    """One block of benchmark windows: distinct symbol sequences and the items that have each."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.vocabulary = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, np.uint64)
        rows: dict[tuple[int, ...], set[str]] = {}
        for name, hashes in items:
            ids = (np.searchsorted(self.vocabulary, hashes) + 1).tolist()
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1):
                rows.setdefault(tuple(ids[i : i + n]), set()).add(name)
        self.lengths = np.array([len(x) for x in rows], np.int64)
        self.patterns = np.zeros((len(rows), window), np.int64)
        for k, x in enumerate(rows):
            self.patterns[k, window - len(x) :] = x
        names = sorted({n for x in rows.values() for n in x})
        number = {n: k for k, n in enumerate(names)}
        self.names = np.array(names, object)
        self.n_items = np.array([len(x) for x in rows.values()], np.int64)
        self.items = np.array([number[n] for x in rows.values() for n in sorted(x)], np.int64)
        self.shortest = int(self.lengths.min(initial=window))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def _shard(texts: list[pa.Array], phrases: Phrases):
    """Per document of the shard: words, merged hit ranges in words and in bytes, names of items."""
    n_words, starts, ends, doc_at, first_doc, byte_at = [], [], [], [], 0, []
    seq, where, base = [np.zeros(1, np.int64)], [np.full(1, -1, np.int64)], 0
    for part in texts:
        w = K.words(part, K.ITEM)
        n_words.append(np.diff(w.bounds))
        symbol = phrases.symbols(w.hashes)
        doc = np.repeat(np.arange(len(part)), n_words[-1])
        good = symbol > 0
        new = np.ones(len(good), bool)
        new[1:] = ~good[:-1] | (doc[1:] != doc[:-1])
        run_start = np.flatnonzero(good & new)
        stop = np.ones(len(good), bool)
        stop[:-1] = ~good[1:] | (doc[1:] != doc[:-1])
        run_end = np.flatnonzero(good & stop) + 1
        long = run_end - run_start >= phrases.shortest
        run_start, size = run_start[long], (run_end - run_start)[long]
        if len(run_start):
            # each run and one separator after it
            index = K.ragged(run_start, size + 1)
            last = np.cumsum(size + 1) - 1
            inside = np.ones(len(index), bool)
            inside[last] = False
            seq.append(np.where(inside, symbol[np.minimum(index, len(symbol) - 1)], 0))
            where.append(np.where(inside, index + base, -1))
        text_at = K.raw(part)[1]
        starts.append(w.starts - text_at[doc])
        ends.append(w.ends - text_at[doc])
        doc_at.append(doc + first_doc)
        base += len(doc)
        first_doc += len(part)
    n_words = np.concatenate(n_words)
    spans: list[list[int]] = [[] for _ in range(first_doc)]
    cuts: list[list[int]] = [[] for _ in range(first_doc)]
    items: list[list[str]] = [[] for _ in range(first_doc)]
    sequence, where = np.concatenate(seq), np.concatenate(where)
    if len(sequence) > 1 and len(phrases.patterns):
        index = FMIndex(sequence, len(phrases.vocabulary) + 1)
        low, high = index.search(phrases.patterns, phrases.lengths)
        found = np.flatnonzero(high > low)
        if len(found):
            count = (high - low)[found]
            at = where[index.locate(K.ragged(low[found], count))]
            pattern = np.repeat(found, count)
            doc_at, starts, ends = np.concatenate(doc_at), np.concatenate(starts), np.concatenate(ends)
            cover = np.zeros(base + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + phrases.lengths[pattern], -1)
            hit = np.cumsum(cover)[:-1] > 0
            part = np.ones(base, bool)
            part[1:] = ~hit[:-1] | (doc_at[1:] != doc_at[:-1])
            a = np.flatnonzero(hit & part)
            part[:-1] = ~hit[1:] | (doc_at[1:] != doc_at[:-1])
            part[-1] = True
            b = np.flatnonzero(hit & part)
            word0 = np.concatenate([[0], np.cumsum(n_words)])
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                d = doc_at[x]
                spans[d] += [x - int(word0[d]), y + 1 - int(word0[d])]
                cuts[d] += [int(starts[x]), int(ends[y])]
            first = np.concatenate([[0], np.cumsum(phrases.n_items)])
            owner = phrases.items[K.ragged(first[pattern], phrases.n_items[pattern])]
            docs = np.repeat(doc_at[at], phrases.n_items[pattern])
            pair = np.unique(docs * len(phrases.names) + owner)
            for d, k in zip((pair // len(phrases.names)).tolist(), (pair % len(phrases.names)).tolist(), strict=True):
                items[d].append(phrases.names[k])
    return n_words, spans, cuts, items


@F.arrow_udf(T.ArrayType(T.LongType()))
def _merged(spans: pa.Array) -> pa.Array:
    """Lists of [start, end) in any order, flat, as sorted ranges that do not touch; all lists of a batch at once."""
    flat = spans.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
    row = np.repeat(np.arange(len(spans)), pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False) // 2)
    order = np.lexsort((flat[:, 0], row))
    row, (start, end) = row[order], flat[order].T
    reach = np.maximum.accumulate(end + (row << 40))  # rows one after the other
    new = np.ones(len(row), bool)
    new[1:] = start[1:] + (row[1:] << 40) > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row))[: len(first)] - 1
    out = np.stack([start[first], reach[last] - (row[last] << 40)], axis=1).ravel()
    at = 2 * np.searchsorted(row[first], np.arange(len(spans) + 1))
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(out, pa.int64()))


def _without(text: str, cuts: list[int]) -> str:
    """The text without these ranges of bytes; they start and end at word edges, so that no character is cut."""
    raw, at, pieces = text.encode(), 0, []
    for s, e in zip(cuts[::2], cuts[1::2], strict=True):
        pieces.append(raw[at:s])
        at = e
    return b"".join([*pieces, raw[at:]]).decode()


@F.arrow_udf(T.StringType())
def _cut(texts: pa.Array, cuts: pa.Array) -> pa.Array:
    """Texts without ranges of their bytes; null where there is no range."""
    return pa.array([_without(t, c) if c else None for t, c in zip(texts.to_pylist(), cuts.to_pylist(), strict=True)], pa.string())


def runs(benchmark: DataFrame, window: int, most: int) -> Iterator[tuple[str, np.ndarray]]:
    """Items as hashes of their words; one of more than `most` windows in runs that overlap by window - 1 words, which
    have all its windows between them."""
    for name, text in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text").toLocalIterator():
        hashes = K.words(pa.array([text], pa.string()), K.ITEM).hashes
        for k in range(0, max(1, len(hashes) - window + 1) if len(hashes) else 0, most):
            yield name, hashes[k : k + most + window - 1]


def blocks(benchmark: DataFrame, window: int, block_windows: int) -> Iterator[tuple[Phrases, bool]]:
    """The benchmark's phrases in blocks of at most block_windows windows, and whether more come. The driver holds one
    block and the run after it."""
    rows: list[tuple[str, np.ndarray]] = []
    size = 0
    for name, hashes in runs(benchmark, window, block_windows):
        n = max(1, len(hashes) - window + 1)
        if rows and size + n > block_windows:
            yield Phrases(rows, window), True
            rows, size = [], 0
        rows.append((name, hashes))
        size += n
    yield Phrases(rows, window), False


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, columns: list[str] | None = None, clean: bool = False) -> DataFrame:
    """The columns asked for (all by default), the text without hit words if `clean`, with `n_words`, `hit_spans` (merged
    [start, end) in words, flat), `hit_bytes` (the same in bytes of the text's UTF-8), and `hit_items` (sorted as
    strings)."""
    spark = docs.sparkSession
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() not in OUT]
    outer = {c: f"_c{k}" for k, c in enumerate(dict.fromkeys([*columns, text]))}
    out = docs.select(*[F.col(quoted(c)).alias(n) for c, n in outer.items()])
    first = True
    for phrases, more in blocks(benchmark, window, block_windows):
        block = spark.sparkContext.broadcast(phrases)
        found = K.told(out, outer[text], _search(block), FIELDS, SHARD)
        if not first:  # beside what the blocks before have found
            found = found.withColumns({"_spans": _merged(F.concat("_s", "_spans")), "_bytes": _merged(F.concat("_b", "_bytes")), "_items": F.array_sort(F.array_union("_i", "_items"))}).drop("_s", "_b", "_i")
        if more:
            out = keep(found.drop("_n_words"), "hits").withColumnsRenamed({"_spans": "_s", "_bytes": "_b", "_items": "_i"})
            block.destroy()
        first = False
    if clean and text in columns:
        hit = F.size("_bytes") > 0
        found = found.withColumn(outer[text], F.when(hit, _cut(F.when(hit, F.col(outer[text])), F.when(hit, F.col("_bytes")))).otherwise(F.col(outer[text])))
    return found.select(*[F.col(outer[c]).alias(c) for c in columns], *[F.col(s).alias(n) for s, n in zip(FIELDS, OUT, strict=True)])


def _search(block):
    def search(texts: pa.Array) -> list[pa.Array]:
        n_words, spans, cuts, items = _shard([texts], block.value)
        lists = pa.list_(pa.int64())
        return [pa.array(n_words, pa.int64()), pa.array(spans, lists), pa.array(cuts, lists), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]

    return search


def digest(found: DataFrame) -> DataFrame:
    """doc_id and what was hit, as numbers and a hash."""
    n_hit = F.aggregate(F.transform("hit_spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    return digest(decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), columns=["doc_id"]))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS n, array_to_string(w[i : i + least({WINDOW}, len(w)) - 1], ' ') AS win
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT DISTINCT rid, i, dw.n, item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM occ) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
