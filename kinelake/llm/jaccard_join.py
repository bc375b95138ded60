"""N-gram Jaccard self-join with rare-first prefix, length, positional and suffix filters.

A document is its set of distinct word n-grams. All sets use one total order, rarest n-grams first; two sets that are
alike enough share an n-gram in their short prefixes, so only prefixes are dealt out and joined. Then:

- length filter: the smaller set has at least the threshold's part of the larger one's size;
- positional filter: what is left behind the shared n-gram can still reach the needed overlap;
- suffix filter: the sets are parted at fixed n-grams, and differences of the parts' sizes bound the overlap;
- verification: each remaining pair is merged once, with exact integer arithmetic.

Rarity comes from counts of all n-grams of all documents in a table of fixed size (hash bins; a bin's count bounds the
count of each n-gram in it). The order it gives is the same everywhere, which is all that the filters need; the rarer
its first n-grams really are, the fewer pairs meet.

Equal sets are one class from the start and only the class's smallest document is joined. Within an n-gram with many
classes, all pairs are never emitted: each class meets the n-gram's first class and its neighbour in order of size;
components of the links found that way leave, for each n-gram, the classes that are still apart, and only those are
compared across, in blocks of like size whose verification happens inside the task (links come out, not pairs). What is
sent to the blocks are sizes of parts, 64 bytes a class; texts follow only of classes that another one of their unit is
near to by these. Wherever sets are compared, texts are sent and their sets made again: a set has several times the bytes
of its text. So the components are exact, whatever the size of a group, while work within a group of true copies is linear. What comes out
are components of all links, not the links themselves: within a component not every pair is looked at.

Defined results: documents without words (null, empty, white space) link with nothing and are their own component;
documents with fewer words than n have their whole sequence as the one n-gram; repeated doc_ids are one document with
several texts, each row is returned; a null doc_id links with nothing and has no component; an empty table gives an
empty one; only the id and the text of docs are read, so that other columns do not matter; texts of any length are
read whole, and blocks are bounded by the sizes of their sets too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.llm import textkit as K
from kinelake.llm.components import components
from kinelake.llm.store import done, keep, n_partitions, scratch

#: Bins of the rarity table (one byte each once broadcast) and counts that a row of its partial sums holds.
BINS, ROW = 1 << 20, 1 << 14
#: Classes that share an n-gram and are all paired with each other; beyond that they meet by pivot and neighbour.
GROUP = 48
#: Classes from which an n-gram is handled where its rows are, without dealing them out, and how many such at most.
HOT, HOT_KINDS = 8192, 1 << 15
#: Classes to a block when those still apart are compared, and n-grams of all its sets, in the mean.
BLOCK, BLOCK_GRAMS = 256, 1 << 20
#: Bits for each document in the filter that tells whose sets are needed, and bits of the largest filter; where more
#: documents are asked for, they are joined by id.
FILTER_EACH, FILTER_MOST = 16, 1 << 27


def need(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of sets of these sizes that are alike enough."""
    return -(-percent * (x + y) // (100 + percent))


def probe_length(x, percent: int):
    return x - -(-percent * x // 100) + 1


def index_length(x, percent: int):
    return x - -(-2 * percent * x // (100 + percent)) + 1


def sets(texts: pa.Array, n: int, classes: np.ndarray | None) -> Iterator[np.ndarray]:
    """Each document's distinct n-grams in rare-first order: the rarity class, then 56 bits of the hash."""
    found, at = K.shingles(K.words(texts), n)
    if classes is not None:
        found = (classes[found >> np.uint64(44)].astype(np.uint64) << np.uint64(56)) | (found >> np.uint64(8))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        one = np.sort(found[a:b])
        yield one[np.concatenate([[True], one[1:] != one[:-1]])] if len(one) > 1 else one


def rarity(docs: DataFrame, n: int):
    """Rarity class of each bin of n-gram hashes, from all texts; a broadcast of BINS bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for part in K.slices(batch):
                total += np.bincount((K.shingles(K.words(part.column(0)), n)[0] >> np.uint64(44)).astype(np.int64), minlength=BINS)
        yield from rows(dict(enumerate(total.reshape(-1, ROW))) if total.any() else {})
        K.tidy()

    def rows(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k, v in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v.astype("<i8").tobytes()], pa.binary())], names=["k", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[k] = np.frombuffer(v, "<i8") + found.get(k, 0)
        yield from rows(found)

    partial = docs.select("text").mapInArrow(count, "k int, v binary")
    total = np.zeros((BINS // ROW, ROW), np.int64)
    for k, v in partial.repartition(min(BINS // ROW, n_partitions(docs.sparkSession)), "k").mapInArrow(add, "k int, v binary").collect():
        total[k] += np.frombuffer(v, "<i8")
    return docs.sparkSession.sparkContext.broadcast(np.minimum(4 * np.log2(1.0 + total.ravel()), 255).astype(np.uint8))


def _prefixes(n: int, percent: int, classes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch):
                size, digest, prefix, parts = [], [], [], []
                for s in sets(part.column("text"), n, classes.value):
                    size.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    parts.append(_told(s))
                    prefix.append(s[: probe_length(len(s), percent) if len(s) else 0].view(np.int64))
                flat = np.concatenate([np.zeros(0, np.int64), *prefix])
                at = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(at, flat), pa.array(parts, pa.binary())], names=["doc_id", "n", "digest", "prefix", "parts"])
        K.tidy()

    return run


def _fits(n1, p1, n2, p2, percent: int) -> np.ndarray:
    """Length and positional filters for a shared n-gram, n1 <= n2; the smaller set's place must be in its index prefix."""
    rest = np.minimum(n1 - p1, n2 - p2)
    return (100 * n1 >= percent * n2) & (p1 < index_length(n1, percent)) & (rest >= need(n1, n2, percent))


def _pairs(percent: int, group: int):
    """Candidate pairs (0, a, b) of n-grams in order, and (1, n-gram, 0) for those with more than `group` classes."""

    def out(kind, a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind), pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), np.int64)  # of the last n-gram seen: all its rows, or once it is large its first and last
        large = False
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if not rows.shape[1]:
                continue
            rows = np.concatenate([held, rows], axis=1)
            gram = rows[0]
            start = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
            size = np.diff(np.append(start, len(gram)))
            which = np.repeat(np.arange(len(start)), size)
            big = size > group
            big[0] |= large
            in_big = big[which]
            a, b = [], []
            # large ones: with the first and with the one before
            at = np.flatnonzero(in_big & (np.arange(len(gram)) > start[which]))
            if large:
                at = at[at >= held.shape[1]]
            for other in (start[which[at]], at - 1):
                ok = _fits(rows[2][other], rows[3][other], rows[2][at], rows[3][at], percent)
                a.append(rows[1][other][ok])
                b.append(rows[1][at][ok])
            # small ones that have ended: all pairs
            ended = which < len(start) - 1
            whole = np.flatnonzero(~in_big & ended)
            g, doc, n, p = rows[:, whole]
            for d in range(1, group):
                same = np.flatnonzero(g[d:] == g[:-d])
                if not len(same):
                    break
                ok = same[_fits(n[same], p[same], n[same + d], p[same + d], percent)]
                a.append(doc[ok])
                b.append(doc[ok + d])
            a, b = np.concatenate(a), np.concatenate(b)
            yield out(0, a[a != b], b[a != b])
            done = gram[start[:-1]][big[:-1]]
            if len(done):
                yield out(1, done, np.zeros(len(done), np.int64))
            large = bool(big[-1])
            last = rows[:, start[-1] :]
            held = last[:, [0, -1]] if large else last
        if large:
            yield out(1, held[0][:1], np.zeros(1, np.int64))
        elif held.shape[1] > 1:
            i, j = np.triu_indices(held.shape[1], 1)
            ok = _fits(held[2][i], held[3][i], held[2][j], held[3][j], percent) & (held[1][i] != held[1][j])
            yield out(0, held[1][i][ok], held[1][j][ok])
        K.tidy()

    return run


def _parts(s: np.ndarray) -> np.ndarray:
    """Sizes of the parts of a set between fixed n-grams, by the hash's upper bits."""
    return np.bincount(((s >> np.uint64(50)) & np.uint64(63)).astype(np.int64), minlength=64)


def _told(s: np.ndarray) -> bytes:
    """Sizes of a set's parts in a byte each. What is beyond 255 counts as 255, which only makes differences smaller."""
    return np.minimum(_parts(s), 255).astype("u1").tobytes()


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Suffix filter, then the exact overlap of two sets in order."""
    least = int(need(len(x), len(y), percent))
    if min(len(x), len(y)) < least or int(np.abs(_parts(x) - _parts(y)).sum()) > len(x) + len(y) - 2 * least:
        return False
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum()) >= least


def _verify(n: int, percent: int, classes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in K.slices(batch, "x"):
                for part in K.slices(some, "y"):
                    two = zip(*(sets(part.column(c), n, classes.value) for c in "xy"), strict=True)
                    ok = pa.array([alike(p, q, percent) for p, q in two], pa.bool_())
                    yield pa.RecordBatch.from_arrays([part.column(k).filter(ok) for k in (0, 1)], names=["a", "b"])
        K.tidy()

    return run


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents in `ids`, and of the few that share a filter bit with one of them."""
    spark = docs.sparkSession
    bits = max(1 << 16, 1 << (FILTER_EACH * ids.count() - 1).bit_length())
    asked = docs.select("doc_id", "text")
    if bits > FILTER_MOST:
        return asked.join(ids, "doc_id", "left_semi")
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(bits).cast("long"))
    marks = ids.select(bit.alias("b")).select(F.floor(F.col("b") / 32).cast("int").alias("w"), F.expr("shiftleft(1L, CAST(b % 32 AS INT))").alias("m")).groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    words = np.zeros(bits // 32, np.uint32)
    words[marks["w"].to_numpy()] = marks["m"].to_numpy().astype(np.uint32)
    marked = spark.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("bit").to_numpy(zero_copy_only=False)
            ok = pa.array((marked.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(ok) for k in (0, 1)], names=["doc_id", "text"])
        K.tidy()

    return asked.withColumn("bit", bit).mapInArrow(run, "doc_id long, text string")


def _suffix_filter(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n1, n2 = (batch.column(k).to_numpy() for k in (2, 3))
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "u1").reshape(-1, 64).astype(np.int64) for k in (4, 5))
                ok = pa.array(np.abs(x - y).sum(axis=1) <= n1 + n2 - 2 * need(n1, n2, percent))
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    return run


def _linked(pairs: DataFrame, reps: DataFrame, docs: DataFrame, n: int, percent: int, classes) -> DataFrame:
    """Those of the pairs (a, b) that are alike enough: by sizes of parts first, then each verified once by its sets."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sizes = reps.select("rep", "n", "parts")
    told = pairs.join(sizes.toDF("a", "n1", "x"), "a").join(sizes.toDF("b", "n2", "y"), "b").select("a", "b", "n1", "n2", "x", "y")
    pairs = keep(told.mapInArrow(_suffix_filter(percent), "a long, b long").distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    found = keep(_texts_of(docs, ids), "texts")
    left, right = found.toDF("a", "x"), found.toDF("b", "y")
    out = keep(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_verify(n, percent, classes), "a long, b long"), "linked")
    done(found)
    return out


def _near(percent: int):
    """Those rows of a unit whose class is near, by sizes of parts, to one of the other side in another component."""

    def run(key, table):
        side, comp, size = (table.column(c).to_numpy() for c in ("side", "comp", "size"))
        part = np.frombuffer(b"".join(table.column("parts").to_pylist()), "u1").reshape(-1, 64).astype(np.int16)
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if (side == 1).any() else left
        ok = np.zeros(len(side), bool)
        for i in left:
            over = size[i] + size[right] - 2 * need(size[i], size[right], percent)
            near = right[(comp[right] != comp[i]) & (over >= np.abs(size[i] - size[right]))]
            over = size[i] + size[near] - 2 * need(size[i], size[near], percent)
            near = near[np.abs(part[near] - part[i]).sum(axis=1) <= over]
            ok[near] = True
            ok[i] |= len(near) > 0
        return table.filter(pa.array(ok)).select(["gram", "ps", "qo", "qs", "side", "doc", "comp"])

    return run


def _apart(n: int, percent: int, classes):
    """Links across the two sides of a unit of classes that share an n-gram; ends early inside a component."""

    def run(key, table):
        side, doc, comp = (table.column(c).to_numpy() for c in ("side", "doc", "comp"))
        data = list(sets(pa.concat_arrays(table.column("text").chunks), n, classes.value))
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        size = np.array([len(x) for x in data], np.int64)
        part = np.stack([_parts(x) for x in data])
        a, b = [], []
        right = np.flatnonzero(side == 1) if (side == 1).any() else np.flatnonzero(side == 0)
        for i in np.flatnonzero(side == 0):
            over = size[i] + size[right] - 2 * need(size[i], size[right], percent)
            ok = (over >= np.abs(size[i] - size[right])) & (np.abs(part[right] - part[i]).sum(axis=1) <= over) & (doc[right] != doc[i])
            for j in right[ok]:
                if root(comp[i]) != root(comp[j]) and alike(data[i], data[j], percent):
                    parent[root(comp[i])] = root(comp[j])
                    a.append(doc[i])
                    b.append(doc[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _across(members: DataFrame, roots: DataFrame, reps: DataFrame, docs: DataFrame, n: int, percent: int, classes) -> DataFrame | None:
    """Links between classes that share an n-gram of `members` (gram, doc, size) and are in different components."""
    up = roots.select(F.col("node").alias("doc"), "root")
    here = keep(members.join(up, "doc", "left").select("gram", "doc", "size", F.coalesce("root", "doc").alias("comp")), "members")
    # n-grams with the same members ask the same; one is enough
    about = here.groupBy("gram").agg(F.count("*").alias("m"), F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("h"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    open_ = keep(about.filter("lo < hi").groupBy("m", "h").agg(F.min("gram").alias("gram")).select("gram"), "grams")
    if not open_.take(1):
        return None
    left = here.join(open_, "gram")
    by_comp = left.groupBy("gram", "comp").agg(F.count("*").alias("k"))
    main = by_comp.groupBy("gram").agg(F.max(F.struct("k", "comp"))["comp"].alias("main"))
    # blocks of documents whose sizes are in one step of the threshold, those of the main component apart from the others;
    # alike sets are in one step or in two that follow each other
    step = F.floor(F.log(F.col("size")) / float(np.log(100 / percent)) + 1e-9).cast("int") if percent < 100 else F.col("size").cast("int")
    told = left.join(main, "gram").withColumns({"odd": F.col("comp") != F.col("main"), "step": step})
    counts = told.groupBy("gram", "odd", "step").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_GRAMS), F.lit(1)).alias("c"))
    slot = F.pmod(F.xxhash64("doc", "gram"), F.col("c")).cast("int")
    placed = keep(told.join(counts, ["gram", "odd", "step"]).withColumn("slot", slot).select("gram", "odd", "step", "slot", "doc", "comp", "size"), "blocks")
    blocks = placed.groupBy("gram", "odd", "step", "slot").agg(F.min("size").alias("s0"), F.max("size").alias("s1"))
    p, q = blocks.filter("odd").withColumn("near", F.explode(F.array(*[F.col("step") + k for k in (-1, 0, 1)]))).alias("p"), blocks.alias("q")
    near = 100 * F.least(F.col("p.s1"), F.col("q.s1")) >= percent * F.greatest(F.col("p.s0"), F.col("q.s0"))
    once = ~F.col("q.odd") | (F.struct("q.step", "q.slot") >= F.struct("p.step", "p.slot"))
    units = p.join(q, (F.col("p.gram") == F.col("q.gram")) & (F.col("p.near") == F.col("q.step")) & once & near).select(
        F.col("p.gram").alias("gram"), F.struct("p.step", "p.slot").alias("ps"), F.col("q.odd").alias("qo"), F.struct("q.step", "q.slot").alias("qs")
    )
    first = units.select("gram", F.lit(True).alias("odd"), F.col("ps.step").alias("step"), F.col("ps.slot").alias("slot"), F.lit(0).alias("side"), "ps", "qo", "qs")
    second = units.filter("NOT qo OR qs <> ps").select("gram", F.col("qo").alias("odd"), F.col("qs.step").alias("step"), F.col("qs.slot").alias("slot"), F.lit(1).alias("side"), "ps", "qo", "qs")
    work = placed.join(first.unionByName(second), ["gram", "odd", "step", "slot"]).select("gram", "ps", "qo", "qs", "side", "doc", "comp")
    told = work.join(reps.select(F.col("rep").alias("doc"), F.col("n").alias("size"), "parts"), "doc")
    near = keep(told.groupBy("gram", "ps", "qo", "qs").applyInArrow(_near(percent), work.schema).distinct(), "near")
    found = keep(_texts_of(docs, near.select(F.col("doc").alias("doc_id")).distinct()).toDF("doc", "text"), "texts")
    out = keep(near.join(found, "doc").groupBy("gram", "ps", "qo", "qs").applyInArrow(_apart(n, percent, classes), "a long, b long"), "links")
    done(found)
    return out


def jaccard_components(docs: DataFrame, n: int, percent: int, doc_id: str = "doc_id", text: str = "text", group: int = GROUP, hot: int = HOT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of docs; links: 100 * overlap >= percent * union."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    with scratch(docs.sparkSession):
        return keep(_components(docs, n, percent, group, hot), "components", result=True)


def _components(docs: DataFrame, n: int, percent: int, group: int, hot: int) -> DataFrame:
    classes = rarity(docs, n)
    table = keep(docs.mapInArrow(_prefixes(n, percent, classes), "doc_id long, n long, digest binary, prefix array<long>, parts binary"), "prefixes")
    able = table.filter("n > 0 AND doc_id IS NOT NULL")
    reps = keep(able.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("parts").alias("parts")), "classes")
    prefixes, table = table, keep(table.select("doc_id", "n", "digest"), "documents")
    able = table.filter("n > 0 AND doc_id IS NOT NULL")
    done(prefixes)
    posting = reps.select("rep", "n", F.posexplode("prefix").alias("pos", "gram")).select("gram", F.col("rep").alias("doc"), "n", F.col("pos").cast("long").alias("pos"))

    # n-grams with so many classes that one task should not have them all; the rarity class bounds their number
    total = reps.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
    least = max(hot, total // HOT_KINDS)
    maybe = posting.filter(F.shiftrightunsigned("gram", 56) >= int(4 * np.log2(1.0 + least)))
    first = F.min(F.struct("n", "doc", "pos"))
    hot_grams = keep(maybe.groupBy("gram").agg(F.count("*").alias("m"), first.alias("first")).filter(F.col("m") > least).select("gram", F.col("first.n").alias("n0"), F.col("first.doc").alias("doc0"), F.col("first.pos").alias("pos0")), "hot")
    if hot_grams.take(1):
        small = F.broadcast(hot_grams)  # HOT_KINDS rows at most
        meet = posting.join(small, "gram").filter("doc <> doc0 AND 100 * n0 >= %d * n" % percent).select(F.lit(0).alias("kind"), F.col("doc0").alias("a"), F.col("doc").alias("b"))
        more = meet.unionByName(hot_grams.select(F.lit(1).alias("kind"), F.col("gram").alias("a"), F.lit(0).cast("long").alias("b")))
        cold = posting.join(small, "gram", "left_anti")
    else:
        more, cold = None, posting
    dealt = cold.repartition(n_partitions(docs.sparkSession), "gram").sortWithinPartitions("gram", "n", "doc")
    met = dealt.mapInArrow(_pairs(percent, group), "kind int, a long, b long")
    met = keep(met if more is None else met.unionByName(more), "met")

    # a document with several texts joins their classes
    mine = able.select("digest", "doc_id").join(reps.select("digest", "rep"), "digest").select("doc_id", "rep").distinct()
    twice = mine.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.collect_set("rep").alias("all")).filter("a < b").select("a", F.explode("all").alias("b")).filter("a < b")

    links = keep(_linked(met.filter("kind = 0").select("a", "b"), reps, docs, n, percent, classes).unionByName(twice), "links")
    roots = components(links)
    large = met.filter("kind = 1").select(F.col("a").alias("gram")).distinct()
    if large.take(1):
        members = posting.join(large, "gram").select("gram", "doc", F.col("n").alias("size")).distinct()
        more_links = _across(members, roots, reps, docs, n, percent, classes)
        if more_links is not None:
            roots = components(links.unionByName(more_links))

    up = roots.select(F.col("node").alias("rep"), "root")
    named = reps.select("digest", "rep").join(up, "rep", "left").select(F.col("digest").alias("_d"), F.coalesce("root", "rep").alias("_root"))
    out = table.select("doc_id", "n", "digest")
    return out.join(named, (out["digest"] == named["_d"]) & out["doc_id"].isNotNull() & (out["n"] > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("_root", "doc_id").alias("component_id")
    )


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def _sql(n: int, percent: int) -> str:
    """All pairs of rows that share an n-gram, and what each document reaches by links."""
    run = ", ".join(["w", *[f"lead(w, {k}) OVER q" for k in range(1, n)]])
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT r, len(ws) AS m, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT r, m, i, concat_ws(' ', {run}) AS s FROM w WINDOW q AS (PARTITION BY r ORDER BY i)),
h AS MATERIALIZED (SELECT DISTINCT r, s FROM g WHERE i <= greatest(m - {n - 1}, 1)),
c AS MATERIALIZED (SELECT r, count(*) AS n FROM h GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS k FROM h a JOIN h b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
l AS (SELECT dx.doc_id AS x, dy.doc_id AS y FROM p JOIN c cx ON cx.r = x JOIN c cy ON cy.r = y JOIN d dx ON dx.r = x JOIN d dy ON dy.r = y WHERE 100 * k >= {percent} * (cx.n + cy.n - k)),
e AS MATERIALIZED (SELECT x, y FROM l WHERE x <> y UNION SELECT y, x FROM l WHERE x <> y),
t AS (SELECT DISTINCT doc_id AS x, doc_id AS y FROM d WHERE doc_id IS NOT NULL UNION SELECT t.x, e.y FROM t JOIN e ON e.x = t.y),
m AS (SELECT x, min(y) AS root FROM t GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, root AS component_id FROM d LEFT JOIN c ON c.r = d.r LEFT JOIN m ON m.x = d.doc_id
"""


OP2_SQL = _sql(3, 90)
