"""Class-based bigram language model: exchange clustering, class transitions, word emissions.

Words are clustered by exchange: a word moves to the class that raises the likelihood of the class bigrams most.
- The `core` most frequent words start, with all their bigrams, until no word moves or `rounds` are over.
- The `classed` most frequent words (the core among them) are exchanged in `passes` passes over all training texts, each
  word by the classes that it has around it, counted over the whole corpus with the classes of the pass before. The
  bigrams of classes follow the moves; only where two neighbours move in the same pass do they stay an estimate.
- Every other word that occurs `least` times, however many there are, takes the class that the classes around all its
  occurrences speak for, in a table over all machines.
Words below `least` share one class, in which a word's emission is its smoothed count, and which stands for words never
seen; the end of a text is a class of its own, and the state before its first word.

All counts are over all training texts. The vocabulary itself never goes to one machine: the `head` most frequent
words are a broadcast of fixed size, and every rarer word of a text meets its count and class in a join, once for each
text that has it. Texts are read once after the classes are settled; what is kept of them is one byte per token.

P(text) = product over tokens of P(class | class before) * P(word | class), with
P(class | before) = (n(before, class) + weight * P(class)) / (n(before) + weight).

Defined results: null, empty and blank texts are one end token; repeated rows are each scored (and counted, where they
are training rows); with no training rows all counts are 0 and scores come from smoothing alone; an empty table gives
an empty one; only the id and the text of docs are read, so that other columns do not matter; texts of any length are
read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.llm import dense
from kinelake.llm import textkit as K
from kinelake.llm.store import keep, n_partitions, scratch

HEAD, CLASSED, CORE, CLASSES, ROUNDS, WEIGHT = 1 << 19, 1 << 14, 1024, 48, 12, 20.0
PASSES, LEAST = 2, 2
#: The end of a text among hashes of words.
END = np.uint64(0x656E64)
#: A token whose state is not settled yet; there are fewer states.
OPEN = 255


def numbered(hashes: np.ndarray) -> K.Table:
    """Numbers of these words in their order."""
    out = K.Table(max(8, (2 * len(hashes)).bit_length()))
    out.add(hashes, 0)
    return out


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and then the end, and each text's range."""
    w = K.words(texts)
    size = np.diff(w.bounds)
    at = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(int(at[-1]), END, np.uint64)
    out[K.ragged(at[:-1], size)] = w.hashes
    return out, at


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c): every distinct training token by hash, and its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [np.unique(tokens(part.column(0))[0], return_counts=True) for part in K.slices(batch)]
            if seen:
                h, c = np.concatenate([s[0] for s in seen]), np.concatenate([s[1] for s in seen])
                known, which = np.unique(h, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(np.bincount(which, c).astype(np.int64))], names=["word", "c"])
        K.tidy()

    return train.select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, n: int) -> DataFrame:
    """At most n words, all those above some count. The count is found from a histogram in 64 steps to a doubling, a
    few thousand rows whatever the vocabulary, so that no task and no driver sorts words."""
    step = F.floor(F.log2("c") * 64)
    least, total = 0, 0
    for row in sorted(counts.groupBy(step.alias("s")).count().collect(), reverse=True):
        total += row[1]
        if total > n:
            least = row[0] + 1
            break
    return counts.filter(step >= least)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def gains(c: np.ndarray, r: np.ndarray, left: np.ndarray, self_: float, classes: int) -> np.ndarray:
    """What each of the first `classes` classes gains in likelihood by a word that is in none: `c` has the bigrams of
    classes without the word, `r` and `left` its counts before and behind each class, `self_` those with itself.

    The objective is the likelihood of the class bigrams: sum of C log C over pairs of classes less the sums of n log n
    over the classes as first and as second member."""
    first, second, d = c.sum(axis=1)[:classes], c.sum(axis=0)[:classes], np.arange(classes)
    row = _xlogx(c[:classes] + r) - _xlogx(c[:classes])
    col = _xlogx(c[:, :classes].T + left) - _xlogx(c[:, :classes].T)
    diagonal = _xlogx(c[d, d] + r[:classes] + left[:classes] + self_) - _xlogx(c[d, d])
    gain = row.sum(axis=1) - row[d, d] + col.sum(axis=1) - col[d, d] + diagonal
    return gain - (_xlogx(first + r.sum() + self_) - _xlogx(first) + _xlogx(second + left.sum() + self_) - _xlogx(second))


def move(c: np.ndarray, of: int, r: np.ndarray, left: np.ndarray, self_: float, sign: int) -> None:
    """Takes a word's bigrams out of a class (-1) or into it (1)."""
    c[of] += sign * r
    c[:, of] += sign * left
    c[of, of] += sign * self_


def exchange(bigrams: np.ndarray, movable: int, classes: int, rounds: int) -> np.ndarray:
    """Classes of all words: the first `movable` go to 0..classes-1, each further one keeps a class of its own."""
    b = bigrams.astype(float)
    n = len(b)
    k_all = classes + n - movable
    of = np.concatenate([np.arange(movable) % classes, classes + np.arange(n - movable)])
    onehot = np.zeros((n, k_all))
    onehot[np.arange(n), of] = 1
    out, into = b @ onehot, b.T @ onehot  # counts from a word to each class, and from each class to it
    c = onehot.T @ out
    for _ in range(rounds):
        moved = 0
        for w in range(movable):
            a, self_ = of[w], b[w, w]
            r, left = out[w].copy(), into[w].copy()
            r[a] -= self_
            left[a] -= self_
            move(c, a, r, left, self_, -1)
            gain = gains(c, r, left, self_, classes)
            to = int(gain.argmax())
            if gain[to] <= gain[a] + 1e-9:
                to = a
            move(c, to, r, left, self_, 1)
            if to != a:
                moved += 1
                of[w] = to
                out[:, a] -= b[:, w]
                out[:, to] += b[:, w]
                into[:, a] -= b[w]
                into[:, to] += b[w]
        if not moved:
            break
    return of


def exchanged(seen: np.ndarray, joint: np.ndarray, state: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """One round of exchange of many words: each goes, in the order of their numbers, to its best class, by its counts of
    classes before it, behind it and of itself (columns of `seen`) as they were when the round began. Also the bigrams
    of classes afterwards."""
    width, c, state = len(joint), joint.astype(float), state.copy()
    for w in range(len(state)):
        a, self_ = state[w], float(seen[w, -1])
        left, r = seen[w, :width].astype(float), seen[w, width : 2 * width].astype(float)
        r[a] -= self_
        left[a] -= self_
        move(c, a, r, left, self_, -1)
        gain = gains(c, r, left, self_, classes)
        to = int(gain.argmax())
        if a < classes and gain[to] <= gain[a] + 1e-9:
            to = a
        move(c, to, r, left, self_, 1)
        state[w] = to
    return state, np.maximum(c, 0)


def votes(joint: np.ndarray, classes: int) -> np.ndarray:
    """What a pair of classes around a word speaks for: a whole number for each class, so that sums are exact."""
    smooth = joint + 0.5
    prior = smooth.sum(axis=0) / smooth.sum()
    given = np.log(smooth / smooth.sum(axis=1, keepdims=True) / prior)
    before, behind = given[:, :classes], given[:classes].T
    return np.rint((before[:, None] + behind[None]) * 1024).astype(np.int64).reshape(-1, classes)


class Model:
    """States are the classes, then the rare words' class, then the end."""

    def __init__(self, transitions: np.ndarray, per_class: np.ndarray, n_tokens: int, n_words: int, n_end: int, rare: tuple[float, float], weight: float):
        """`per_class` has the tokens of each class, `rare` the tokens and words of the rare words' class."""
        self.end = len(per_class) + 1
        into = transitions.sum(axis=0) + 0.5
        prior = into / into.sum()
        self.step = np.log10((transitions + weight * prior) / (transitions.sum(axis=1, keepdims=True) + weight))
        #: What a token's log count, or count + 1 in the rare words' class, is divided by in its state.
        self.share = np.concatenate([np.log10(np.maximum(per_class, 1)), [np.log10(rare[0] + rare[1] + 1)], [0.0]])
        self.base = np.log10(n_tokens + n_words + 1.0)
        self.n_tokens, self.n_end = n_tokens, n_end


class Classes:
    """The settled classes: of the head on every machine, of all other words in the table `known` (word, c, state)."""

    def __init__(self, hashes, counts, state, joint, known, classed, n_tokens, n_words, n_end):
        self.hashes, self.counts, self.state, self.joint, self.known, self.classed = hashes, counts, state, joint, known, classed
        self.n_tokens, self.n_words, self.n_end = n_tokens, n_words, n_end


def learn(train: DataFrame, head: int, classed: int, core: int, classes: int, rounds: int, passes: int, least: int) -> Classes:
    counts = keep(word_counts(train), "words")
    n_words, n_tokens, n_end = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.max(F.when(F.col("word") == int(END), F.col("c"))), F.lit(0))).first()
    spark = train.sparkSession
    top = most_frequent(counts.filter(F.col("word") != int(END)), head).toArrow()
    hashes, c = top["word"].to_numpy().view(np.uint64), top["c"].to_numpy()
    by = np.lexsort((hashes, -c))
    hashes, c = hashes[by], c[by]
    core, classed = min(core, len(c)), min(classed, len(c))
    width = classes + 2
    lookup = spark.sparkContext.broadcast(numbered(hashes[:classed]))

    def read(batch: pa.RecordBatch, limit: int = K.SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of every token its hash, its number among the classed words or -1, and whether it is an end."""
        for part in K.slices(batch, limit=limit):
            h, at = tokens(part.column(0))
            end = np.zeros(len(h), bool)
            end[at[1:] - 1] = True
            number = lookup.value.find(h)
            number[end] = -1
            yield h, number, end

    def core_pairs(batch: pa.RecordBatch, held: np.ndarray) -> None:
        for _, number, end in read(batch):
            x = np.where(end, core, np.where((number >= 0) & (number < core), number, core + 1))
            before = np.concatenate([[core], x[:-1]])
            held += np.bincount(before * (core + 2) + x, minlength=held.size).reshape(held.shape)

    of = exchange(dense.total(train.select("text"), core_pairs, (core + 2, core + 2)), core, classes, rounds)
    state = np.full(classed, classes, np.int64)
    state[:core] = of[:core]

    def beside(number: np.ndarray, end: np.ndarray, now: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.where(end, classes + 1, now[number])
        return x, np.concatenate([[classes + 1], x[:-1]]), np.append(x[1:], classes + 1)

    def contexts(now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each classed word its counts of classes before and behind it and of itself before it; bigrams of classes."""
        wide = 2 * width + 1

        def count(batch: pa.RecordBatch, held: np.ndarray) -> None:
            flat = held.reshape(-1)
            for _, number, end in read(batch, 2 * K.SLICE_BYTES):  # the sums of a slice are as wide as the table
                x, before, after = beside(number, end, now)
                some = np.flatnonzero(number >= 0)
                row = number[some] * wide
                same = number[some] == np.concatenate([[-1], number[:-1]])[some]
                cells = np.concatenate([row + before[some], row + width + after[some], row[same] + 2 * width, (classed + before) * wide + x])
                flat += np.bincount(cells, minlength=len(flat))

        total = dense.total(train.select("text"), count, (classed + width, wide))
        return total[:classed], total[classed:, :width]

    for _ in range(max(passes, 1)):
        seen, joint = contexts(np.append(state, classes))
        state, joint = exchanged(seen, joint, state, classes)
    now, table = np.append(state, classes), votes(joint, classes)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, number, end in read(batch):
                _, before, after = beside(number, end, now)
                new = np.flatnonzero((number < 0) & ~end)
                new = new[np.argsort(h[new], kind="stable")]
                word = h[new]
                first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(new) else new
                lists = pa.ListArray.from_arrays(np.append(first, len(new)).astype(np.int32), pa.array((before[new] * width + after[new]).astype(np.int16)))
                yield pa.RecordBatch.from_arrays([pa.array(word[first].view(np.int64)), lists], names=["word", "around"])
        K.tidy()

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int, np.ndarray] | None = None  # the last word, which may go on

        def out(word, c, found):
            state_ = np.where(c >= least, found.argmax(axis=1), classes).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(word), pa.array(c), pa.array(state_)], names=["word", "c", "state"])

        for batch in batches:
            if not batch.num_rows:
                continue
            word, lists = batch.column("word").to_numpy(), batch.column("around")
            at = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy()
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            edge = at[np.append(start, len(word))]
            c, found = np.diff(edge), np.zeros((len(start), classes), np.int64)
            i = 0
            while i < len(start):  # words with some 64 thousand occurrences at once, one with more in parts
                j = max(i + 1, int(np.searchsorted(edge, edge[i] + (1 << 16), "right")) - 1)
                if j == i + 1:
                    for k in range(edge[i], edge[j], 1 << 16):
                        found[i] += table[values[k : min(k + (1 << 16), edge[j])]].sum(axis=0)
                else:
                    found[i:j] = np.add.reduceat(table[values[edge[i] : edge[j]]], edge[i:j] - edge[i])
                i = j
            w = word[start].copy()
            if held is not None and held[0] == w[0]:
                c[0] += held[1]
                found[0] += held[2]
            elif held is not None:
                yield out(np.array([held[0]]), np.array([held[1]]), held[2][None])
            yield out(w[:-1], c[:-1], found[:-1])
            held = int(w[-1]), int(c[-1]), found[-1]
        if held is not None:
            yield out(np.array([held[0]]), np.array([held[1]]), held[2][None])
        K.tidy()

    lists = train.select("text").mapInArrow(others, "word long, around array<smallint>")
    dealt = lists.repartition(n_partitions(spark), "word").sortWithinPartitions("word")
    known = keep(dealt.mapInArrow(assigned, "word long, c long, state int"), "classes")
    if len(c) > classed:
        # a word of the head is one of at least its rarest word's count
        told = known.filter(F.col("c") >= int(c[-1])).select("word", "state").toArrow()
        place = numbered(hashes).find(told["word"].to_numpy().view(np.uint64))
        state = np.append(state, np.zeros(len(c) - classed, np.int64))
        state[place] = told["state"].to_numpy()
    return Classes(hashes, c, state, joint, known, classed, int(n_tokens), int(n_words), int(n_end))


def tail_of(h: np.ndarray, at: np.ndarray, state: np.ndarray) -> pa.Array:
    """Each text's distinct words outside the head, with their places in the text."""
    some = np.flatnonzero(state == OPEN)
    doc = np.searchsorted(at, some, "right") - 1
    order = np.lexsort((some, h[some], doc))
    some, doc = some[order], doc[order]
    word = h[some]
    first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])])) if len(some) else some
    places = pa.ListArray.from_arrays(np.append(first, len(some)).astype(np.int32), pa.array((some - at[doc]).astype(np.int32)))
    each = pa.StructArray.from_arrays([pa.array(word[first].view(np.int64)), places], names=["word", "places"])
    return pa.ListArray.from_arrays(np.searchsorted(doc[first], np.arange(len(at))).astype(np.int32), each)


NAMES = ["doc_id", "held_out", "row", "n_tokens", "n_known", "base", "emit", "states", "tail"]
SCANNED = "held_out boolean, row long, n_tokens long, n_known long, base double, emit double, states binary, tail array<struct<word: bigint, places: array<int>>>"
LINKED = "held_out boolean, n_tokens long, n_known long, base double, emit double, states binary"


def scan(docs: DataFrame, of: Classes, classes: int) -> DataFrame:
    """Every text's tokens as states, a byte each, and sums of logarithms of counts; words outside the head are open."""
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast((numbered(of.hashes), np.append(of.state, OPEN).astype(np.uint8), of.counts))
    end_count, end_known = np.log10(of.n_end + 1.0), of.n_end > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, states, counts = head.value
        more = np.append(np.log10(counts + 1.0), 0.0)
        emit = np.append(np.where(states[:-1] == classes, more[:-1], np.log10(np.maximum(counts, 1))), 0.0)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in K.slices(batch):
                h, at = tokens(part.column("text"))
                number = lookup.find(h)
                end = at[1:] - 1
                number[end] = -1
                state = states[number]
                state[end] = classes + 1
                base, known, emitted = more[number], (number >= 0).astype(np.int64), emit[number]
                base[end], known[end] = end_count, end_known
                n = part.num_rows
                binary = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(state)])
                sums = [np.add.reduceat(x, at[:-1]) for x in (known, base, emitted)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(np.arange(row, row + n)), pa.array(np.diff(at)), *map(pa.array, sums), binary, tail_of(h, at, state)], names=NAMES)
                row += n
        K.tidy()

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {SCANNED}")


def linked(scanned: DataFrame, known: DataFrame, classes: int) -> DataFrame:
    """The scanned texts with every state settled: each text asks once for each of its words outside the head."""
    asked = scanned.select("row", F.explode("tail").alias("t")).select("row", "t.*")
    told = asked.join(known, "word", "left").select("row", F.struct("places", F.coalesce("state", F.lit(classes)).alias("state"), F.coalesce("c", F.lit(0)).alias("c")).alias("a"))
    answers = told.groupBy("row").agg(F.collect_list("a").alias("answers"))
    names = NAMES[:2] + NAMES[3:8]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            at = np.frombuffer(batch.column("states").buffers()[1], np.int32, n + 1, batch.column("states").offset * 4).astype(np.int64)
            states = np.frombuffer(batch.column("states").buffers()[2], np.uint8)[at[0] : at[-1]].copy()
            at -= at[0]
            lists = batch.column("answers")
            count = np.diff(lists.offsets.to_numpy().astype(np.int64))
            count[lists.is_null().to_numpy(zero_copy_only=False)] = 0
            flat = lists.flatten()
            state, c = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("state", "c"))
            places = flat.field("places")
            times = np.diff(places.offsets.to_numpy().astype(np.int64))
            row = np.repeat(np.arange(n), count)
            states[at[np.repeat(row, times)] + places.flatten().to_numpy()] = np.repeat(state, times)
            more = times * np.log10(c + 1.0)
            emit = np.where(state == classes, more, times * np.log10(np.maximum(c, 1)))
            known_ = batch.column("n_known").to_numpy() + np.bincount(row, times * (c > 0), n).astype(np.int64)
            base, emitted = batch.column("base").to_numpy() + np.bincount(row, more, n), batch.column("emit").to_numpy() + np.bincount(row, emit, n)
            binary = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(states)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), batch.column("n_tokens"), pa.array(known_), pa.array(base), pa.array(emitted), binary], names=names)
        K.tidy()

    both = scanned.drop("tail").join(answers, "row", "left").select(*NAMES[:2], *NAMES[3:8], "answers")
    return both.mapInArrow(fill, f"doc_id {scanned.schema['doc_id'].dataType.simpleString()}, {LINKED}")


def _steps(column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All states, those before them, and where each text's start."""
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    x = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].astype(np.int64)
    before = np.concatenate([[end], x[:-1]])
    return x, before, at[:-1] - at[0]


def score(docs: DataFrame, held_out, head: int = HEAD, classed: int = CLASSED, core: int = CORE, classes: int = CLASSES, rounds: int = ROUNDS, weight: float = WEIGHT, passes: int = PASSES, least: int = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity; learns where held_out is false."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    spark = docs.sparkSession
    with scratch(spark):
        of = learn(docs.filter("NOT held_out"), head, classed, core, classes, rounds, passes, least)
        scanned = keep(scan(docs, of, classes), "scanned")
        texts = keep(linked(scanned, of.known, classes), "linked", result=True)
        model = settle(texts.filter("NOT held_out"), of, classes, weight)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, before, at = _steps(batch.column("states"), m.end)
            n = batch.column("n_tokens").to_numpy()
            p = np.add.reduceat(m.step[before, x] - m.share[x], at) + batch.column("emit").to_numpy()
            base = batch.column("base").to_numpy() - n * m.base
            found = [pa.array(np.full(len(n), m.n_tokens)), pa.array(base), pa.array(p), pa.array(10.0 ** (-p / n))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known")), *found], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def settle(train: DataFrame, of: Classes, classes: int, weight: float) -> Model:
    """The model from all training texts' states."""
    width = classes + 2

    def count(batch: pa.RecordBatch, held: np.ndarray) -> None:
        x, before, _ = _steps(batch.column(0), classes + 1)
        held += np.bincount(before * width + x, minlength=held.size).reshape(held.shape)

    transitions = dense.total(train.select("states"), count, (width, width))
    # every token is second in one step
    size = transitions.sum(axis=0)
    head_words = np.bincount(of.state, minlength=classes + 1)
    beyond = {k: n for k, n in of.known.filter(F.col("c") < int(of.counts[-1])).groupBy("state").count().collect()} if len(of.counts) else {}
    rare = int(size[classes]), int(head_words[classes]) + beyond.get(classes, 0)
    return Model(transitions, size[:classes], of.n_tokens, of.n_words, of.n_end, rare, weight)


def remainder(modulus: int, doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo `modulus`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def op3_brown_lm(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    return score(table(spark, sf_dir, "documents"), remainder(7) == 2)
