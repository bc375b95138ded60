"""Quality rules: a linear-chain conditional random field marks every line as content or boilerplate, and a document
stays if enough of its words are in content.

The field: a line with a word has features (hashed words, hashed shapes of words, and measures in steps: length,
signs, digits, capitals, distinct words, a stop at the end, whether it repeats an earlier line), boilerplate has a weight
for each feature, each pair of neighbouring labels one and each first label one. P(labels | lines) is the exponential of
their sum over that of all labellings. It is fitted in numpy by gradient ascent on the likelihood: expected counts come
from the forward-backward recursions, over many documents of like length at once. The best labelling of a document is
found by Viterbi's recursion over all its lines, however many.

Lines have no ratings of their own: those of a document with grade 0 are taken as boilerplate, those of any higher grade
as content. On demand lines of at most `brief` words that are found in at least `shared` documents of the sample are
boilerplate anywhere (licences, notices); by default they are not, as clean documents also share passages. The sample is
bounded: about `size` documents of each grade, see `sampling`.

Beside the field's verdict are plain counts of a text, by its words `[^\\x20\\x09-\\x0D]+`: word_chars, n_symbols,
n_dup_lines, n_repeat_words (words in windows of WINDOW words that occur twice or more). Equality of words, windows and
lines is by 64-bit hashes of their bytes.

Defined results: a null text has no words and counts of 0, as an empty one; texts of fewer than `least_words` words, or
with more than `most_repeated` percent of words repeated, fail whatever their lines are; without any rated document all
lines are content; equal texts have equal results whatever they are read with (each line's sum is taken in the order of
its words); ties of labellings go to content; a very long text is read whole, in a task's memory; an empty table gives
an empty one; columns of docs called like results give way to them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.llm import sampling
from kinelake.llm import textkit as K
from kinelake.llm.bigru import Adam

SIZE, LEAST_WORDS, MOST_REPEATED, WINDOW, CONTENT_SHARE = 1000, 20, 30, 8, 0.5
#: What a line's evidence for boilerplate is lowered by: it is learned from as many documents of either kind, while most
#: documents are clean.
MARGIN = 1.0
BRIEF = 20
WORD_BITS, SHAPE_BITS, STEPS, EPOCHS, RATE, DECAY = 13, 10, 12, 12, 0.05, 1e-4
#: Columns of features: words, shapes of words, then seven measures in steps.
SHAPE_AT, STEP_AT, MEASURES = 1 << WORD_BITS, (1 << WORD_BITS) + (1 << SHAPE_BITS), 7
WIDTH = STEP_AT + MEASURES * STEPS
CONTENT, BOILERPLATE = 0, 1

# fixed values: the symbols that are counted
SYMBOLS = b"#*$%&|<>"


def _marks(of: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(of)] = True
    return table


IS_SYMBOL, IS_DIGIT, IS_UPPER = _marks(SYMBOLS), _marks(b"0123456789"), _marks(bytes(range(65, 91)))
IS_STOP, FIRST_BYTE, LETTER = _marks(b".!?"), np.arange(256) & 0xC0 != 0x80, _marks(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
#: A word's shape: letters, capitals, digits, stops and other signs, as one byte each.
SHAPE = np.where(LETTER, 97, np.where(IS_DIGIT, 48, np.arange(256))).astype(np.uint8)
SHAPE[65:91] = 65


@dataclass
class Lines:
    """Texts by words and by lines with a word; `line` and `doc` tell where each word and each line belongs."""

    data: np.ndarray
    at: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    words: np.ndarray  # each text's range of words
    line: np.ndarray  # of each word
    first: np.ndarray  # each line's first word, with the number of words at the end
    doc: np.ndarray  # of each line
    bounds: np.ndarray  # each text's range of lines
    twin: np.ndarray  # lines equal to an earlier one of their text
    whole: np.ndarray  # hash of each line


def read(texts: pa.Array) -> Lines:
    data, at = K.raw(texts)
    n = len(at) - 1
    starts, ends, words = K.spans(data, at, K.NOT_SPACE)
    hashes = K.hash_spans(data, starts, ends, fold=False)
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([at[:-1][np.diff(at) > 0], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    of = np.searchsorted(line_starts, starts, "right") - 1  # among all lines
    new = np.ones(len(of), bool)
    new[1:] = of[1:] != of[:-1]
    first = np.concatenate([np.flatnonzero(new), [len(of)]])
    used = of[new]
    begin = line_starts[used]
    stop = np.concatenate([line_starts[1:], [len(data)]])[used] if len(used) else begin
    stop = np.where((stop > begin) & (data[np.maximum(stop, 1) - 1] == 10), stop - 1, stop) if len(used) else stop
    doc = np.searchsorted(at, begin, "right") - 1
    whole = K.hash_spans(data, begin, stop, fold=False)
    return Lines(data, at, starts, ends, hashes, words, np.cumsum(new) - 1, first, doc, np.searchsorted(doc, np.arange(n + 1)), repeated(whole, doc), whole)


def repeated(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Marks keys equal to an earlier one of their document."""
    order = np.lexsort((np.arange(len(keys)), keys, doc))
    same = np.zeros(len(keys), bool)
    a, b = order[1:], order[:-1]
    same[a] = (keys[a] == keys[b]) & (doc[a] == doc[b])
    return same


def repeat_words(x: Lines, window: int = WINDOW) -> np.ndarray:
    """Words of each text in windows that occur twice or more in it."""
    n = len(x.words) - 1
    size = np.diff(x.words)
    windows = np.maximum(size - window + 1, 0)
    at = np.concatenate([[0], np.cumsum(windows)])
    doc = np.repeat(np.arange(n), windows)
    start = np.arange(at[-1]) - at[doc] + x.words[:-1][doc]
    key = np.zeros(len(start), np.uint64)
    for k in range(window):
        key = K.mix(key * np.uint64(0xD1342543DE82EF95) + x.hashes[start + k])
    key = K.mix(key + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))  # texts apart
    values, which, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = start[times[which] > 1]
    edge = np.zeros(len(x.starts) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return covered[x.words[1:]] - covered[x.words[:-1]]


def counts(x: Lines, window: int = WINDOW) -> dict[str, np.ndarray]:
    def of(mark: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mark, dtype=np.int64)])
        return total[x.at[1:]] - total[x.at[:-1]]

    twin = np.concatenate([[0], np.cumsum(x.twin)])
    return {
        "n_words": np.diff(x.words),
        "word_chars": of((FIRST_BYTE & K.NOT_SPACE)[x.data]),
        "n_symbols": of(IS_SYMBOL[x.data]),
        "n_dup_lines": twin[x.bounds[1:]] - twin[x.bounds[:-1]],
        "n_repeat_words": repeat_words(x, window),
    }


def features(x: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column, value and line of all features, a line's words in their order and then its measures."""
    n = len(x.doc)
    size = np.diff(x.first)
    share = 1 / np.maximum(size, 1)
    folded = K.hash_spans(x.data, x.starts, x.ends)
    shape = K.hash_spans(SHAPE[x.data], x.starts, x.ends, fold=False)
    first, last = x.starts[x.first[:-1]], x.ends[x.first[1:] - 1]

    def within(mark: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mark, dtype=np.int64)])
        return (total[last] - total[first]) / np.maximum(last - first, 1)

    key = np.sort((x.line.astype(np.uint64) << np.uint64(32)) | (folded >> np.uint64(32)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[new] >> np.uint64(32)).astype(np.int64), minlength=n) * share
    measures = [
        np.log2(size + 1.0) / 16,
        within(IS_SYMBOL[x.data]) * 4,
        within(IS_DIGIT[x.data]),
        within(IS_UPPER[x.data]),
        distinct,
        IS_STOP[x.data[last - 1]] if n else np.zeros(0),
        x.twin,
    ]
    step = np.stack([np.minimum((np.minimum(m, 1) * (STEPS - 1)).astype(np.int64), STEPS - 1) for m in measures])
    step += STEP_AT + STEPS * np.arange(MEASURES)[:, None]
    column = np.concatenate([(folded >> np.uint64(64 - WORD_BITS)).astype(np.int64), SHAPE_AT + (shape >> np.uint64(64 - SHAPE_BITS)).astype(np.int64), step.ravel()])
    value = np.concatenate([share[x.line] * 4, share[x.line] * 8, np.full(MEASURES * n, 0.5)])
    return column, value, np.concatenate([x.line, x.line, np.tile(np.arange(n), MEASURES)])


@dataclass
class Model:
    """Weights of features for boilerplate (those for content are 0), of label pairs (from, to) and of first labels."""

    weights: np.ndarray
    pairs: np.ndarray
    start: np.ndarray

    def scores(self, x: Lines) -> np.ndarray:
        column, value, line = features(x)
        return np.bincount(line, self.weights[column] * value, len(x.doc))


def grid(bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the documents `which` by step and document, and where there are any."""
    size = np.diff(bounds)[which]
    step = np.arange(int(size.max(initial=0)))[:, None]
    live = step < size
    return np.where(live, bounds[:-1][which] + step, 0), live


def likelihood(emit: np.ndarray, live: np.ndarray, pairs: np.ndarray, start: np.ndarray, label: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Mean log likelihood a document, and its gradient by emissions (step, document, label), pairs and start.

    Documents begin at step 0 and each has a line there."""
    steps, batch = live.shape
    e = np.stack([np.zeros_like(emit), emit], axis=2)
    ahead = np.zeros((steps, batch, 2))
    ahead[0] = start + e[0]
    for t in range(1, steps):
        nxt = np.logaddexp(ahead[t - 1, :, 0, None] + pairs[0], ahead[t - 1, :, 1, None] + pairs[1]) + e[t]
        ahead[t] = np.where(live[t, :, None], nxt, ahead[t - 1])
    norm = np.logaddexp(ahead[-1, :, 0], ahead[-1, :, 1])
    back = np.zeros((steps, batch, 2))
    g_pairs = np.zeros((2, 2))
    score = start[label[0]] + np.take_along_axis(e[0], label[0][:, None], 1)[:, 0]
    for t in range(steps - 1, 0, -1):
        into = e[t] + back[t]
        both = ahead[t - 1, :, :, None] + pairs + into[:, None, :] - norm[:, None, None]
        g_pairs -= (np.exp(both) * live[t, :, None, None]).sum(axis=0)
        np.add.at(g_pairs, (label[t - 1][live[t]], label[t][live[t]]), 1)
        score = score + np.where(live[t], pairs[label[t - 1], label[t]] + np.take_along_axis(e[t], label[t][:, None], 1)[:, 0], 0)
        before = np.logaddexp(pairs[:, 0] + into[:, 0, None], pairs[:, 1] + into[:, 1, None])
        back[t - 1] = np.where(live[t, :, None], before, back[t])
    marginal = np.exp(ahead + back - norm[None, :, None])
    g_emit = np.where(live, (label == BOILERPLATE) - marginal[:, :, BOILERPLATE], 0)
    g_start = np.bincount(label[0], minlength=2) - marginal[0].sum(axis=0)
    return float((score - norm).mean()), g_emit / batch, g_pairs / batch, g_start / batch


def viterbi(scores: np.ndarray, bounds: np.ndarray, model: Model) -> np.ndarray:
    """The best label of every line. Documents take their steps together, those with more lines longer."""
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    size, first = size[order], bounds[:-1][order]
    label = np.zeros(len(scores), np.int8)
    most = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(most), "left")  # documents with more lines than each step
    came = np.zeros((len(scores), 2), np.int8)
    best = np.zeros((len(size), 2))
    for t in range(most):
        n = live[t]
        row = first[:n] + t
        if t == 0:
            best[:n] = model.start
        else:
            ways = best[:n, :, None] + model.pairs
            from_1 = ways[:, 1] > ways[:, 0]
            came[row] = from_1
            best[:n] = np.where(from_1, ways[:, 1], ways[:, 0])
        best[:n, BOILERPLATE] += scores[row]
    at = (best[:, 1] > best[:, 0]).astype(np.int8)
    for t in range(most - 1, -1, -1):
        n = live[t]
        row = first[:n] + t
        label[row] = at[:n]
        at[:n] = came[row, at[:n]]
    return label


def targets(x: Lines, graded: np.ndarray, shared: int | None = None, brief: int = BRIEF) -> np.ndarray:
    """A label for every line of a sample."""
    bad = graded[x.doc] == 0
    if shared is None:
        return np.where(bad, BOILERPLATE, CONTENT)
    once = ~x.twin
    values, which, times = np.unique(x.whole, return_inverse=True, return_counts=True)
    found = np.bincount(which[once], minlength=len(values))  # documents that have it
    notice = (found[which] >= shared) & (np.diff(x.first) <= brief)
    return np.where(bad | notice, BOILERPLATE, CONTENT)


def train(texts: list[str], grades: list[int], epochs: int = EPOCHS, batch: int = 32, shared: int | None = None, brief: int = BRIEF, seed: int = 5) -> Model:
    params = {"w": np.zeros(WIDTH), "pairs": np.zeros((2, 2)), "start": np.zeros(2)}
    x = read(pa.array(texts, pa.large_string()))
    docs = np.flatnonzero(np.diff(x.bounds) > 0)
    if not len(docs):
        return Model(params["w"], params["pairs"], params["start"])
    label = targets(x, np.asarray(grades), shared, brief)
    column, value, line = features(x)
    order = np.argsort(line, kind="stable")
    column, value = column[order], value[order]
    first = np.searchsorted(line[order], np.arange(len(x.doc) + 1))
    adam, rng = Adam(params, RATE), np.random.default_rng(seed)
    docs = docs[np.argsort(np.diff(x.bounds)[docs], kind="stable")]
    parts = [docs[i : i + batch] for i in range(0, len(docs), batch)]  # of like length
    for epoch in range(epochs):
        adam.rate = RATE * 0.8**epoch
        for k in rng.permutation(len(parts)).tolist():
            row, live = grid(x.bounds, parts[k])
            lines = row[live]
            n = first[lines + 1] - first[lines]
            at, of = K.ragged(first[lines], n), np.repeat(np.arange(len(lines)), n)
            emit = np.zeros(live.shape)
            emit[live] = np.bincount(of, params["w"][column[at]] * value[at], len(lines))
            _, g_emit, g_pairs, g_start = likelihood(emit, live, params["pairs"], params["start"], np.where(live, label[row], 0))
            g = np.bincount(column[at], g_emit[live][of] * value[at], WIDTH)
            adam.step({"w": DECAY * params["w"] - g, "pairs": DECAY * params["pairs"] - g_pairs, "start": DECAY * params["start"] - g_start})
    return Model(params["w"], params["pairs"], params["start"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", size: int = SIZE, longest: int = sampling.LONGEST, shared: int | None = None, brief: int = BRIEF) -> Model:
    """A field learned from documents that labels (doc_id, an integer grade) rate."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("grade"))
    return train(*sampling.labelled(docs, rows, "grade", size, longest), shared=shared, brief=brief)


FIELDS = {
    "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint",
    "n_lines": "bigint", "n_content_lines": "bigint", "n_content_words": "bigint", "base_failed": "boolean", "kept": "boolean",
}


def judged(texts: pa.Array, model: Model, least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED, share: float = CONTENT_SHARE, margin: float = MARGIN) -> dict[str, np.ndarray]:
    x = read(texts)
    out = counts(x)
    label = viterbi(model.scores(x) - margin, x.bounds, model)
    content = label == CONTENT
    words = np.concatenate([[0], np.cumsum(np.where(content, np.diff(x.first), 0))])
    lines = np.concatenate([[0], np.cumsum(content)])
    a, b = x.bounds[:-1], x.bounds[1:]
    out |= {"n_lines": b - a, "n_content_lines": lines[b] - lines[a], "n_content_words": words[b] - words[a]}
    out["base_failed"] = (out["n_words"] < least_words) | (100 * out["n_repeat_words"] > most_repeated * out["n_words"])
    out["kept"] = ~out["base_failed"] & (out["n_content_words"] >= share * out["n_words"])
    return out


def rules(docs: DataFrame, model: Model, text: str = "text", **limits) -> DataFrame:
    """All columns of docs with counts, the number of content lines and words, base_failed and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def what(texts: pa.Array) -> list[pa.Array]:
        found = judged(texts, shared.value, **limits)
        return [pa.array(found[n], pa.bool_() if t == "boolean" else pa.int64()) for n, t in FIELDS.items()]

    return K.told(docs, text, what, FIELDS)


def op13_line_quality(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules(docs, fit(docs, table(spark, sf_dir, "labels"))).drop("text")
