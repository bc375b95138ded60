"""Quality by ordinal cumulative-link regression on graded ratings.

A text has one latent value s = sum of weights of its features, shared by all grades; ordered thresholds t1 < t2 < ...
cut it: P(grade > k) = sigmoid(s - tk). The expected grade and the tail probability (of the top grade, or of any grade
from `at_least` on) select documents.

Features are hashed text: words (A-Z as a-z) and byte trigrams of a coarse spelling (letters as a or A, digits as 9),
each counted relative to the text's length, and a few measures in steps (length, distinct words, capitals). All are
sums over the whole text, so a text of any length is read once.

Fitted in numpy on a bounded sample, about `size` documents of each grade. The thresholds stay ordered because their
distances are fitted as logarithms.

Defined results: null and empty texts have only the measures' features and get a grade as any other text; with no
labelled document the expected grade and the tail are null and nothing is kept; with one grade that grade is expected;
equal texts get equal grades; an empty table gives an empty one; columns of docs called expected_grade, p_tail or keep
give way to the new ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.llm import sampling
from kinelake.llm import textkit as K
from kinelake.llm.bigru import Adam, sigmoid
from kinelake.llm.brown_lm import remainder

SIZE, WORD_BITS, SHAPE_BITS, EPOCHS, RATE, DECAY, KEEP = 2000, 15, 12, 12, 0.05, 1e-5, 0.5
WORD_AT, SHAPE_AT, STEP_AT = 0, 1 << WORD_BITS, (1 << WORD_BITS) + (1 << SHAPE_BITS)
STEPS = 16
WIDTH = STEP_AT + 3 * STEPS


def _coarse() -> np.ndarray:
    table = np.arange(256, dtype=np.uint64)
    table[97:123], table[65:91], table[48:58] = 97, 65, 48
    table[128:] = 97
    return table


COARSE = _coarse()


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column and value of every feature that occurs, repeats added up by whoever uses them, and each text's document."""
    w = K.words(texts)
    data, at = K.raw(texts)
    n = len(at) - 1
    size = np.diff(w.bounds)
    doc = np.repeat(np.arange(n), size)
    word = (w.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    length = np.diff(at)
    tri = np.zeros(0, np.int64)
    tri_doc = np.zeros(0, np.int64)
    if len(data) > 2:
        c = COARSE[data]
        code = (c[:-2] << np.uint64(16)) | (c[1:-1] << np.uint64(8)) | c[2:]
        tri = SHAPE_AT + ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SHAPE_BITS)).astype(np.int64)
        tri_doc = np.repeat(np.arange(n), length)[:-2]
        inside = np.arange(len(tri)) + 2 < at[1:][tri_doc]
        tri, tri_doc = tri[inside], tri_doc[inside]
    # measures in steps: number of words, distinct words among them, capitals among bytes
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data < 91))])
    capitals = (upper[at[1:]] - upper[at[:-1]]) / np.maximum(length, 1)
    key = np.sort((doc.astype(np.uint64) << np.uint64(40)) | (w.hashes >> np.uint64(24)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=n) / np.maximum(size, 1)
    step = np.stack([np.minimum(np.log2(size + 1.0), STEPS - 1), distinct * (STEPS - 1), capitals * (STEPS - 1)]).astype(np.int64)
    step += STEP_AT + STEPS * np.arange(3)[:, None]
    column = np.concatenate([word, tri, step.ravel()])
    value = np.concatenate([1 / np.maximum(size, 1)[doc], 1 / np.maximum(length - 2, 1)[tri_doc], np.full(3 * n, 0.5)])
    return column, value, np.concatenate([doc, tri_doc, np.tile(np.arange(n), 3)])


class Model:
    def __init__(self, grades: list[int], weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = np.array(grades, float), weights, thresholds

    def latent(self, texts: pa.Array) -> np.ndarray:
        column, value, doc = features(texts)
        return np.bincount(doc, self.weights[column] * value, len(texts))

    def above(self, latent: np.ndarray) -> np.ndarray:
        """P(grade > k) for every grade k but the last, (texts, grades - 1)."""
        return sigmoid(latent[:, None] - self.thresholds)

    def expected(self, latent: np.ndarray) -> np.ndarray:
        return self.grades[0] + (self.above(latent) * np.diff(self.grades)).sum(axis=1)

    def tail(self, latent: np.ndarray, at_least: float) -> np.ndarray:
        k = int(np.searchsorted(self.grades, at_least))
        return np.ones(len(latent)) if k == 0 else np.zeros(len(latent)) if k >= len(self.grades) else self.above(latent)[:, k - 1]


def gathered(texts: list[str], chunk: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features with repeats added up, in order of documents; made for a few texts at a time, as text is far larger."""
    parts = []
    for i in range(0, len(texts), chunk):
        column, value, doc = features(pa.array(texts[i : i + chunk], pa.string()))
        key, which = np.unique(doc * WIDTH + column, return_inverse=True)
        parts.append(((key % WIDTH).astype(np.int32), np.bincount(which, value).astype(np.float32), (key // WIDTH + i).astype(np.int32)))
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 3) -> Model | None:
    grades = sorted(set(labels))
    if not grades:
        return None
    if len(grades) == 1:
        return Model(grades, np.zeros(WIDTH), np.zeros(0))
    y = np.searchsorted(grades, labels)
    column, value, doc = gathered(texts)
    value = np.where(column < STEP_AT, value * 8, value)  # on a par with the measures
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    share = np.cumsum(np.bincount(y, minlength=len(grades)))[:-1] / len(y)
    start = np.log(share / (1 - share))
    params = {"w": np.zeros(WIDTH, np.float32), "first": start[:1].astype(np.float32), "gap": np.log(np.maximum(np.diff(start), 0.1)).astype(np.float32)}
    adam = Adam(params, RATE)
    rng = np.random.default_rng(seed)

    def cuts() -> np.ndarray:
        return params["first"] + np.concatenate([[0], np.cumsum(np.exp(params["gap"]))])

    for epoch in range(epochs):
        adam.rate = RATE * 0.8**epoch
        order = rng.permutation(len(texts))
        for i in range(0, len(order), 64):
            part = order[i : i + 64]
            n = first[part + 1] - first[part]
            at = K.ragged(first[part], n)
            row = np.repeat(np.arange(len(part)), n)
            s = np.bincount(row, params["w"][column[at]] * value[at], len(part))
            # P(y = k) = F(k) - F(k - 1) with F(k) = sigmoid(tk - s)
            f = sigmoid(cuts() - s[:, None])
            edge = np.concatenate([np.zeros((len(part), 1)), f, np.ones((len(part), 1))], axis=1)
            slope = np.concatenate([np.zeros((len(part), 1)), f * (1 - f), np.zeros((len(part), 1))], axis=1)
            k = np.arange(len(part)), y[part]
            p = np.maximum(edge[k[0], k[1] + 1] - edge[k], 1e-9)
            d_s = (slope[k[0], k[1] + 1] - slope[k]) / p / len(part)
            d_cut = np.zeros((len(part), len(grades) + 1))
            d_cut[k[0], k[1] + 1] -= slope[k[0], k[1] + 1] / p
            d_cut[k] += slope[k] / p
            d_cut = d_cut[:, 1:-1].sum(axis=0) / len(part)
            g = {"w": np.bincount(column[at], d_s[row] * value[at], WIDTH) + DECAY * params["w"], "first": d_cut.sum(keepdims=True)}
            g["gap"] = np.cumsum(d_cut[::-1])[::-1][1:] * np.exp(params["gap"])
            adam.step(g)
    weights = params["w"].astype(float)
    weights[:STEP_AT] *= 8
    return Model(grades, weights, cuts().astype(float))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", size: int = SIZE, longest: int = sampling.LONGEST) -> Model | None:
    """A model learned from the texts that these labels (doc_id, an integer grade) belong to."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("grade"))
    return train(*sampling.labelled(docs, rows, "grade", size, longest))


def grade(docs: DataFrame, model: Model | None, text: str = "text", at_least: float | None = None, keep: float = KEEP) -> DataFrame:
    """All columns of docs with expected_grade, p_tail (of grades from at_least on, the top one by default) and keep."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def what(texts: pa.Array) -> list[pa.Array]:
        m = shared.value
        if m is None:
            return [pa.nulls(len(texts), pa.float64()), pa.nulls(len(texts), pa.float64()), pa.array(np.zeros(len(texts), bool))]
        s = m.latent(texts)
        tail = m.tail(s, m.grades[-1] if at_least is None else at_least)
        return [pa.array(m.expected(s), pa.float64()), pa.array(tail, pa.float64()), pa.array(tail >= keep)]

    return K.told(docs, text, what, {"expected_grade": "double", "p_tail": "double", "keep": "boolean"})


def op7_quality_ordinal(spark, sf_dir: str) -> DataFrame:
    """Learns from labelled documents whose crc32(doc_id as text) mod 5 is not 2."""
    from kinelake.llm.store import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = remainder(5) == 2
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held))
    return grade(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")
