"""Toxicity by a bidirectional gated recurrent network with attention pooling over character and word inputs.

Each word becomes a vector: the last states of a bidirectional GRU over its bytes, its hashed word weight (how much
more often it is in toxic training texts), and the byte network's own verdict. A second bidirectional GRU reads these
vectors in windows of WINDOW words that start every STRIDE words, the last one flush with the end, so that every word
is in one and nearly all are in two; attention pools a window's states to one logit. A text's score is that of its most
toxic window; a text of fewer words is one window.

Trained in numpy on a bounded sample (about SIZE toxic and CLEAN other documents, whole texts): first the byte network on
words, weighted by how often they are in either class, so that it reads word shapes that it has not met; then the rest
on windows by backpropagation through time, where a toxic text teaches by its most toxic window and a clean one by all
of a few, again in every epoch. The number of epochs is a parameter of the fit: EPOCHS, or as many as it takes to read
READS texts in all, up to MOST_EPOCHS. A fifth of the sample is kept apart: the bias is set so that the threshold parts
its labels best, a clean text counting CLEAN_WEIGHT times, as there are so many more of them; where the fifth lacks a
kind of label the bias stays as trained.

Trained weights and all states are rounded (see bigru), so that equal texts score alike whatever they are read with.

Defined results: null, empty and blank texts have no window and score 0; without a labelled document of either kind
all score 0; repeated rows are each scored alike; an empty table gives an empty one; words over SEGMENT bytes are read
by the byte network in segments, of which the mean counts; columns of docs called score or predicted give way to the
new ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.llm import sampling
from kinelake.llm import textkit as K
from kinelake.llm.bigru import Adam, ByteNet, Cache, backward, by_length, forward, matrix, on_grid, rounded, sigmoid
from kinelake.llm.brown_lm import remainder

SIZE, CLEAN, WINDOW, STRIDE, HIDDEN, BYTE_HIDDEN, SEGMENT = 1500, 2250, 24, 12, 8, 12, 32
BYTE_WORDS, BYTE_EPOCHS, RATE, THRESHOLD, CLEAN_WEIGHT = 80_000, 3, 0.01, 0.7, 5
EPOCHS, READS, MOST_EPOCHS = 8, 30_000, 40
#: Words must be in so many training documents to have a weight of their own.
LEAST_DOCS = 3
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def tokens(texts: pa.Array) -> K.Words:
    """Words without punctuation around them, A-Z as a-z; a word of punctuation alone is kept as it is."""
    data, at = K.raw(texts)
    starts, ends, bounds = K.spans(data, at, K.NOT_SPACE)
    core = ~PUNCTUATION[data]
    inner = np.flatnonzero(core)
    if len(inner):
        first = np.searchsorted(inner, starts)
        a = inner[np.minimum(first, len(inner) - 1)]
        b = inner[np.maximum(np.searchsorted(inner, ends) - 1, 0)] + 1
        has = (first < len(inner)) & (a < ends) & (a >= starts)
        starts, ends = np.where(has, a, starts), np.where(has, b, ends)
    return K.Words(data, starts, ends, K.hash_spans(data, starts, ends), bounds)


class Model:
    def __init__(self, net: ByteNet, known: np.ndarray, weights: np.ndarray, rng: np.random.Generator):
        self.net, self.known, self.weights, self.cache, self.settled = net, known, weights, None, False
        width = 2 * BYTE_HIDDEN + 2
        make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        h = HIDDEN
        self.p = {"wf": make(width, 3 * h), "wb": make(width, 3 * h), "uf": make(h, 3 * h), "ub": make(h, 3 * h), "a": make(2 * h, h), "q": make(h), "o": make(2 * h), "b": np.full(1, -1.0, np.float32)}

    def settle(self) -> Model:
        """Rounds the network after training."""
        self.net.settle()
        self.p = {k: v if k == "b" else rounded(v) for k, v in self.p.items()}
        self.settled = True
        return self

    def vectors(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        size = ends - starts
        pieces = -(-size // SEGMENT)
        owner = np.repeat(np.arange(len(size)), pieces)
        at = starts[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEGMENT
        length = np.minimum(SEGMENT, ends[owner] - at)
        h = BYTE_HIDDEN
        last = np.empty((len(owner), 2 * h + 1), np.float32)
        for group in by_length(length, 512):
            s = self.net.states(K.FOLD[matrix(data, at[group], int(length[group[0]]))], grid=self.settled)
            last[group, : 2 * h] = np.concatenate([s[-1, :, :h], s[0, :, h:]], axis=1)
        last[:, -1] = last[:, : 2 * h] @ self.net.p["v"][:, 0] + self.net.p["c"][0]
        if len(owner) > len(size):
            last = np.add.reduceat(last, np.cumsum(pieces) - pieces) / pieces[:, None]
        k = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        weight = np.where(self.known[k] == hashes, self.weights[k], 0.0) if len(self.known) else np.zeros(len(hashes))
        out = np.concatenate([last, weight[:, None]], axis=1).astype(np.float32)
        return on_grid(out) if self.settled else out

    def gates(self, w: K.Words) -> tuple[np.ndarray, np.ndarray]:
        """Gates of each distinct word for both directions, and each word's row."""
        if self.cache is None:
            self.cache = Cache(17, 6 * HIDDEN)
        known, first, which = np.unique(w.hashes, return_index=True, return_inverse=True)
        project = np.concatenate([self.p["wf"], self.p["wb"]], axis=1).astype(float)  # sums of 26 are exact in float64
        return self.cache.get(known, lambda k: self.vectors(w.data, w.starts[first[k]], w.ends[first[k]], known[k]).astype(float) @ project), which

    def logits(self, gates_f: np.ndarray, gates_b: np.ndarray, mask: np.ndarray | None, tape: dict | None = None) -> np.ndarray:
        tf, tb = ([], []) if tape is not None else (None, None)
        grid = self.settled
        s = np.concatenate([forward(gates_f, self.p["uf"], False, mask, tf, grid), forward(gates_b, self.p["ub"], True, mask, tb, grid)], axis=2)
        inner = np.tanh(s @ self.p["a"])
        e = (on_grid(inner) if grid else inner) @ self.p["q"]
        if mask is not None:
            e = np.where(mask[:, :, 0], e, -1e9)
        e = np.exp(e - e.max(axis=0))
        att = e / sum(e)
        value = s @ self.p["o"]
        if tape is not None:
            tape.update(s=s, inner=inner, att=att, value=value, tf=tf, tb=tb, mask=mask)
        return sum(att * value) + self.p["b"][0]  # step by step, so that the order of the sum is the same for any batch

    def learn(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, adam: Adam) -> None:
        """One step on windows of word vectors (steps, windows, width)."""
        p, h, tape = self.p, HIDDEN, {}
        out = self.logits(x @ p["wf"], x @ p["wb"], mask, tape)
        d = ((sigmoid(out) - y) / len(y)).astype(np.float32)
        s, inner, att, value = (tape[k] for k in ("s", "inner", "att", "value"))
        d_value = att * d
        d_att = value * d
        d_e = att * (d_att - (att * d_att).sum(axis=0))
        d_inner = d_e[:, :, None] * p["q"] * (1 - inner * inner)
        d_s = (d_value[:, :, None] * p["o"] + d_inner @ p["a"].T).astype(np.float32)
        g = {"o": np.einsum("tbh,tb->h", s, d_value), "b": d.sum(keepdims=True), "q": np.einsum("tbh,tb->h", inner, d_e), "a": np.einsum("tbh,tbk->hk", s, d_inner)}
        for k, back, part, run in (("f", False, d_s[:, :, :h], tape["tf"]), ("b", True, d_s[:, :, h:], tape["tb"])):
            d_gates, g["u" + k] = backward(part, p["u" + k], back, run, mask)
            g["w" + k] = np.einsum("tbd,tbg->dg", x, d_gates)
        adam.step(g)

    def score(self, texts: pa.Array) -> np.ndarray:
        """The probability of each text's most toxic window."""
        w = tokens(texts)
        n = len(w.bounds) - 1
        out = np.full(n, -np.inf, np.float32)
        if len(w.starts):
            gates, which = self.gates(w)
            doc, start, length = windows(np.diff(w.bounds), w.bounds[:-1])
            for full in (True, False):
                some = np.flatnonzero((length == WINDOW) == full)
                for i in range(0, len(some), 1024):
                    part = some[i : i + 1024]
                    at, mask = places(start[part], length[part])
                    rows = gates[which[at]]
                    np.maximum.at(out, doc[part], self.logits(rows[:, :, : 3 * HIDDEN], rows[:, :, 3 * HIDDEN :], None if full else mask))
        return np.where(np.isfinite(out), sigmoid(out.clip(-80, 80).astype(float)), 0.0)


def windows(size: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and number of words of every window."""
    count = np.where(size > WINDOW, -(-(size - WINDOW) // STRIDE) + 1, (size > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(size)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(k * STRIDE, np.maximum(size[doc] - WINDOW, 0))
    return doc, first[doc] + start, np.minimum(size[doc], WINDOW)


def places(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words (steps, windows), and a mask of those that are there."""
    step = np.arange(int(length.max()))[:, None]
    mask = step < length
    return np.where(mask, start + step, start), mask[:, :, None]


def train(texts: list[str], labels: list[int], reads: int = READS) -> Model | None:
    """A model from texts labelled 0 or 1; None unless both are there."""
    y, apart = np.array(labels), np.arange(len(labels)) % 5 == 4
    if not (apart & (y == 0)).any() or not (apart & (y == 1)).any():
        model = train_network(texts, labels, reads)
        return model and model.settle()
    model = train_network([t for t, a in zip(texts, apart, strict=True) if not a], y[~apart], reads)
    if model is None:
        return None
    model.settle()
    s = np.concatenate([model.score(pa.array([texts[k] for k in part], pa.string())) for part in np.array_split(np.flatnonzero(apart), 8)])
    model.p["b"] += np.float32(_logit(THRESHOLD) - best_cut(_logit(s), y[apart]))
    return model


def _logit(p):
    p = np.clip(p, 1e-7, 1 - 1e-7)
    return np.log(p / (1 - p))


def best_cut(value: np.ndarray, y: np.ndarray) -> float:
    """Where values part the labels with the best balance of toxic texts found and clean ones hit."""
    order = np.argsort(-value)
    value, y = value[order], y[order]
    found, hit = np.cumsum(y), np.cumsum(1 - y) * CLEAN_WEIGHT
    quality = 2 * found / (found + hit + y.sum())
    quality[:-1][value[:-1] == value[1:]] = -1
    best = np.flatnonzero(quality >= quality.max() - 1e-12)
    k = int(best[len(best) // 2])
    return float((value[k] + value[min(k + 1, len(value) - 1)]) / 2)


def train_network(texts: list[str], labels, reads: int, seed: int = 5) -> Model | None:
    y = np.array(labels)
    w = tokens(pa.array(texts, pa.string()))
    size = np.diff(w.bounds)
    if not ((y == 1) & (size > 0)).any() or not ((y == 0) & (size > 0)).any():
        return None
    rng = np.random.default_rng(seed)
    doc = np.repeat(np.arange(len(size)), size)
    known, first, which = np.unique(w.hashes, return_index=True, return_inverse=True)
    # documents of either class that have a word
    pair = np.unique(which * len(size) + doc)
    toxic = y[pair % len(size)] == 1
    a = np.bincount(pair[toxic] // len(size), minlength=len(known)).astype(float)
    b = np.bincount(pair[~toxic] // len(size), minlength=len(known)).astype(float)
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    share = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
    weight = np.where(a + b >= LEAST_DOCS, share * np.minimum(1, np.sqrt(a + b) / 4), 0.0)
    often = np.flatnonzero(a + b >= LEAST_DOCS)

    # bytes: words drawn alike from both classes, each with the part of toxic documents among those that have it
    net = ByteNet(BYTE_HIDDEN, 1, rng)
    chance = a / a.sum() + b / b.sum()
    some = rng.choice(len(known), min(BYTE_WORDS, 6 * len(known)), p=chance / chance.sum())
    goal = (a / n1 / (a / n1 + b / n0))[some]
    # of a word of several segments one is drawn
    size_ = w.ends[first[some]] - w.starts[first[some]]
    segment = rng.integers(0, -(-size_ // SEGMENT)) * SEGMENT
    starts = w.starts[first[some]] + segment
    length = np.minimum(size_ - segment, SEGMENT)
    data, adam, h = K.FOLD[w.data], Adam(net.p, RATE), BYTE_HIDDEN
    for epoch in range(BYTE_EPOCHS):
        adam.rate = RATE * 0.5**epoch
        for group in by_length(length, 256, rng):
            x = matrix(data, starts[group], int(length[group[0]]))
            tapes: tuple[list, list] = ([], [])
            s = net.states(x, tapes)
            ends = np.concatenate([s[-1, :, :h], s[0, :, h:]], axis=1)
            d = ((sigmoid(ends @ net.p["v"] + net.p["c"]) - goal[group][:, None]) / len(group)).astype(np.float32)
            d_ends, d_s = d @ net.p["v"].T, np.zeros_like(s)
            d_s[-1, :, :h] += d_ends[:, :h]
            d_s[0, :, h:] += d_ends[:, h:]
            g = net.grads(x, s, d, d_s, tapes)
            g["v"], g["c"] = ends.T @ d, d.sum(axis=0)
            adam.step(g)

    model = Model(net, known[often], weight[often], rng)
    vectors = model.vectors(w.data, w.starts[first], w.ends[first], known)
    wdoc, start, length = windows(size, w.bounds[:-1])
    of_doc = np.searchsorted(wdoc, np.arange(len(size) + 1))
    adam = Adam(model.p, RATE)
    rounds = min(MOST_EPOCHS, max(EPOCHS, reads // len(size)))
    for epoch in range(rounds):
        adam.rate = RATE * 0.05 ** (epoch / rounds)
        value = np.empty(len(wdoc))
        for i in range(0, len(wdoc), 1024):
            at, mask = places(start[i : i + 1024], length[i : i + 1024])
            x = vectors[which[at]]
            value[i : i + 1024] = model.logits(x @ model.p["wf"], x @ model.p["wb"], mask) if epoch else (np.maximum(x[:, :, -1], 0) + np.maximum(x[:, :, -2], 0)).max(axis=0, where=mask[:, :, 0], initial=0)
        chosen = []
        for k in range(len(size)):
            lo, hi = of_doc[k], of_doc[k + 1]
            if lo == hi:
                continue
            best = lo + int(value[lo:hi].argmax())
            chosen.append(best)
            if y[k] == 0:
                chosen += (lo + rng.integers(0, hi - lo, 2)).tolist()
        chosen = np.array(chosen)
        rng.shuffle(chosen)
        for i in range(0, len(chosen), 64):
            part = chosen[i : i + 64]
            at, mask = places(start[part], length[part])
            model.learn(vectors[which[at]], mask, y[wdoc[part]].astype(np.float32), adam)
    return model


def fit(docs: DataFrame, labels: DataFrame, size: int = SIZE, clean: int = CLEAN, longest: int = sampling.LONGEST, reads: int = READS) -> Model | None:
    """A model learned from the texts that these labels (doc_id, toxic) belong to."""
    rows = labels.filter("toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    texts, y = sampling.labelled(docs, rows, "toxic", {0: clean, 1: size}, longest)
    return train(texts, y, reads)


def assess(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of docs with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def what(texts: pa.Array) -> list[pa.Array]:
        m = shared.value
        score = m.score(texts) if m else np.zeros(len(texts))
        return [pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))]

    return K.told(docs, text, what, {"score": "double", "predicted": "int"})


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = remainder(3) == 1
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held))
    return assess(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")
