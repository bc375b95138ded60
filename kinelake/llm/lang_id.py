"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's bytes (A-Z as a-z) in both directions and labels every position with a distribution over the
languages it has learned; a text's probabilities are the mean over all its positions that hold a byte of a letter.
A text is read in pieces of PIECE bytes, each with CONTEXT bytes of the text before and behind it, in which states
warm up and whose labels count in the pieces they belong to; so words are read in their surroundings, every byte is
labelled once, and texts of any length fill the same batches. States are rounded (see bigru), so that a text's score is
the same whatever it is read with.

Trained in numpy by backpropagation through time on a bounded sample: about `size` documents of each language, of which
`pieces` pieces are drawn, as many of each language.

Defined results: `und` with score 0 for a null text or one without a letter; with no labelled document every text is
`und`; ties go to the language that sorts first; repeated rows are each predicted alike; an empty table gives an empty
one; columns of docs called lang_pred or score give way to the new ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.llm import sampling
from kinelake.llm import textkit as K
from kinelake.llm.bigru import Adam, ByteNet, by_length, matrix
from kinelake.llm.brown_lm import remainder

SIZE, PIECES, HIDDEN, EPOCHS, BATCH, RATE = 400, 6_000, 8, 3, 64, 0.01
#: Bytes of a piece, of its surroundings on either side, and of a piece that is learned from.
PIECE, CONTEXT, LESSON = 224, 24, 64
#: Pieces that are read at once.
GROUP = 2048
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def pieces(at: np.ndarray, piece: int, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that lie one after the other at these places: each piece's text, first byte and length with its
    surroundings, and the range of it whose labels count."""
    size = np.diff(at)
    count = -(-size // piece)
    doc = np.repeat(np.arange(len(size)), count)
    core = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * piece
    stop = np.minimum(core + piece, size[doc])
    start, end = np.maximum(core - context, 0), np.minimum(stop + context, size[doc])
    return doc, at[:-1][doc] + start, end - start, core - start, stop - start


class Model:
    def __init__(self, langs: list[str], net: ByteNet | None):
        self.langs, self.net = langs, net

    def predict(self, texts: pa.Array) -> np.ndarray:
        """Mean label distribution of each text, zeros where it has no byte of a letter."""
        data, at = K.raw(texts)
        n, kinds = len(at) - 1, len(self.langs)
        if self.net is None or not len(data):
            return np.zeros((n, kinds))
        letter = LETTER[data]
        low = K.FOLD[data]
        doc, start, length, first, stop = pieces(at, PIECE, CONTEXT)
        sums = np.zeros((len(doc), kinds))
        order = np.argsort(-length, kind="stable")
        h = self.net.p["uf"].shape[0]
        vf, vb, c = self.net.p["v"][:h].T.copy(), self.net.p["v"][h:].T.copy(), self.net.p["c"][:, None]
        for i in range(0, len(order), GROUP):
            part = order[i : i + GROUP]
            steps = np.arange(int(length[part[0]]))[:, None]
            place = np.minimum(start[part].astype(np.int32) + steps.astype(np.int32), len(data) - 1)
            counts = (letter[place] & (steps >= first[part]) & (steps < stop[part])).astype(np.float32)
            logits = np.empty((len(steps), kinds, len(part)), np.float32)
            total = np.zeros((kinds, len(part)))

            def each(t: int, k: int, back: bool, state: np.ndarray) -> None:
                x = logits[t, :, :k]
                if not back:
                    x[:] = vf @ state.T
                    return
                x += vb @ state.T
                x += c
                x -= x.max(axis=0)
                np.exp(x, out=x)
                x *= counts[t, :k] / sum(x)
                total[:, :k] += x

            self.net.ragged_states(low[place], length[part], each)
            sums[part] = total.T
        weight = np.concatenate([[0], np.cumsum(letter)])
        weight = weight[at[1:]] - weight[at[:-1]]
        pooled = np.stack([np.bincount(doc, sums[:, j], n) for j in range(kinds)], axis=1)
        return pooled / np.maximum(weight, 1)[:, None]


def train(texts: list[str], labels: list[str], pieces_: int = PIECES, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 11) -> Model:
    langs = sorted(set(labels))
    if not langs:
        return Model([], None)
    rng = np.random.default_rng(seed)
    number = {x: k for k, x in enumerate(langs)}
    data, at = K.raw(pa.array(texts, pa.string()))
    label = np.array([number[x] for x in labels])
    doc, start, length, _, _ = pieces(at, LESSON, 0)
    letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    good = np.flatnonzero(letters[start + length] > letters[start])
    if not len(good):
        return Model([], None)
    label = label[doc]
    share = np.bincount(label[good], minlength=len(langs))
    chance = (1 / share[label[good]]) / (1 / share[label[good]]).sum()
    some = rng.choice(good, pieces_, p=chance)
    starts, label = start[some], label[some]
    # a third of the lessons are short, as short texts are
    length = np.where(rng.random(len(some)) < 1 / 3, np.minimum(length[some], rng.integers(4, 25, len(some))), length[some])
    data = K.FOLD[data]
    net = ByteNet(hidden, len(langs), rng)
    adam = Adam(net.p, RATE)
    for epoch in range(epochs):
        adam.rate = RATE * 0.5**epoch
        for group in by_length(length, BATCH, rng):
            x = matrix(data, starts[group], int(length[group[0]]))
            tapes: tuple[list, list] = ([], [])
            states = net.states(x, tapes)
            p = _softmax(states @ net.p["v"] + net.p["c"])
            p[:, np.arange(len(group)), label[group]] -= 1
            d = (p / (len(group) * len(x))).astype(np.float32)
            grads = net.grads(x, states, d, d @ net.p["v"].T, tapes)
            grads["v"], grads["c"] = np.einsum("tbh,tbl->hl", states, d), d.sum(axis=(0, 1))
            adam.step(grads)
    net.settle()
    return Model(langs, net)


def fit(docs: DataFrame, size: int = SIZE, pieces_: int = PIECES, longest: int = sampling.LONGEST, kinds: int | None = None) -> Model:
    """A model learned from text and lang of these rows alone; of the `kinds` most frequent languages, if it is given."""
    texts, labels = sampling.own(docs, "lang", size, longest, kinds)
    return train(texts, labels, pieces_)


def _letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of docs with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def what(texts: pa.Array) -> list[pa.Array]:
        m = shared.value
        p = m.predict(texts)
        best = p.argmax(axis=1) if p.shape[1] else np.zeros(len(p), np.int64)
        score = p.max(axis=1, initial=0.0)
        plain = score > 0
        # bytes beyond ASCII may be no letters at all
        data, where = K.raw(texts)
        ascii_letters = np.zeros(len(data) + 1, np.int32)
        np.cumsum(LETTER[data] & (data < 128), out=ascii_letters[1:])
        unsure = np.flatnonzero(plain & (ascii_letters[where[1:]] == ascii_letters[where[:-1]]))
        for k in unsure.tolist():
            plain[k] = _letters(texts[k].as_py())
        langs = np.array([*m.langs, "und"], object)
        pred = langs[np.where(plain, best, len(m.langs))]
        return [pa.array(pred, pa.string()), pa.array(np.where(plain, np.minimum(score, 1), 0.0), pa.float64())]

    return K.told(docs, text, what, {"lang_pred": "string", "score": "double"})


def op6_lang_id(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = remainder(4) == 2
    model = fit(docs.filter(~held))
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")
