"""Parts that need no Spark, against plain versions."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinelake.llm import bigru, brown_lm, dac, lang_id, quality, toxicity
from kinelake.llm import textkit as K
from kinelake.llm.fm_index import FMIndex, Wavelet

TEXTS = ["a b c d", "", None, "X", " q  r\n", "é ü É x", "\x1ca\x0bb", "word " * 300, "A,b!"]


def test_words_are_split_and_hashed_as_by_bytes_split():
    w = K.words(pa.array(TEXTS, pa.string()))
    for i, t in enumerate(TEXTS):
        expect = (t or "").encode().lower().split()
        a, b = w.bounds[i], w.bounds[i + 1]
        assert [w.text(k) for k in range(a, b)] == expect
        assert w.hashes[a:b].tolist() == [K.hash_word(x) for x in expect]


def test_slices_of_arrow_arrays_and_long_words():
    whole = pa.array(["x" * 600_000 + " y", "b", None, "c d"], pa.string())
    w = K.words(whole.slice(1))
    assert w.bounds.tolist() == [0, 1, 1, 3]
    assert K.words(whole).hashes[0] == K.hash_word(b"x" * 600_000)
    batch = pa.RecordBatch.from_arrays([whole], names=["text"])
    assert [s.num_rows for s in K.slices(batch, limit=100)] == [1, 3]
    assert list(K.slices(batch.slice(0, 0))) == []


def test_shingles_of_short_and_long_texts():
    found, at = K.shingles(K.words(pa.array(["a b c d", "a b", "b a", "a b", "", "a b c"])), 3)
    assert np.diff(at).tolist() == [2, 1, 1, 1, 0, 1]
    assert found[at[1]] == found[at[3]] != found[at[2]]
    assert found[at[5]] == found[0]


@given(st.lists(st.integers(0, 5), min_size=1, max_size=120), st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=4), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_fm_index_finds_every_occurrence(sequence, patterns):
    sequence = np.array([0, *sequence, 0])
    index = FMIndex(sequence, 6)
    table = np.zeros((len(patterns), 4), np.int64)
    for k, p in enumerate(patterns):
        table[k, 4 - len(p) :] = p
    low, high = index.search(table, np.array([len(p) for p in patterns]))
    for k, p in enumerate(patterns):
        expect = [i for i in range(len(sequence)) if sequence[i : i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == expect


def test_wavelet_rank_and_access():
    x = np.random.default_rng(1).integers(0, 11, 1000)
    w = Wavelet(x, 11)
    at = np.arange(1001)
    for c in range(11):
        assert (w.rank(np.full(1001, c), at) == np.concatenate([[0], np.cumsum(x == c)])).all()
    assert (w.access(np.arange(1000)) == x).all()


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700))
@settings(max_examples=60, deadline=None)
def test_codes_give_back_every_id_in_any_order(ids):
    codes = dac.Codes(dac.pack(np.array(ids, np.uint32)))
    assert codes.span(0, len(ids)).tolist() == ids
    for a in range(0, len(ids), 61):
        assert codes.span(a, min(a + 70, len(ids))).tolist() == ids[a : a + 70]
    order = np.random.default_rng(0).permutation(len(ids))
    assert codes.get(order).tolist() == [ids[k] for k in order]
    with pytest.raises(IndexError):
        codes.get(np.array([len(ids)]))


def test_word_encoder_equals_the_tokenizer():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    encoder = dac.WordEncoder(open(path, encoding="utf-8").read(), limit=200)
    rnd = random.Random(2)
    bits = ["a", "Bc", "'s", "!!", "'", "é", "≠", "̸", "H̱", " ", "\n", " ", "12", "don't", "<|endoftext|>", "<|EndOfText|>", "word", "É", ".", ",", "(", "\x1c", "Σ", "日本", "ª", "²a", "İ", "ß!"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(400)] + [None, ""]
    assert encoder.encode(pa.array(["hello <|endoftext|> world"]))[0].tolist() == [3306, 49407, 1002, dac.END_ID]
    for i in range(0, len(texts), 40):
        some = texts[i : i + 40]
        ids, at = encoder.encode(pa.array(some, pa.string()))
        for k, t in enumerate(some):
            assert ids[at[k] : at[k + 1]].tolist() == [*whole.encode(t or "", add_special_tokens=False).ids, dac.END_ID]


def test_recurrent_gradients():
    rng = np.random.default_rng(0)
    gates, u = rng.standard_normal((5, 3, 12)).astype(np.float32), rng.standard_normal((4, 12)).astype(np.float32)
    mask = np.ones((5, 3, 1), bool)
    mask[3:, 1] = False
    d = rng.standard_normal((5, 3, 4)).astype(np.float32)
    for back in (False, True):
        tape: list = []
        bigru.forward(gates, u, back, mask, tape)
        d_gates, d_u = bigru.backward(d, u, back, tape, mask)
        loss = lambda g, w, back=back: float((bigru.forward(g, w, back, mask).astype(float) * d).sum())
        for at in ((0, 0, 1), (2, 1, 6), (4, 2, 11), (4, 1, 3)):
            step = np.zeros_like(gates)
            step[at] = 1e-2
            assert abs((loss(gates + step, u) - loss(gates - step, u)) / 2e-2 - d_gates[at]) < 5e-3
        for at in ((0, 0), (3, 7), (1, 11)):
            step = np.zeros_like(u)
            step[at] = 1e-2
            assert abs((loss(gates, u + step) - loss(gates, u - step)) / 2e-2 - d_u[at]) < 2e-2


def test_exchange_raises_the_likelihood_and_keeps_fixed_classes():
    rng = np.random.default_rng(0)
    # words 0-4 follow each other, words 5-9 do too; 10 is fixed
    block = np.kron(np.eye(2), np.full((5, 5), 20)) + rng.integers(0, 2, (10, 10))
    b = np.pad(block, (0, 1), constant_values=1)
    of = brown_lm.exchange(b, 10, 2, 10)
    assert len(set(of[:5])) == 1 and len(set(of[5:10])) == 1 and of[0] != of[5] and of[10] == 2


def test_table_with_collisions():
    rng = np.random.default_rng(4)
    h = np.unique(rng.integers(1, 2**63, 3000).astype(np.uint64))
    h[:100] = (h[0] >> np.uint64(43) << np.uint64(43)) + np.arange(100, dtype=np.uint64)
    table = K.Table(13)
    table.add(h[:1000], 0)
    table.add(h[1000:], 1000)
    assert (table.find(h) == np.arange(len(h))).all()
    assert (table.find(h + np.uint64(1 << 20)) == -1).all() and len(table.find(h[:0])) == 0
    assert (brown_lm.numbered(h[:0]).find(h[:3]) == -1).all()


def test_hashes_part_words_that_a_polynomial_takes_as_one():
    a, b = b"a", b"b"
    for _ in range(11):
        a, b = a + b, b + a
    assert len(a) == 2048 and a != b and K.hash_word(a) != K.hash_word(b)
    for k in (1, 7, 8, 9, 63, 64, 65, 200):
        assert len({K.hash_word(x[:k] + y) for x in (a, b) for y in (b"", b"\0", b"\0\0")}) == 6
        assert K.hash_word(a[:k]) == K.hash_word(a[:k].upper())


def test_language_network_learns_and_reads_alike_in_any_batch():
    rnd = random.Random(1)
    make = lambda s: " ".join("".join(rnd.choice(s) for _ in range(rnd.randint(2, 9))) for _ in range(30))
    texts = [make("abcd") for _ in range(30)] + [make("wxyz") for _ in range(30)]
    model = lang_id.train(texts, ["p"] * 30 + ["q"] * 30, 1500)
    some = pa.array(["abca bcd " * 900, "wxyzwxyz" * 100, None, "", "12 !!", "dcba", *texts[::7]], pa.string())
    p = model.predict(some)
    assert p[0, 0] > 0.9 and p[1, 1] > 0.9 and p[5, 0] > 0.7 and (p[2:5] == 0).all()
    assert np.allclose(p[[0, 1, 5]].sum(axis=1), 1, atol=1e-4)
    assert (np.concatenate([model.predict(some.slice(k, 1)) for k in range(len(some))]) == p).all()
    mixed = model.predict(pa.array([" ".join([texts[0], texts[40]] * 5)]))
    assert 0.35 < mixed[0, 0] < 0.65
    assert lang_id.train([], []).langs == []


def test_language_network_equals_a_plain_reading():
    rng = np.random.default_rng(3)
    net = bigru.ByteNet(4, 3, rng)
    net.settle()
    model = lang_id.Model(["x", "y", "z"], net)
    text = "".join(chr(c) for c in rng.integers(32, 127, 700))
    data = np.frombuffer(text.encode().lower(), np.uint8)
    sums = np.zeros(3)
    for a in range(0, len(data), lang_id.PIECE):
        lo, hi = max(a - lang_id.CONTEXT, 0), min(a + lang_id.PIECE + lang_id.CONTEXT, len(data))
        logits = net.states(data[lo:hi, None], grid=True)[:, 0] @ net.p["v"] + net.p["c"]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        keep = lang_id.LETTER[data[lo:hi]] & (np.arange(lo, hi) >= a) & (np.arange(lo, hi) < a + lang_id.PIECE)
        sums += p[keep].sum(axis=0)
    assert np.allclose(model.predict(pa.array([text]))[0], sums / lang_id.LETTER[data].sum(), atol=1e-5)


def test_toxicity_windows_cover_every_word_and_find_bad_ones():
    for n in (1, 23, 24, 25, 36, 37, 100):
        doc, start, length = toxicity.windows(np.array([0, n]), np.array([0, 0]))
        assert set(doc) == {1} and {i for s, m in zip(start, length, strict=True) for i in range(s, s + m)} == set(range(n))
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    texts, y = [], []
    for k in range(160):
        t = [rnd.choice(words) for _ in range(rnd.randint(5, 120))]
        if k % 4 == 0:
            for _ in range(2):
                t[rnd.randrange(len(t))] = rnd.choice(["zqidiot", "zqmoron"])
        texts.append(" ".join(t))
        y.append(int(k % 4 == 0))
    model = toxicity.train(texts, y)
    s = model.score(pa.array([*texts, None, "", " "]))
    assert np.mean((s[:160] >= 0.7) == np.array(y)) > 0.95 and (s[160:] == 0).all()
    model.cache = None
    again = np.concatenate([model.score(pa.array(texts[k : k + 3])) for k in range(0, 160, 3)])
    assert (again == s[:160]).all()  # whatever they are read with
    assert toxicity.train(["a"], [1]) is None


def test_ordinal_regression_orders_grades():
    texts = [f"{['bad awful', 'mid so', 'good fine'][k % 3]} {k}" for k in range(300)]
    m = quality.train(texts, [k % 3 for k in range(300)])
    s = m.latent(pa.array(["bad awful", "mid so", "good fine", None]))
    assert s[0] < s[1] < s[2] and (np.diff(m.thresholds) > 0).all()
    e = m.expected(s)
    assert e[0] < 0.5 < e[1] < 1.5 < e[2] and ((m.tail(s, 1) >= m.tail(s, 2)).all())
    assert quality.train([], []) is None and quality.train(["a"], [2]).expected(np.zeros(1))[0] == 2


def test_grades_equal_a_plain_sum_of_features():
    rng = np.random.default_rng(2)
    m = quality.Model([0, 1, 2], rng.standard_normal(quality.WIDTH), np.array([-0.5, 0.5]))
    for text in ("The CAT sat, the cat!", "a", "", "é 12 ü", "word " * 500 + "End"):
        raw, words = text.encode(), text.encode().lower().split()
        s = 0.0
        for w in words:
            s += m.weights[K.hash_word(w) >> (64 - quality.WORD_BITS)] / len(words)
        coarse = [97 if 97 <= c < 123 or c > 127 else 65 if 65 <= c < 91 else 48 if 48 <= c < 58 else c for c in raw]
        for a, b, c in zip(coarse, coarse[1:], coarse[2:], strict=False):
            code = (a << 16 | b << 8 | c) * 0x9E3779B97F4A7C15 % 2**64 >> (64 - quality.SHAPE_BITS)
            s += m.weights[quality.SHAPE_AT + code] / (len(raw) - 2)
        many, few = np.log2(len(words) + 1), len(set(words)) / max(len(words), 1)
        steps = [min(int(many), quality.STEPS - 1), int(few * (quality.STEPS - 1)), int(sum(65 <= c < 91 for c in raw) / max(len(raw), 1) * (quality.STEPS - 1))]
        s += 0.5 * sum(m.weights[quality.STEP_AT + quality.STEPS * k + x] for k, x in enumerate(steps))
        got = m.latent(pa.array([text]))[0]
        assert abs(got - s) < 1e-9
        above = [1 / (1 + np.exp(t - s)) for t in m.thresholds]
        assert abs(m.expected(np.array([s]))[0] - sum(above)) < 1e-6 and abs(m.tail(np.array([s]), 2)[0] - above[1]) < 1e-6


def test_toxicity_equals_a_plain_reading_of_windows():
    rng = np.random.default_rng(1)
    net = bigru.ByteNet(toxicity.BYTE_HIDDEN, 1, rng)
    known = np.unique([K.hash_word(w) for w in (b"bad", b"good", b"so")])
    model = toxicity.Model(net, known.astype(np.uint64), np.array([2.0, -1.0, 0.25]), rng).settle()
    h, hb, grid = toxicity.HIDDEN, toxicity.BYTE_HIDDEN, lambda x: bigru.on_grid(np.array(x, np.float32))

    def vector(word: bytes) -> np.ndarray:
        parts = []
        for k in range(0, len(word), toxicity.SEGMENT):
            s = net.states(np.frombuffer(word[k : k + toxicity.SEGMENT], np.uint8)[:, None], grid=True)[:, 0]
            last = np.concatenate([s[-1, :hb], s[0, hb:]])
            parts.append(np.append(last, last @ net.p["v"][:, 0] + net.p["c"][0]))
        at = np.flatnonzero(model.known == K.hash_word(word))
        return grid(np.append(np.add.reduce(np.array(parts, np.float32)) / len(parts), model.weights[at[0]] if len(at) else 0.0))

    def score(text: str) -> float:
        punctuation = bytes(range(0x21, 0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x7F))
        words = [w.strip(punctuation) or w for w in text.encode().lower().split()]
        if not words:
            return 0.0
        best = -np.inf
        starts = sorted({min(k, max(len(words) - toxicity.WINDOW, 0)) for k in range(0, max(len(words) - toxicity.WINDOW, 0) + toxicity.STRIDE, toxicity.STRIDE)})
        for a in starts:
            x = np.array([vector(w) for w in words[a : a + toxicity.WINDOW]], float)
            gates = [(x @ model.p[k].astype(float)).astype(np.float32)[:, None] for k in ("wf", "wb")]
            s = np.concatenate([bigru.forward(gates[0], model.p["uf"], False, grid=True), bigru.forward(gates[1], model.p["ub"], True, grid=True)], axis=2)[:, 0]
            e = grid(np.tanh(s @ model.p["a"])) @ model.p["q"]
            weight = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
            best = max(best, float((weight * (s @ model.p["o"])).sum() + model.p["b"][0]))
        return 1 / (1 + np.exp(-best))

    texts = ["You are BAD!", "good, (so) good --", " ".join(f"w{k}" for k in range(61)), "x" * 100 + " bad", "", "...", "é bad ü " * 20]
    assert np.allclose(model.score(pa.array(texts)), [score(t) for t in texts], atol=1e-5)


def test_crc_of_a_known_value():
    assert zlib.crc32(b"123456789") == 0xCBF43926
