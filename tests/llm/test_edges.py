"""Cases at the edges of operators: what a prefilter lets through, long benchmark items, many languages, very long texts,
and whole outputs of the pipeline's stages against plain versions."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinelake.llm import byte_bpe, dac, decontaminate, lang_id, pii, quality, sketch, toxicity
from tests.llm.test_ops import SCHEMA, docs_of, models


def test_secrets_without_digits_are_searched_too(spark):
    secret = "deadbeefdeadbeefdeadbeefabcdefab"
    texts = [f"password: {secret}", f"password: {secret} 1", f"password: {secret.upper()}", f"no key word {secret}", "plain words alone"]
    got = {r["doc_id"]: r for r in pii.pseudonymise(docs_of(spark, list(enumerate(texts))), "k").collect()}
    assert [got[k]["n_secret"] for k in range(5)] == [1, 1, 1, 0, 0]
    assert secret not in got[0]["text"] and got[0]["text"] == got[1]["text"][:-2] and got[2]["text"][10:] == got[0]["text"][10:].upper()


def test_addresses_with_letters_beyond_ascii(spark):
    texts = ["an jöhn.doe@example.com", "an éva@example.com und", "пишите ivan@example.com"]
    got = [r["text"] for r in pii.pseudonymise(docs_of(spark, list(enumerate(texts))), "k").orderBy("doc_id").collect()]
    for old, new, gone in zip(texts, got, ("jöhn", "éva", "ivan"), strict=True):
        assert gone not in new and len(new) == len(old) and "@example.com" in new
    assert re.fullmatch(r"an [a-z]ö[a-z]{2}\.[a-z]{3}@example\.com", got[0]) and got[2].startswith("пишите ")


def test_long_items_are_cut_into_runs_that_lose_no_window(spark):
    rnd = random.Random(1)
    words = [f"w{rnd.randrange(4000)}" for _ in range(5000)]
    bench = spark.createDataFrame([("long", " ".join(words)), ("a", "w1 w2"), ("none", "!!"), (None, " ".join(words[100:130]))], "item_id string, text string")
    made = list(decontaminate.blocks(bench, 10, 300))
    assert all(len(p.patterns) <= 300 for p, _ in made) and [more for _, more in made] == [True] * (len(made) - 1) + [False]
    rows = [(k, " ".join(["x", *words[s : s + n], "y"])) for k, (s, n) in enumerate([(0, 12), (291, 18), (295, 10), (299, 11), (4985, 15), (7, 9), (0, 5000)])]
    docs = docs_of(spark, rows)
    whole = decontaminate.decontaminate(docs, bench).orderBy("doc_id").collect()
    parts = decontaminate.decontaminate(docs, bench, block_windows=300).orderBy("doc_id").collect()
    assert whole == parts and whole[6]["hit_spans"] == [1, 5001] and whole[5]["hit_spans"] == []


def test_merged_spans():
    rnd = random.Random(2)
    lists = [[x for _ in range(rnd.randrange(6)) for x in (lambda s: (s, s + rnd.randint(1, 6)))(rnd.randrange(30))] for _ in range(60)] + [[], []]
    lists = [sum((sorted(p) for p in zip(x[::2], x[1::2])), []) for x in lists]
    got = decontaminate._merged.func(pa.array(lists, pa.list_(pa.int64()))).to_pylist()
    for spans, out in zip(lists, got, strict=True):
        covered = {k for a, b in zip(spans[::2], spans[1::2]) for k in range(a, b)}
        ranges = list(zip(out[::2], out[1::2]))
        assert {k for a, b in ranges for k in range(a, b)} == covered and all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:]))


def test_more_languages_than_a_few(spark):
    rows = [(f"{chr(97 + k % 26)}{chr(97 + k // 26)} " * 6, f"l{k:02}") for k in range(70)]
    model = lang_id.fit(spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string"), pieces_=200)
    assert len(model.langs) == 70


def test_results_of_very_long_texts(spark):
    rnd = random.Random(3)
    words = ["the", "and", "of", "that", "with"]
    body = " ".join(rnd.choice(words) for _ in range(60000))
    text = f"mail jo@example.com {body} card 4111111111111111 end"
    docs = docs_of(spark, [(1, text), (2, body), (3, body)])
    one = pii.pseudonymise(docs, "k").filter("doc_id = 1").first()
    short = pii.pseudonymise(docs_of(spark, [(1, "mail jo@example.com card 4111111111111111 end")]), "k").first()["text"]
    assert one["text"] == short.replace(" card", f" {body} card")
    edited = {r["doc_id"]: r for r in sketch.edited(docs).collect()}
    assert edited[2]["fingerprint"] == edited[3]["fingerprint"] and edited[3]["near_next"] == 1 and edited[1]["n_chars"] == len(text)
    third = len(body) // 3
    assert edited[3]["edited_sha256"] == hashlib.sha256((body[: len(body) - third] + body[:third]).encode()).hexdigest()
    lang, grades, toxic = models(spark)
    told = {r["doc_id"]: r for r in lang_id.identify(docs, lang).collect()}
    assert told[2]["score"] == told[3]["score"] == pytest.approx(float(lang.predict(pa.array([body])).max()))
    graded = {r["doc_id"]: r for r in quality.grade(docs, grades).collect()}
    assert graded[2]["expected_grade"] == graded[3]["expected_grade"] == pytest.approx(grades.expected(grades.latent(pa.array([body])))[0])
    scored = {r["doc_id"]: r for r in toxicity.assess(docs, toxic).collect()}
    assert scored[2]["score"] == scored[3]["score"] and 0 <= scored[1]["score"] <= 1


def test_token_files_of_very_long_texts(spark, tmp_path):
    import public_tokenizers as P
    import tokenizers

    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["word", "naïve", "x1", "Zürich"]) for _ in range(50000)), "", None, "y" * 90000]
    coder = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in dac.op8_dac_tokens(spark, str(tmp_path)).collect()}
    start = 0
    for k, t in enumerate(texts):
        ids = [*coder.encode(t or "", add_special_tokens=False).ids, 1]
        assert (got[k]["start"], got[k]["n_tokens"]) == (start, len(ids))
        import zlib

        assert got[k]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_long_texts_may_come_in_any_order(spark):
    ranks, pattern = byte_bpe.production()
    texts = {k: f"text {k} " * 60 for k in range(40)}
    docs = docs_of(spark, list(texts.items())).orderBy(F.rand())
    whole = byte_bpe.encoder(open(ranks, "rb").read(), pattern)
    for r in byte_bpe.encode(docs, ranks, pattern, chunk=64, overlap=16).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == whole.encode_ordinary(texts[r["doc_id"]])


# ---------------------------------------------------------------- whole outputs of stages


FOLD = {k: k + 32 for k in range(65, 91)}


def plain_clean(text, items, window=10):
    """The text without words in any window of the items."""
    words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(FOLD))]
    windows = {tuple(w[k : k + min(window, len(w))]) for w in items for k in range(len(w) - min(window, len(w)) + 1) if w}
    hit = [False] * len(words)
    for n in {len(w) for w in windows}:
        for k in range(len(words) - n + 1):
            if tuple(x[0] for x in words[k : k + n]) in windows:
                hit[k : k + n] = [True] * n
    out, at, k = [], 0, 0
    while k < len(words):
        if hit[k]:
            end = k
            while end + 1 < len(words) and hit[end + 1]:
                end += 1
            out.append(text[at : words[k][1]])
            at, k = words[end][2], end
        k += 1
    return "".join(out) + text[at:]


def test_stages_equal_plain_versions_row_by_row(spark, tmp_path):
    import corpus_pipeline

    table = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    bench = pd.read_parquet("/root/testdata/sf0.001/benchmark.parquet")
    bench.to_parquet(tmp_path / "benchmark.parquet")
    docs = spark.createDataFrame(table.astype(object).where(table.notna(), None).values.tolist(), SCHEMA)
    model = lang_id.fit(docs.filter(corpus_pipeline.remainder(4) != 2))
    even = 1 / len(model.langs)
    sure = set()
    for i, t in zip(table.doc_id, table.text, strict=True):
        if t and any(map(str.isalpha, t)) and float(model.predict(pa.array([t])).max()) >= even + corpus_pipeline.LEAST_MARGIN * (1 - even):
            sure.add(i)
    assert {r["doc_id"] for r in corpus_pipeline.language(spark, docs, str(tmp_path)).collect()} == sure
    items = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD)) for t in bench.text]
    clean = {r["doc_id"]: r["text"] for r in corpus_pipeline.benchmark_free(spark, docs, str(tmp_path)).collect()}
    assert all(clean[i] == plain_clean(t, items) for i, t in zip(table.doc_id, table.text, strict=True) if t)
    assert any(clean[i] != t for i, t in zip(table.doc_id, table.text, strict=True))
    private = {r["doc_id"]: r["text"] for r in corpus_pipeline.private(spark, docs, str(tmp_path)).collect()}
    found = pii.pseudonymise(docs, pii.KEY).select("doc_id", *[f"n_{k}" for k in pii.KINDS]).collect()
    touched = {r["doc_id"] for r in found if sum(r[f"n_{k}"] for k in pii.KINDS)}
    for i, t in zip(table.doc_id, table.text, strict=True):
        assert (private[i] == t) == (i not in touched) or t is None
        if t:  # formats stay: what is a digit, a letter or a sign is one afterwards
            shape = lambda x: re.sub("[A-Za-z]", "a", re.sub("[0-9]", "0", x))
            assert re.sub("[0a]", "", shape(private[i])) == re.sub("[0a]", "", shape(t))
