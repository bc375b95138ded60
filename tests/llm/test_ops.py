"""Operators over small tables against plain versions: nulls, empty and long texts, ties, repeats, empty tables and
clashing column names."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinelake.llm import brown_lm, byte_bpe, components, dac, decontaminate, jaccard_join, lang_id, pii, quality, sketch, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def lower(text):
    return (text or "").encode().lower()


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "A"), (5, "a"), (5, "a"), (6, "é" * 5000), (7, "word " * 3000), (8, "mail Jo@x.example.com, 4111 1111 1111 1111!")]


# ---------------------------------------------------------------- 2


def plain_components(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = lower(t).split()
        sets.setdefault(i, []).append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    ids = sorted(i for i in sets if i is not None)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted(((i, len(s), find(i) if i is not None else None) for i in sets for s in sets[i]), key=str)


@pytest.mark.parametrize(("n", "percent", "group", "hot"), [(3, 90, 48, 8192), (3, 80, 4, 30), (5, 80, 6, 20)])
def test_jaccard_components_equal_all_pairs(spark, n, percent, group, hot):
    rnd = random.Random(n * percent)
    words = [f"w{k}" for k in range(60)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 80))] for _ in range(20)]
    rows = []
    for i in range(240):
        b = list(base[0] if i % 3 == 0 else rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 3])):
            b[rnd.randrange(len(b))] = rnd.choice(words)
        rows.append((i * 7 % 239 if i < 239 else 5, " ".join(b)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "A"), (1004, "a"), (None, "a")]
    found = jaccard_join.jaccard_components(docs_of(spark, rows), n, percent, group=group, hot=hot)
    assert sorted(map(tuple, found.collect()), key=str) == plain_components(rows, n, percent)


def test_components_of_chains_and_of_no_edges(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 100), (7, 7), (None, 3)]
    found = {r[0]: r[1] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(41)} | {90: 90, 100: 90}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- 3


def test_language_model_counts_and_base(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["the", "of", "a", "Cat", "dog", f"x{rnd.randint(0, 40)}"]) for _ in range(rnd.randint(0, 30)))) for i in range(120)] + [(500, None), (501, " "), (501, " ")]
    found = brown_lm.score(docs_of(spark, rows), brown_lm.remainder(7) == 2, head=12, classed=8, core=4, classes=2, rounds=3).collect()
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*lower(t).split(), None])
    n, v = sum(counts.values()), len(counts)
    by = Counter()
    for r in found:
        by[r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"], round(r["base_score"], 6)] += 1
        assert math.isfinite(r["score"]) and r["score"] < 0
    expect = Counter()
    for i, t in rows:
        w = [*lower(t).split(), None]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        expect[i, len(w), sum(counts[x] > 0 for x in w), n, zlib.crc32(str(i).encode()) % 7 == 2, round(base, 6)] += 1
    assert by == expect


@pytest.mark.parametrize("head", [12, 500])
def test_language_model_scores_equal_a_plain_model(spark, head):
    rnd = random.Random(9)
    rows = [(k, " ".join(f"{rnd.choice('nv')}{int(rnd.paretovariate(0.5)) % 60}" for _ in range(rnd.randint(0, 25)))) for k in range(90)]
    rows += [(400, "unseen " * 3 + "n1"), (403, None), (403, " "), (401, "n1 " * 900)]
    docs = docs_of(spark, rows).withColumn("score", F.lit("clash")).withColumn("row", F.lit("clash"))
    held = brown_lm.remainder(7) == 2
    shape = dict(head=head, classed=8, core=4, classes=3, rounds=3, passes=2, least=2)
    of = brown_lm.learn(docs.filter(~held), **shape)
    learnt = [[*lower(t).split(), None] for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for text in learnt for w in text if w)
    hashed = {w: brown_lm.K.hash_word(w) for w in counts}
    told = {r["word"] % 2**64: (r["c"], r["state"]) for r in of.known.collect()}
    number = brown_lm.numbered(of.hashes)
    state = {}
    for w, h in hashed.items():
        at = int(number.find(np.array([h], np.uint64))[0])
        state[w] = int(of.state[at]) if at >= 0 else told[h][1]
        assert h not in told or told[h] == (counts[w], state[w])
    # every word above the least count has a class, those of 1 share the last; each takes the class its neighbours speak for
    frequent = {w for w, h in hashed.items() if h not in told}
    assert all((state[w] < 3) == (c >= 2) for w, c in counts.items() if w not in frequent) and sum(c >= 2 for c in counts.values()) > 20
    table = brown_lm.votes(of.joint, 3)
    seen = lambda w: 4 if w is None else state[w] if w in frequent else 3
    ballot = {}
    for text in learnt:
        seq = [None, *text]
        for before, w, after in zip(seq, seq[1:], seq[2:], strict=False):
            ballot[w] = ballot.get(w, 0) + table[seen(before) * 5 + seen(after)]
    assert all(state[w] == int(ballot[w].argmax()) for w, c in counts.items() if w not in frequent and c >= 2)
    links, size = Counter(), Counter()
    for text in learnt:
        seq = [4, *(4 if w is None else state[w] for w in text)]
        links.update(zip(seq, seq[1:], strict=False))
        size.update(seq[1:])
    into = np.array([sum(links[a, b] for a in range(5)) + 0.5 for b in range(5)])
    step = lambda a, b: math.log10((links[a, b] + 20 * into[b] / into.sum()) / (sum(links[a, x] for x in range(5)) + 20))
    rare = [w for w in counts if state[w] == 3]
    bottom = sum(counts[w] for w in rare) + len(rare) + 1
    expect = Counter()
    for i, t in rows:
        words = lower(t).split()
        seq = [4, *(state.get(w, 3) for w in words), 4]
        emit = sum(math.log10(counts[w] / size[state[w]]) if state.get(w, 3) < 3 else math.log10((counts[w] + 1) / bottom) for w in words)
        expect[i, round(emit + sum(step(a, b) for a, b in zip(seq, seq[1:], strict=False)), 6)] += 1
    found = brown_lm.score(docs, held, weight=20.0, **shape).collect()
    assert Counter((r["doc_id"], round(r["score"], 6)) for r in found) == expect
    # the rare words' class is a distribution over its words and one word never seen
    assert abs(sum((counts[w] + 1) / bottom for w in rare) + 1 / bottom - 1) < 1e-9


def test_language_model_without_training_rows(spark):
    found = brown_lm.score(docs_of(spark, [(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found) == [(1, 3, 0, 0), (2, 1, 0, 0)]
    assert brown_lm.score(docs_of(spark, [(1, "a")]).limit(0), F.lit(False)).count() == 0


# ---------------------------------------------------------------- 4


def test_byte_bpe_equals_the_whole_text_however_it_is_cut(spark):
    ranks, pattern = byte_bpe.production()
    whole = byte_bpe.encoder(open(ranks, "rb").read(), pattern)
    rnd = random.Random(1)
    bits = ["a", "bc", " ", "  ", "\n", "1", "'s", "!", "é", " ", "x" * 5, "ab'll"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 300))) for _ in range(120)]
    texts += ["a" * 300, " " * 300, "\n" * 200 + "x", "x" * 150 + " " + "y" * 3 + "'s " * 50, None, "", "é" * 200 + "'s", "a", "a"]
    docs = docs_of(spark, list(enumerate(texts))).withColumn("_kept", F.lit(1)).withColumn("ids", F.lit("clash"))
    for chunk, overlap in ((32, 8), (17, 40)):
        coded = byte_bpe.decode(byte_bpe.encode(docs, ranks, pattern, out="tokens", chunk=chunk, overlap=overlap, decoded="back"), ranks, pattern, ids="tokens")
        found = {r["doc_id"]: r for r in coded.collect()}
        assert len(found) == len(texts) and found[0]["ids"] == "clash" and found[0]["_kept"] == 1
        assert all(r["back"] == r["decoded"] for r in found.values())
        for i, t in enumerate(texts):
            assert np.frombuffer(found[i]["tokens"], "<u4").tolist() == whole.encode_ordinary(t or "")
            assert bytes(found[i]["decoded"]) == (t or "").encode()


# ---------------------------------------------------------------- 1


def test_pseudonyms_keep_format_validity_and_links(spark):
    text = "call +1 (017) 555-7713 or 017-555-7713, Jo.Doe9@m.example.com; 4111 1111 1111 1111, 4111111111111111, 4111111111111112; 10.0.255.3; 1980-02-29 29.02.1980 02/29/1980 1981-02-29; 123-45-6789 666-12-1234; GB82 WEST 1234 5698 7654 32"
    rows = pii.pseudonymise(docs_of(spark, [(1, text), (3, ""), (9, None)]), "key").collect()
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["text"] == "" and by[9]["text"] is None and by[9]["n_card"] == 0
    new = by[1]["text"]
    assert (by[1]["n_phone"], by[1]["n_email"], by[1]["n_card"], by[1]["n_ip"], by[1]["n_date"], by[1]["n_ssn"], by[1]["n_iban"]) == (2, 1, 2, 1, 3, 1, 1)
    for kept in ("4111111111111112", "1981-02-29", "666-12-1234", "@m.example.com", "+1 ("):
        assert kept in new
    for gone in ("555-7713", "Jo.Doe9", "4111 1111", "4111111111111111", "10.0.255.3", "1980-02-29", "123-45-6789", "WEST 1234"):
        assert gone not in new
    import re

    digits = lambda s: re.sub(r"\D", "", s)
    spaced, plain = re.search(r"\d{4} \d{4} \d{4} \d{4}", new)[0], re.search(r"(?<!\d)\d{16}(?!\d)", new)[0]
    assert digits(spaced) == plain
    total = sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(plain))))
    assert total % 10 == 0
    a, b = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4})", new).groups(), re.search(r"or (\d{3})-(\d{3})-(\d{4})", new).groups()
    assert a == b
    y, m, d, d2, m2, y2, m3, d3, y3 = re.search(r"(\d{4})-(\d\d)-(\d\d) (\d\d)\.(\d\d)\.(\d{4}) (\d\d)/(\d\d)/(\d{4})", new).groups()
    assert (y, m, d) == (y2, m2, d2) == (y3, m3, d3) and pd.Timestamp(f"{y}-{m}-{d}") is not None
    other = pii.pseudonymise(docs_of(spark, [(1, text)]), "another key").first()["text"]
    assert other != new


def test_pseudonyms_equal_a_plain_feistel_network(spark):
    import datetime

    key = "k"

    def f(tweak, i, x):
        return int(hashlib.sha256(f"{key}|{tweak}|{i}|{x}|{key}".encode()).hexdigest()[:15], 16)

    def network(left, right, a, b, tweak):
        for i in range(pii.ROUNDS):
            if i % 2 == 0:
                left = (left + f(tweak, i, right) % a) % a
            else:
                right = (right + f(tweak, i, left) % b) % b
        return left, right

    def digits(d, tweak):
        u = len(d) // 2
        x, y = network(int(d[:u]), int(d[u:]), 10**u, 10 ** (len(d) - u), tweak)
        return f"{x:0{u}d}{y:0{len(d) - u}d}"

    def luhn(body):
        total = sum(x if k % 2 else 2 * x - 9 * (x > 4) for k, x in enumerate(map(int, reversed(body))))
        return body + str(-total % 10)

    def dressed(shape, d):
        it = iter(d)
        return "".join(next(it) if c.isdigit() else c for c in shape)

    def day(text):
        n = (datetime.date.fromisoformat(text) - datetime.date(1900, 1, 1)).days
        x, y = network(n // pii.DAYS[1], n % pii.DAYS[1], *pii.DAYS, "date")
        return (datetime.date(1900, 1, 1) + datetime.timedelta(x * pii.DAYS[1] + y)).isoformat()

    def ssn(text):
        area, group, serial = map(int, text.split("-"))
        x, y = network(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn")
        return f"{x + 1 + (x >= 665):03d}-{y // 9999 + 1:02d}-{y % 9999 + 1:04d}"

    def ip(text):
        o = list(map(int, text.split(".")))
        x, y = network(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip")
        return f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"

    want = {
        "4111 1111 1111 1111": dressed("0000 0000 0000 0000", luhn(digits("411111111111111", "card"))), "5500-0000-0000-0004": dressed("0000-0000-0000-0000", luhn(digits("550000000000000", "card"))),
        "1999-12-31": day("1999-12-31"), "123-45-6789": ssn("123-45-6789"), "700-01-0001": ssn("700-01-0001"), "10.0.255.3": ip("10.0.255.3"), "(017) 555-7713": dressed("(000) 000-0000", digits("0175557713", "phone")),
        "+1 017 555 7713": "+1 " + dressed("000 000 0000", digits("0175557713", "phone")),
    }
    rows = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs_of(spark, list(enumerate(f"a {x} b" for x in want))), key).collect()}
    assert rows == {k: f"a {x} b" for k, x in enumerate(want.values())}


def test_cards_beside_other_numbers_and_long_secrets(spark):
    import re

    card, plain = "4111 1111 1111 1111", "4111111111111111"
    texts = [f"{card} 123", f"{plain} 99", f"order 12 {card}", f"1234 {card} 99", f"no.{plain}", f"x-{plain}", f"12 {card} 7 {plain} 5", f"{plain} 2 {plain}"]
    texts += [f"{plain} 1980-02-29", f"{plain} 29.02.1980", f"12 {plain} 123-45-6789", "token=" + "0aF9" * 50, "1" * 40, "0." + plain, "3 " * 20000, "9" * 50000, "4 " * 16]
    rows = {r["doc_id"]: r for r in pii.pseudonymise(docs_of(spark, list(enumerate(texts))), "key").collect()}
    for k in range(11):
        assert card not in rows[k]["text"] and plain not in rows[k]["text"], texts[k]
        assert re.sub(r"\d", "0", rows[k]["text"]) == re.sub(r"\d", "0", texts[k])
        assert rows[k]["n_card"] == (2 if k in (6, 7) else 1), texts[k]
    assert rows[2]["text"].startswith("order 12 ") and rows[1]["text"].endswith(" 99") and rows[0]["text"].endswith(" 123")
    assert [rows[k]["n_date"] for k in (8, 9)] == [1, 1] and rows[10]["n_ssn"] == 1
    assert rows[11]["n_secret"] == 1 and len(rows[11]["text"]) == len(texts[11]) and rows[11]["text"] != texts[11]
    assert all(rows[k]["text"] == texts[k] for k in (12, 13, 15))


def test_feistel_is_a_permutation_and_goes_back(spark):
    d = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    p = d.select("d", pii.permute_digits(F.col("d"), "k", "t").alias("p"))
    row = p.select(F.count_distinct("p").alias("n"), F.count_if(pii.permute_digits(F.col("p"), "k", "t", True) == F.col("d")).alias("back")).first()
    assert tuple(row) == (1000, 1000)
    f = spark.range(898 * 3).select(pii.feistel(F.floor(F.col("id") / 3), F.col("id") % 3, F.lit(898), F.lit(3), "k", "s").alias("f"))
    assert f.select(F.count_distinct("f.l", "f.r"), F.max("f.l"), F.max("f.r")).first()[0] == 898 * 3


def test_pii_of_odd_rows(spark):
    found = {(r["doc_id"], r["text"]) for r in pii.pseudonymise(docs_of(spark, ODD[:8]), "k").collect()}
    assert found == {(i, t) for i, t in ODD[:8]}
    assert pii.pseudonymise(docs_of(spark, [(1, "x")]).limit(0), "k").count() == 0


# ---------------------------------------------------------------- 2, 5, 9: the SQL is the plain version


def test_join_sketch_and_decontamination_equal_their_sql(spark):
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(30)]
    rows = [*ODD, *((20 + i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))) for i in range(60)), (None, "null id words here and more words")]
    docs = docs_of(spark, rows)
    items = [(1, "W1 w2 w3"), (2, None), (3, rows[20][1]), (4, "a"), (3, "a"), (7, "!!"), (None, rows[30][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    heavy = docs.unionByName(docs_of(spark, [(25, f"many rows share this id {k}") for k in range(80)] + [(None, f"or have none {k}") for k in range(60)]))
    con.register("documents_", heavy.toPandas()[["doc_id", "text"]].astype({"doc_id": "Int64"}))
    assert plain_rows(sketch.edited(heavy).toPandas()) == plain_rows(con.execute(sketch.OP5_SQL.replace("FROM documents", "FROM documents_")).df())
    again = docs.unionByName(docs_of(spark, [(200 + i, rows[30 + i % 9][1] + " " + rows[31][1]) for i in range(20)]))
    con.register("documents_2", again.toPandas()[["doc_id", "text"]].astype({"doc_id": "Int64"}))
    assert plain_rows(jaccard_join.jaccard_components(again, 3, 90).toPandas()) == plain_rows(con.execute(jaccard_join.OP2_SQL.replace("FROM documents", "FROM documents_2")).df())
    for df, sql in ((sketch.edited(docs), sketch.OP5_SQL), (decontaminate.digest(decontaminate.decontaminate(docs, bench, columns=["doc_id"], block_windows=4)), decontaminate.OP9_SQL)):
        got, want = df.toPandas(), con.execute(sql).df()
        assert plain_rows(got) == plain_rows(want)


def plain_rows(df):
    """Rows as texts in order, with whole numbers written alike."""
    cell = lambda x: "~" if pd.isna(x) else f"{x:.9g}" if isinstance(x, int | float | np.number) and not isinstance(x, bool | np.bool_) else str(x)
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


def test_decontamination_cuts_words_and_handles_empty_tables(spark):
    docs = docs_of(spark, [(1, "Keep this: one two THREE four! and keep."), (2, "one two"), (3, None)]).withColumn("n_words", F.lit("clash"))
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    found = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, bench, columns=["doc_id", "text"], clean=True).collect()}
    assert found[1]["text"] == "Keep this: ! and keep." and found[2]["text"] == "one two" and found[3]["text"] is None
    assert decontaminate.decontaminate(docs, bench.limit(0), columns=["doc_id"]).filter("size(hit_spans) > 0").count() == 0
    assert decontaminate.decontaminate(docs.limit(0), bench, columns=["doc_id"]).count() == 0


def test_sketch_merge_and_containment(spark):
    part = " ".join(f"w{k}" for k in range(200))
    whole = part + " " + " ".join(f"v{k}" for k in range(2000))
    row = spark.createDataFrame([(part, whole)], "a string, b string").select(sketch.fingerprint(F.col("a")).alias("a"), sketch.fingerprint(F.col("b")).alias("b"))
    got = row.select(sketch.containment(F.col("a"), F.col("b")), sketch.containment(F.col("b"), F.col("a")), F.size(sketch.hashes(sketch.merge(F.col("a"), F.col("b")))) == F.size(sketch.hashes(F.col("b")))).first()
    assert got[0] == 1 and got[1] < 0.2 and got[2]


# ---------------------------------------------------------------- 6, 7, 10


def test_language_id_of_odd_rows(spark):
    train = docs_of(spark, [(i, "the and of to in " * 8) for i in range(8)]).unionByName(docs_of(spark, [(10 + i, "der und die ist zu " * 8) for i in range(8)]).withColumn("lang", F.lit("de")))
    model = lang_id.fit(train.unionByName(docs_of(spark, [(99, "x")]).withColumn("lang", F.lit(None).cast("string"))))
    found = {(r["doc_id"], r["text"]): r for r in lang_id.identify(docs_of(spark, [*ODD, (50, "the and of"), (51, "der und die"), (52, "123 !!")]), model).collect()}
    assert found[50, "the and of"]["lang_pred"] == "en" and found[51, "der und die"]["lang_pred"] == "de"
    assert {found[k]["lang_pred"] for k in [(1, None), (2, ""), (3, " \n\t"), (52, "123 !!")]} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in found.values())
    none = lang_id.identify(docs_of(spark, ODD), lang_id.fit(train.limit(0)))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def test_quality_and_toxicity_of_odd_rows(spark):
    docs = docs_of(spark, ODD)
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    graded = quality.grade(docs, quality.fit(docs, labels)).collect()
    assert len(graded) == len(ODD) and all(0 <= r["p_tail"] <= 1 for r in graded)
    assert {r["keep"] for r in quality.grade(docs, quality.fit(docs, labels.limit(0))).collect()} == {False}
    model = toxicity.fit(docs, labels)
    scored = toxicity.assess(docs, model).collect()
    assert len(scored) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in scored)
    assert {r["score"] for r in toxicity.assess(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}


# ---------------------------------------------------------------- 8


def test_token_files_give_back_every_document(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from kinelake.llm.store import new_path

    path = P.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows = [*ODD, (None, "null id"), *((100 - i, f"doc number {i}, it's") for i in range(50))]
    out = new_path(spark, "dac")
    dac.write(docs_of(spark, rows), path, out, 4, block_tokens=40)
    found = sorted(map(tuple, dac.read(spark, out).collect()), key=lambda r: r[1])
    ids = sorted(((i is not None, i or 0), [*whole.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows)
    at = 0
    for (key, want), got in zip(ids, found, strict=True):
        assert got == (key[1] if key[0] else None, at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        at += len(want)
    empty = new_path(spark, "dac")
    dac.write(docs_of(spark, [(1, "x")]).limit(0), path, empty, 4)
    assert dac.read(spark, empty).count() == 0


    # an id of many rows is parted over shards; any token can be had by its place
    many = [(7, f"text number {k}") for k in range(60)] + [(None, f"no id {k}") for k in range(40)] + [(i, "word " * i) for i in range(30)]
    parted = new_path(spark, "dac")
    dac.write(docs_of(spark, many), path, parted, 6, block_tokens=30)
    found = sorted(dac.read(spark, parted).collect(), key=lambda r: r["start"])
    key = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
    assert key == sorted(key) and Counter(key) == Counter((i is not None, i or 0) for i, _ in many)
    assert spark.read.parquet(parted).select("shard").distinct().count() > 3
    crc = {r["ids_crc32"] for r in found}
    assert crc == {zlib.crc32(np.array([*whole.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()) for _, t in many}
    n = sum(r["n_tokens"] for r in found)
    got = {r["place"]: r["token"] for r in dac.tokens_at(spark.range(-2, n + 3).toDF("place"), parted).collect()}
    assert len(got) == n + 5 and got[-1] is None and got[n] is None
    for r in found:
        ids = np.array([got[r["start"] + k] for k in range(r["n_tokens"])], "<u4")
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]


# ---------------------------------------------------------------- names that clash, empty tables, long texts


def clashing(docs):
    names = "lang_pred score expected_grade p_tail keep predicted n_card n_email _found _parts _kinds _new _told _row _node n_words hit_spans hit_items decoded tokens held_out n_tokens states tail component_id a.b a`b".split()
    return docs.select("*", *[F.lit(n).alias(n) for n in names])


def models(spark):
    train = docs_of(spark, [(i, "the and of to in " * 4) for i in range(6)])
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(6)], "doc_id long, quality int, toxic int")
    return lang_id.fit(train), quality.fit(train, labels), toxicity.fit(train, labels)


def test_columns_that_are_called_as_outputs(spark):
    docs = clashing(docs_of(spark, ODD))
    lang, grades, toxic = models(spark)
    ranks, pattern = byte_bpe.production()
    bench = spark.createDataFrame([(1, "word word word")], "item_id long, text string")
    made = {
        "lang_pred": lang_id.identify(docs, lang), "p_tail": quality.grade(docs, grades), "predicted": toxicity.assess(docs, toxic), "n_card": pii.pseudonymise(docs, "k"),
        "hit_spans": decontaminate.decontaminate(docs, bench, clean=True), "tokens": byte_bpe.encode(docs, ranks, pattern, out="tokens", decoded="decoded"),
    }
    for name, df in made.items():
        rows = df.collect()
        assert len(rows) == len(ODD) and sorted(df.columns) == sorted(set(df.columns)), name
        assert all(r[name] != name for r in rows) and {r["_row"] for r in rows} == {"_row"} and {r["_told"] for r in rows} == {"_told"}
    assert {r["n_card"] for r in made["n_card"].collect()} == {0, 1} and {r["_found"] for r in made["n_card"].collect()} == {"_found"}
    plain = docs_of(spark, ODD)
    for f in (lambda d: jaccard_join.jaccard_components(d, 3, 90), lambda d: brown_lm.score(d, brown_lm.remainder(7) == 2, head=9, classed=6, core=3, classes=2), sketch.edited):
        assert sorted(map(str, f(docs).collect())) == sorted(map(str, f(plain).collect()))


def test_empty_tables(spark):
    none = docs_of(spark, [(1, "x")]).limit(0)
    lang, grades, toxic = models(spark)
    ranks, pattern = byte_bpe.production()
    bench = spark.createDataFrame([(1, "word word word")], "item_id long, text string")
    for df in (
        jaccard_join.jaccard_components(none, 3, 90), brown_lm.score(none, F.lit(False)), byte_bpe.encode(none, ranks, pattern, decoded="back"), sketch.edited(none), lang_id.identify(none, lang), quality.grade(none, grades),
        decontaminate.decontaminate(none, bench, clean=True), toxicity.assess(none, toxic), pii.pseudonymise(none, "k"),
    ):
        assert df.count() == 0
    assert lang_id.fit(none).langs == [] and toxicity.fit(none, spark.createDataFrame([], "doc_id long, toxic int")) is None


def test_very_long_texts(spark):
    rnd = random.Random(8)
    words = [f"w{rnd.randrange(30000)}" for _ in range(60000)]
    near = words.copy()
    near[5] = near[40000] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[:30000])), (4, "x" * 300_000), (5, "x" * 300_000)]
    docs = docs_of(spark, rows)
    assert sorted(map(tuple, jaccard_join.jaccard_components(docs, 3, 90).collect())) == plain_components(rows, 3, 90)
    found = {r["doc_id"]: r for r in brown_lm.score(docs, F.col("doc_id") == 2, head=500, classed=60, core=20, classes=4).collect()}
    assert found[2]["n_tokens"] == 60001 and found[2]["n_known"] == 59999 and found[4]["n_known"] == 2 and math.isfinite(found[1]["score"])
    spans = {r["doc_id"]: r["hit_spans"] for r in decontaminate.decontaminate(docs, spark.createDataFrame([(1, " ".join(words[29990:30020]))], "item_id long, text string"), columns=["doc_id"]).collect()}
    assert spans[1] == [29990, 30020] and spans[3] == [29990, 30000] and spans[4] == []
    lang, grades, toxic = models(spark)
    for df in (lang_id.identify(docs, lang), quality.grade(docs, grades), toxicity.assess(docs, toxic), pii.pseudonymise(docs, "k"), sketch.edited(docs.limit(2))):
        assert df.count() in (5, 2)


def test_words_that_a_polynomial_hash_takes_as_one(spark):
    a, b = "ab", "ba"
    for _ in range(10):
        a, b = a + b, b + a
    docs = docs_of(spark, [(1, a), (2, b)])
    assert {r["component_id"] for r in jaccard_join.jaccard_components(docs, 3, 90).collect()} == {1, 2}
    assert {r["doc_id"]: r["n_known"] for r in brown_lm.score(docs, F.col("doc_id") == 2).collect()} == {1: 2, 2: 1}
    bench = spark.createDataFrame([(1, a)], "item_id long, text string")
    assert {r["doc_id"]: r["hit_spans"] for r in decontaminate.decontaminate(docs, bench, columns=["doc_id"]).collect()} == {1: [0, 1], 2: []}


def test_samples_are_of_rows_and_bounded(spark):
    from kinelake.llm import sampling

    rows = [(1, f"text {k}") for k in range(50)] + [(2, "same")] * 50
    docs = docs_of(spark, rows).withColumn("lang", F.when(F.col("text") == "same", "xx").otherwise("en"))
    texts, labels = sampling.own(docs, "lang", 400)
    assert sorted(zip(texts, labels, strict=True)) == sorted({(t, "xx" if t == "same" else "en") for _, t in rows})
    assert len(sampling.own(docs, "lang", 5)[0]) <= 20
    labels_ = spark.createDataFrame([(1, 1)] * 40 + [(2, 0)], "doc_id long, toxic int")
    texts, y = sampling.labelled(docs, labels_, "toxic", 60)
    assert len(texts) == 51 and y.count(1) == 50
    kinds = docs_of(spark, [(k, f"t{k}") for k in range(300)]).withColumn("lang", F.col("text"))
    assert len(sampling.own(kinds, "lang", 3)[0]) == 300 and len(sampling.own(kinds, "lang", 3, kinds=64)[0]) == 64


def test_account_numbers_before_other_words(spark):
    texts = ["AT61 1904 3002 3457 3201 NOW", "pay GB82 WEST 1234 5698 7654 32 A1 today", "AT61 1904 3002 3457 3201 4111 1111 1111 1111", "XX12 4111 1111 1111 1111", "AB12 CDEF GHIJ KLMN", "DE89 3704 0044 0532 0130 00"]
    got = {r["doc_id"]: r for r in pii.pseudonymise(docs_of(spark, list(enumerate(texts))), "k").collect()}
    assert [(got[k]["n_iban"], got[k]["n_card"]) for k in range(6)] == [(1, 0), (1, 0), (1, 1), (0, 1), (0, 0), (1, 0)]
    for k, gone in ((0, "1904 3002"), (1, "1234 5698"), (2, "1904 3002"), (2, "4111 1111"), (3, "4111 1111"), (5, "3704 0044")):
        assert gone not in got[k]["text"] and len(got[k]["text"]) == len(texts[k])
    assert got[0]["text"].endswith(" NOW") and got[1]["text"].endswith(" A1 today") and got[4]["text"] == texts[4]


# ---------------------------------------------------------------- the pipeline


def test_pipeline_keeps_unlike_rows_and_rejects_what_no_language_holds(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(6)
    en, de = ["the", "and", "of", "that", "with", "this"], ["der", "und", "die", "nicht", "auch", "eine"]
    text = lambda v, n: " ".join(rnd.choice(v) + rnd.choice(["ing", "er", "on", ""]) for _ in range(n))
    rows = [(i, text(en if i % 2 else de, 60), "en" if i % 2 else "de") for i in range(150)]
    half = " ".join(text(v, 90)[:300] for _ in range(4) for v in (en, de))
    held = next(i for i in range(200, 300) if zlib.crc32(str(i).encode()) % 4 == 2)
    rows += [(held, half, "en"), (199, "??? 12", "en")]
    docs = clashing(spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows], SCHEMA))
    kept = corpus_pipeline.language(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == set(range(150)) and kept.columns == docs.columns and kept.first()["lang_pred"] == "lang_pred"

    # of rows that share an id, unlike ones stay; equal ones and near copies go
    a, b, c = text(en, 50), text(en, 50), text(de, 50)
    rows = [(7, a), (7, b), (7, b), (8, a), (9, None), (9, None), (None, c), (None, c + " und"), (10, ""), (11, "")]
    docs = docs_of(spark, rows)
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies(spark, docs, "").collect()), key=str)
    assert got == sorted([(8, a), (7, b), (9, None), (10, ""), (11, ""), min([(None, c), (None, c + " und")], key=lambda x: [r for r in got if r[1] == x[1]] == [])], key=str)
    # against all pairs, with ids that tell rows apart
    words = [f"w{k}" for k in range(40)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 60))] for _ in range(8)]
    rows = []
    for i in range(60):
        t = list(rnd.choice(base))
        if i % 3:
            t[rnd.randrange(len(t))] = rnd.choice(words)
        rows.append((i, " ".join(t)))
    left = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs_of(spark, rows), "").collect()}
    assert left == {root for _, _, root in plain_components(rows, 5, 80)}
    none = docs.limit(0)
    bench = str(tmp_path / "benchmark.parquet")
    spark.createDataFrame([(1, "some words")], "item_id long, text string").write.parquet(bench)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(5)
    en, de = ["the", "and", "of", "that", "with", "this"], ["der", "und", "die", "nicht", "auch", "eine"]
    text = lambda v, n: " ".join(rnd.choice(v) + rnd.choice(["ing", "er", "on", ""]) for _ in range(n))
    rows = [(i, text(en if i % 2 else de, 60), "en" if i % 2 else "de") for i in range(40)]
    rows += [(100, rows[3][1], "en"), (101, rows[3][1] + " more", "en"), (102, "1234 !!", "en"), (103, None, "en")]
    secret = "This holds a passage of the benchmark that nobody should have seen in training at all"
    rows += [(104, text(en, 30) + " " + secret + " " + text(en, 30), "en"), (105, text(en, 40) + " 4111111111111111 ok", "en")]
    d = str(tmp_path)
    spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, secret)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{d}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, d)
        assert k == 4 or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{d}/out{k}")
        docs = spark.read.parquet(f"{d}/out{k}")
        kept.append({r["doc_id"]: r for r in docs.collect()})
    assert set(range(40)) <= set(kept[0]) and not {102, 103} & set(kept[0])
    assert set(kept[0]) - set(kept[1]) == {100, 101}
    assert secret not in kept[2][104]["text"] and set(kept[2]) == set(kept[1]) and kept[2][5]["text"] == kept[1][5]["text"]
    assert kept[2][104]["n_chars"] == len(kept[2][104]["text"])
    assert "4111111111111111" not in kept[3][105]["text"]
    assert kept[4][5]["decoded_sha256"] == hashlib.sha256(kept[3][5]["text"].encode()).hexdigest() and set(kept[4]) == set(kept[1])


def test_entry_imports_without_the_pipeline(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/kinelake", tmp_path / "kinelake", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and 'op2_jaccard_join' in q and 'q_rollup' in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_jaccard_blocks_get_texts_of_near_classes_alone(spark, monkeypatch):
    """Classes that share an n-gram and are alike to none are told apart by sizes of parts: of 61 at most the near two
    have their texts sent, and no set is kept (as many bytes a word as a text has)."""
    rnd = random.Random(5)
    rows = [(i, " ".join(["the same words", *(f"w{rnd.randrange(10**6)}" for _ in range(20))])) for i in range(60)]
    rows.append((60, rows[59][1] + " more"))
    kept, old = [], jaccard_join.keep
    monkeypatch.setattr(jaccard_join, "keep", lambda df, name, **k: kept.append((name, old(df, name, **k))) or kept[-1][1])
    monkeypatch.setattr(jaccard_join, "done", lambda df: None)
    monkeypatch.setattr(jaccard_join, "scratch", lambda s: __import__("contextlib").nullcontext())
    monkeypatch.setattr(jaccard_join, "probe_length", lambda x, percent: x)  # so that all n-grams are dealt out
    monkeypatch.setattr(jaccard_join, "index_length", lambda x, percent: x)
    found = jaccard_join.jaccard_components(docs_of(spark, rows), 3, 90, group=4)
    assert sorted(map(tuple, found.collect()), key=str) == plain_components(rows, 3, 90)
    assert "sets" not in {name for name, _ in kept}
    near = [df for name, df in kept if name == "near"]
    assert near and all(df.count() <= 2 for df in near)
    assert all(len(r["parts"]) == 64 for r in dict(kept)["classes"].collect())
