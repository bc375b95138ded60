"""Conversation repair, clusters around centroids and line labelling against plain versions: nulls, empty and long texts,
ties, repeats, empty tables, clashing names."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from kinelake.llm import centroids, line_crf, repair

# ---------------------------------------------------------------- 11

TURNS = "conv_id long, turn long, role string, text string"


def plain_search(initials, faults):
    """Cheapest first, then least edits, over all rows of roles that can still be completed; no heuristic."""
    queue, seen = [(0, "", 0, "")], {}
    while queue:
        cost, edits, i, roles = heapq.heappop(queue)
        if i == len(initials) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, edits
        if seen.get((i, roles), (cost + 1,)) <= (cost, edits):
            continue
        seen[i, roles] = cost, edits
        ways = [(2, "I", i, x) for x in "ua"]
        if i < len(initials):
            ways.append((3, "D", i + 1, ""))
            if faults[i] != "x":
                more = faults[i] == "t"
                ways += [(more, "K", i + 1, initials[i])] + [(2 + more, "R", i + 1, x) for x in "ua"]
        for price, edit, j, x in ways:
            if re.fullmatch("s?(ua)*u?", roles + x) and len(roles + x) <= 2 * len(initials) + 4:
                heapq.heappush(queue, (cost + price, edits + edit, j, roles + x))


def test_search_equals_a_plain_one_whole_and_in_chunks_of_chunks():
    rnd = random.Random(5)
    for _ in range(120):
        n = rnd.randint(0, 7)
        initials, faults = "".join(rnd.choices("suao", k=n)), "".join(rnd.choices("kkktx", k=n))
        cost, edits = plain_search(initials, faults)
        assert repair.repair(initials, faults) == (cost, edits)
        for size in (1, 3) if n else ():
            parts = [repair._pair(repair.summary(initials[k : k + size], faults[k : k + size])) for k in range(0, n, size)]
            while len(parts) > 1:
                parts = [repair._pair(repair.composed(parts[k : k + 2])) for k in range(0, len(parts), 2)]
            assert repair.ending(parts[0])[0] == cost


def test_heuristic_never_promises_too_much():
    rnd = random.Random(8)
    for _ in range(60):
        n = rnd.randint(1, 6)
        initials, faults = "".join(rnd.choices("suao", k=n)), "".join(rnd.choices("kktx", k=n))
        promised = sum({"x": 3, "t": 1, "k": 0}[f] for f in faults)
        assert repair.repair(initials, faults)[0] >= promised


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def plain_repair(rows, damaged):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults, seen = [], set()
        for _, _, role, text in mine:
            inner = text.strip("\x20\t\n\x0b\x0c\r")
            faults.append("b" if not inner else "d" if (role, text) in seen else "t" if inner[-1] not in ".!?" else "k")
            seen.add((role, text))
        initials = "".join(r[2][:1] if r[2][:1] in ("s", "u", "a") else "o" for r in mine)
        turns = [r[1] for r in mine if r[1] is not None]
        cost, audit = plain_search(initials, "".join(faults).replace("b", "x").replace("d", "x"))
        fixed, state, at = [], "", 0
        for edit in audit:
            to = "assistant" if state == "u" else "user"
            if edit == "I":
                fixed.append(f"{to}:")
            else:
                _, _, role, text = mine[at]
                at += 1
                if edit == "D":
                    continue
                to = role if edit == "K" else to
                fixed.append(f"{to}:{text}")
            state = to[0]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        out.append((conv, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(fixed).encode()).hexdigest()))
    return sorted(out, key=str)


def odd_turns():
    rnd = random.Random(2)
    rows = [(k, t, rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rnd.choice(["Yes.", "No", "", " \n", "é!", None, f"x{t}.", "Yes. \t"])) for k in range(60) for t in range(rnd.randint(1, 7))]
    rows += [(100, None, "user", "a."), (100, None, "user", "a."), (100, 3, "user", "a."), (101, 5, None, None), (None, 1, "user", "q?"), (None, None, "assistant", "z.")]
    rows += [(102, 2, "user", "same."), (102, 2, "assistant", "same."), (102, 2, "user", "same."), (103, 9, "user", "long " * 20000 + "."), (103, 4, "system", "s.")]
    return rows


@pytest.mark.parametrize(("chunk", "fan"), [(256, 256), (2, 2), (1, 3)])
def test_conversations_equal_a_plain_repair(spark, chunk, fan):
    rows = odd_turns()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS + ", audit int, key string")
    found = repair.repaired(repair.damaged(df), df, chunk=chunk, fan=fan)
    assert sorted(map(tuple, found.collect()), key=str) == plain_repair(rows, damage(rows))


def test_a_long_conversation_goes_through_levels(spark):
    rnd = random.Random(4)
    rows = [(1, t, rnd.choice(["user", "assistant", "user", "assistant", "system"]), rnd.choice([f"m{t}.", f"m{t}", "again."])) for t in range(900)] + [(2, 0, "user", "hi.")]
    df = spark.createDataFrame(rows, TURNS)
    whole = repair.repaired(repair.damaged(df), df, chunk=2000).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, repair.repaired(repair.damaged(df), df, chunk=7, fan=5).collect()))
    one = next(r for r in whole if r["conv_id"] == 1)
    seen, faults, mine = set(), "", damage(rows)[: len(damage(rows)) - 1]
    for _, _, role, text in mine:
        faults += "x" if not text.strip() or (role, text) in seen else "k" if text[-1] in ".!?" else "t"
        seen.add((role, text))
    assert (one["cost"], one["audit"]) == repair.repair("".join(r[2][0] for r in mine), faults)


def test_no_rows_before_or_after_damage(spark):
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], TURNS)
    assert tuple(repair.repaired(repair.damaged(df), df).first()) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    none = df.filter("false")
    assert repair.repaired(repair.damaged(none), none).count() == 0


def test_conversation_sql(spark, tmp_path):
    rows = [r for r in odd_turns()]
    df = spark.createDataFrame(rows, TURNS)
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    found = repair.repaired(repair.damaged(df), df).collect()
    assert sorted(map(tuple, found), key=str) == sorted(con.execute(repair.OP11_SQL).fetchall(), key=str)


# ---------------------------------------------------------------- 12


def plain_clusters(rows, size, k, rounds, seed=3):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    centre = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centre))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centre = [[sum(x) // len(x) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centre)]
    told = [(i, near(v)) for i, v in kept]
    per = Counter()
    for _, (d, j) in told:
        per[j] += d
    fits = lambda n: n if n < 2**63 else None
    return sorted(((i, j, fits(d), fits(per[j]), fits(sum(per.values())), hashlib.sha256(",".join(map(str, centre[j])).encode()).hexdigest()) for i, (d, j) in told), key=str)


VECTORS = "vec_id long, embedding array<double>, cluster int"


@pytest.mark.parametrize("scale", [1.0, 4000.0, 3e6])
def test_clusters_equal_plain_integers(spark, scale):
    rng = np.random.default_rng(1)
    rows = [(k, (rng.normal(size=4) * scale).tolist()) for k in range(60)]
    rows += [(60, [0.0] * 4)] * 3 + [(61, None), (62, []), (63, [1.0] * 5), (64, [1.0, None, 1.0, 1.0]), (65, [float("nan"), 1.0, 1.0, 1.0]), (66, [1.0, float("inf"), 0.0, 0.0]), (None, [0.5] * 4)]
    df = spark.createDataFrame([(*r, 0) for r in rows], VECTORS)
    found = centroids.cluster(df, size=4, clusters=5, rounds=6).collect()
    assert sorted(map(tuple, found), key=str) == plain_clusters(rows, 4, 5, 6)


def test_huge_components_go_through_integers(spark):
    rows = [(0, [1e30, 0.0]), (1, [1e30, 1.0]), (2, [3.0, -1e15]), (3, [0.25, 2.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], VECTORS)
    found = centroids.cluster(df, size=2, clusters=2, rounds=3).collect()
    assert sorted(map(tuple, found), key=str) == plain_clusters(rows, 2, 2, 3)


def test_products_are_exact_or_done_in_integers():
    rng = np.random.default_rng(6)
    for top in (10, 1 << 20, 1 << 26, 1 << 31, 1 << 50):
        x = rng.integers(-top, top, (40, 8))
        c = rng.integers(-top, top, (3, 8)).tolist()
        at, d = centroids.nearest(x.astype(float), c)
        for row, j, got in zip(x.tolist(), at, d, strict=True):
            each = [sum((a - b) ** 2 for a, b in zip(row, o)) for o in c]
            assert (min(each), each.index(min(each))) == (int(got), j)


def test_sums_beyond_float_are_exact():
    x = np.full((5, 2), float((1 << 53) - 1))
    s = centroids.Sums.none(1, 2)
    s.add(x, np.zeros(5, int))
    assert s.sums.tolist() == [[5 * ((1 << 53) - 1)] * 2] and s.counts.tolist() == [5]


def test_few_vectors_and_none(spark):
    df = spark.createDataFrame([(1, [0.1, 0.2], 0), (2, [0.1, 0.2], 0)], VECTORS)
    assert {r["distance"] for r in centroids.cluster(df, size=2).collect()} == {0}
    none = centroids.cluster(df.filter("false"), size=2)
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


# ---------------------------------------------------------------- 13


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    times, hit, seen, dup = Counter(windows), set(), set(), 0
    for k, w in enumerate(windows):
        if times[w] > 1:
            hit.update(range(k, k + 8))
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def odd_texts():
    rnd = random.Random(3)
    texts = [None, "", " \n\t", "A", "a\nA\na", "é ß" * 4000, "\n\n", "w " * 40, "x\n" * 30, "a b c d e f g h\na b c d e f g h", " lead\nlead", "tail \ntail", "<|> #1 & *"]
    return texts + [" ".join(rnd.choices(["one", "two", "Three", "ü", "#"], k=rnd.randint(0, 90))).replace("two one", "two\none") for _ in range(80)]


def test_counts_equal_plain_ones_in_any_batch(spark):
    texts = odd_texts()
    model = line_crf.train(["good words here.\nand more of it."] * 4 + ["### $$$\n%%% &&&"] * 4, [1] * 4 + [0] * 4)
    whole = line_crf.judged(pa.array(texts, pa.string()), model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for k, t in enumerate(texts):
        got = tuple(int(whole[n][k]) for n in names)
        assert got == plain_counts(t)
        alone = line_crf.judged(pa.array([t], pa.string()), model)
        assert all(whole[n][k] == alone[n][0] for n in whole)
        n, repeat = got[0], got[4]
        assert whole["base_failed"][k] == (n < 20 or 100 * repeat > 30 * n)
        assert whole["kept"][k] == (not whole["base_failed"][k] and whole["n_content_words"][k] >= 0.5 * n)
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)] + [(0, None, "clash")], "doc_id long, text string, `a.b` string").withColumnRenamed("a.b", "KEPT")
    rows = line_crf.rules(df, model).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert tuple(r[n] for n in names) == plain_counts(r["text"]) and r["kept"] == bool(whole["kept"][r["doc_id"]])
    assert line_crf.rules(df.filter("false"), model).count() == 0


def test_gradient_of_the_likelihood():
    rng = np.random.default_rng(2)
    live = np.arange(4)[:, None] < np.array([4, 1, 3])
    emit, label = np.where(live, rng.normal(size=live.shape), 0), np.where(live, rng.integers(0, 2, live.shape), 0)
    pairs, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    value, g_emit, g_pairs, g_start = line_crf.likelihood(emit, live, pairs, start, label)
    # the likelihood by all labellings
    total = 0.0
    for d in range(3):
        n = int(live[:, d].sum())
        score = {way: start[way[0]] + sum(emit[t, d] * way[t] for t in range(n)) + sum(pairs[a, b] for a, b in itertools.pairwise(way)) for way in itertools.product((0, 1), repeat=n)}
        total += score[tuple(label[:n, d])] - np.log(sum(np.exp(s) for s in score.values()))
    assert value == pytest.approx(total / 3)
    step = 1e-6
    for array, got in ((emit, g_emit), (pairs, g_pairs), (start, g_start)):
        for at in np.ndindex(array.shape):
            if array is emit and not live[at]:
                continue
            array[at] += step
            up = line_crf.likelihood(emit, live, pairs, start, label)[0]
            array[at] -= 2 * step
            down = line_crf.likelihood(emit, live, pairs, start, label)[0]
            array[at] += step
            assert got[at] == pytest.approx((up - down) / (2 * step), abs=1e-5)


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(7)
    sizes = [0, 1, 6, 3, 0, 5]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(size=bounds[-1])
    model = line_crf.Model(np.zeros(1), rng.normal(size=(2, 2)), rng.normal(size=2))
    found = line_crf.viterbi(scores, bounds, model)
    for d, n in enumerate(sizes):
        if n:
            s = scores[bounds[d] : bounds[d + 1]]
            best = max(itertools.product((0, 1), repeat=n), key=lambda w: model.start[w[0]] + sum(s[t] * w[t] for t in range(n)) + sum(model.pairs[a, b] for a, b in itertools.pairwise(w)))
            assert tuple(found[bounds[d] : bounds[d + 1]]) == best
    assert line_crf.viterbi(np.zeros(2), np.array([0, 2]), line_crf.Model(np.zeros(1), np.zeros((2, 2)), np.zeros(2))).tolist() == [line_crf.CONTENT] * 2


def test_lines_of_unseen_documents(spark):
    docs, labels = (pd.read_parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    d = docs.merge(labels, on="doc_id").dropna(subset="text")
    fit, held = d[d.doc_id % 2 == 0], d[d.doc_id % 2 == 1]
    model = line_crf.fit(spark.createDataFrame(fit[["doc_id", "text"]]), spark.createDataFrame(fit[["doc_id", "quality"]]))
    out = line_crf.judged(pa.array(held.text.tolist(), pa.string()), model)
    asked = ~out["base_failed"]
    assert (out["kept"] == (held.quality == 1))[asked].mean() > 0.97
    mixed = "A clean line of words that anyone might have written here.\n" + "\n".join(held[held.quality == 0].text.head(1)) + "\n"
    assert line_crf.judged(pa.array([mixed], pa.string()), model)["n_lines"][0] >= 1
    unrated = line_crf.fit(spark.createDataFrame(fit[["doc_id", "text"]]), spark.createDataFrame(fit[["doc_id", "quality"]]).filter("false"))
    assert (line_crf.judged(pa.array(["b " * 9 + "c " * 30]), unrated)["n_content_lines"] == 1).all()


def test_notices_are_boilerplate_on_demand():
    texts = [f"All rights reserved.\nText number {k} goes on about a thing {k * 7} and then some more of it." for k in range(30)]
    model = line_crf.train(texts, [1] * 30, shared=10)
    x = line_crf.read(pa.array(texts[:1]))
    assert line_crf.viterbi(model.scores(x), x.bounds, model).tolist() == [line_crf.BOILERPLATE, line_crf.CONTENT]
