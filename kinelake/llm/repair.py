"""Conversation structure repair: the cheapest edits that give a conversation's turns the order `(s?(ua)+)?` of roles.

Rows are taken by turn (nulls first), then role and text. A row's first fault counts: blank, duplicate (role and text
seen earlier), truncated. Edits are Keep (0), Rerole to user or assistant (2), Delete (3; required where a row is blank
or duplicate) and Insert of a turn with empty text before any row or at the end (2); a truncated row that stays adds 1.
Of the cheapest edits those win whose initials are least as text.

The search is A* on the lattice of (rows done, role that came last). Its heuristic is what rows ahead cost in any case:
suffix sums of 3 for each deletion that is required and 1 for each truncated row. It never falls by more than an edit
costs, so that the first way out of a node is the best; nodes leave the queue by (cost + heuristic, edits so far).

Long conversations are cut into chunks of rows. Inserts stand before the row that they precede, so that the edits of a
chunk are one word `I*[DKR]` a row and no two different ways through a chunk are beginnings of each other: a chunk is
told in full by the cost, and the rank among ways of equal cost, of the best way from each role before it to each role
after it. Ways through many chunks are found by the same search over these facts, chunks of chunks in as many levels
as it takes; then each chunk is searched once more between the roles that were settled for its ends. No task has more
rows than a chunk for a search.

Rows that are equal in all columns are counted before anything else (all but the first are deleted), and duplicates are
found by the first turn of each text of a conversation, so that repeats of one message do not meet in a task. The digest
of a repaired conversation is a chain over its text: rows of a conversation pass through one task in order, a batch at a
time, and the digest's state is all that is held, beside the edits that are returned.

Defined results: a null role or text is one space, and so is a null id or turn in the draw of damage; a null conv_id is a
conversation; a conversation without rows after damage has zeros, an empty audit and the digest of empty text; a role
is known by its first letter; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.llm.store import keep, n_partitions, quoted, scratch

#: Rows of a chunk, and chunks of a chunk of chunks.
CHUNK, FAN = 256, 256
RATE = 20
#: What came last: nothing, system, user, assistant.
STATES = START, SYSTEM, USER, ASSISTANT = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What a conversation's end adds after each role.
ENDS = ("", "II", "I", "")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


# ---------------------------------------------------------------- search


def astar(n: int, entry: int, goal: Callable[[int], bool], edges: Callable[[int, int], Iterator], ahead: list[int]) -> tuple[int, str, list[int]] | None:
    """Cost, labels and states after each step of the best way from `entry` before step 0 to a goal after n steps.

    `edges` gives (label, cost, steps done, state) and `ahead` what the steps from each on cost at least."""
    queue, done = [(ahead[0], "", 0, entry, 0, None)], set()
    while queue:
        _, labels, i, state, cost, came = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == n and goal(state):
            states = [state]
            while came:
                states.append(came[0])
                came = came[1]
            return cost, labels, states[::-1]
        here = (state, came)
        for label, price, j, to in edges(i, state):
            if (j, to) not in done:
                heapq.heappush(queue, (cost + price + ahead[j], labels + label, j, to, cost + price, here))
    return None


def suffix_sums(costs: list[int]) -> list[int]:
    out = [0] * (len(costs) + 1)
    for i in range(len(costs) - 1, -1, -1):
        out[i] = out[i + 1] + costs[i]
    return out


def follows(state: int) -> int:
    """The role that may come after another: user and assistant by turns."""
    return ASSISTANT if state == USER else USER


def repair(initials: str, faults: str, entry: int = START, exit_: int | None = None) -> tuple[int, str] | None:
    """Cost and edits of rows given by their roles' initials and faults (k: none, t: truncated, x: must go).

    Without `exit_` these rows end their conversation; else inserts after the last row are the next chunk's."""
    n = len(initials)
    at_end = exit_ is None

    def edges(i: int, state: int) -> Iterator:
        to = follows(state)
        if i < n or at_end:
            yield "I", INSERT, i, to
        if i == n:
            return
        yield "D", DELETE, i + 1, state
        if faults[i] == "x":
            return
        more = TRUNCATED if faults[i] == "t" else 0
        yield "R", REROLE + more, i + 1, to
        if initials[i] == "ua"[to == ASSISTANT]:
            yield "K", more, i + 1, to
        elif initials[i] == "s" and state == START:
            yield "K", more, i + 1, SYSTEM

    ahead = suffix_sums([{"x": DELETE, "t": TRUNCATED, "k": 0}[f] for f in faults])
    found = astar(n, entry, (lambda s: s in (START, ASSISTANT)) if at_end else exit_.__eq__, edges, ahead)
    return found and found[:2]


def ranked(ways: dict[tuple[int, int], tuple[int, str]]) -> tuple[list, list]:
    """Costs and ranks (by edits, among ways from one role) of ways by (entry, exit), in order of both; null: no way."""
    cost, rank = [None] * 16, [None] * 16
    for e in STATES:
        for k, (_, t) in enumerate(sorted((way[1], t) for (x, t), way in ways.items() if x == e)):
            cost[4 * e + t], rank[4 * e + t] = ways[e, t][0], k
    return cost, rank


def summary(initials: str, faults: str) -> tuple[list, list]:
    # nothing leads back to no role or to system
    ways = {(e, t): repair(initials, faults, e, t) for e in STATES for t in STATES if t >= min(e, USER)}
    return ranked({k: way for k, way in ways.items() if way})


def through(parts: list[dict], entry: int, exit_: int) -> tuple[int, str, list[int]] | None:
    """Cost, ranks and states of the best way through chunks, each a {cost, rank}."""

    def edges(i: int, state: int) -> Iterator:
        if i < len(parts):
            for t in STATES:
                price = parts[i]["cost"][4 * state + t]
                if price is not None:
                    yield str(parts[i]["rank"][4 * state + t]), price, i + 1, t

    ahead = suffix_sums([min(c for c in p["cost"] if c is not None) for p in parts])
    return astar(len(parts), entry, exit_.__eq__, edges, ahead)


def composed(parts: list[dict]) -> tuple[list, list]:
    ways = {(e, t): through(parts, e, t) for e in STATES for t in STATES}
    return ranked({k: way[:2] for k, way in ways.items() if way})


def ending(part: dict) -> tuple[int, int]:
    """Cost of a whole conversation, and the role that it has before what its end adds."""
    ways = [(part["cost"][t] + INSERT * len(ENDS[t]), part["rank"][t], t) for t in STATES if part["cost"][t] is not None]
    cost, _, t = min(ways)
    return cost, t


# ---------------------------------------------------------------- rows


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults planted by crc32 of `conv_id:turn`: dropped, emptied, without stops, twice, or by the user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % RATE
    out = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), draw.alias("_draw")).filter("_draw <> 0")
    emptied = F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("_draw") == 3, 2).otherwise(1).cast("long")
    return out.select("conv_id", "turn", F.when(F.col("_draw") == 4, "user").otherwise(F.col("role")).alias("role"), emptied.alias("text"), times.alias("times"))


def _key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def _ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows in order, written once: `_at` grows with (key, turn, role, text), in ranges of any size."""
    one = rows.groupBy(_key(F.col("conv_id")).alias("key"), "turn", "role", "text").agg(F.sum("times").alias("n"))
    inner = F.btrim("text", F.lit(_SPACE))
    blank = inner == ""
    flagged = one.select(
        "key", "turn", "role", "text", "n", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"), blank.alias("blank"),
        (~blank & ~F.substring(inner, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    by = ["key", "turn", "role", "text"]
    dealt = flagged.repartitionByRange(n_partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    return keep(dealt.withColumn("_at", F.monotonically_increasing_id()), "rows")


def _chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """(key, c, at, initials, faults, facts) of every chunk of distinct rows, numbered from 0."""
    place = rows.withColumn("_range", F.shiftright("_at", 33))
    part = place.groupBy("key", "_range").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_rows"))
    # a conversation has as many ranges as it fills, so that this window is over few rows
    told = part.select("key", "_range", "_low", F.expr("sum(_rows) OVER (PARTITION BY key ORDER BY _range) - _rows AS _before"))
    turn = F.struct(F.col("turn").isNotNull(), "turn")  # nulls come first
    again = rows.groupBy("key", "digest").agg(F.min(turn).alias("_first"), F.count(F.lit(1)).alias("_times")).filter("_times > 1").drop("_times")
    small = place.join(told, ["key", "_range"]).join(again, ["key", "digest"], "left")
    later = F.coalesce(turn > F.col("_first"), F.lit(False))
    initial = F.substring("role", 1, 1)
    coded = small.select(
        "key", "_at", "n", ((F.col("_at") - F.col("_low") + F.col("_before")) / chunk).cast("long").alias("c"), F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("i"),
        F.when(F.col("blank"), "b").when(later, "d").when(F.col("truncated"), "t").otherwise("k").alias("f"),
    )
    of = lambda f: F.when(F.col("f") == f, F.col("n")).otherwise(0)
    counts = [
        F.sum(of("b")).alias("blank"),
        F.sum(F.when(F.col("f") == "b", 0).when(F.col("f") == "d", F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.sum((F.col("f") == "t").cast("long")).alias("truncated"),
        F.sum(F.col("n") - 1).alias("copies"),
    ]
    listed = F.sort_array(F.collect_list(F.struct("_at", "i", "f")))
    out = coded.groupBy("key", "c").agg(F.min("_at").alias("at"), listed.alias("l"), *counts)
    initials, faults = F.array_join("l.i", ""), F.translate(F.array_join("l.f", ""), "bd", "xx")
    pairs = F.transform(F.sequence(F.lit(1), F.length("initials") - 1), lambda k: F.substring("initials", k, F.lit(2)))
    bad = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))
    out = out.withColumns({"initials": initials, "faults": faults}).withColumn("illegal", F.col("copies") + F.when(F.length("initials") > 1, bad).otherwise(0))
    return keep(out.drop("l"), "chunks")


def _told(what: Callable, schema: str) -> Callable:
    """An Arrow function of one struct column by a plain function of one dict."""
    kind = _arrow(schema)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([what(row) for row in batch.to_pylist()], kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, schema)


def _arrow(schema: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType

    return to_arrow_type(DataType.fromDDL(schema))


_FACTS = "struct<cost: array<bigint>, rank: array<bigint>>"
_ENDS = "array<struct<entry: bigint, exit: bigint>>"


def _pair(found: tuple[list, list]) -> dict:
    return {"cost": found[0], "rank": found[1]}


def _whole(row: dict) -> dict:
    cost, audit = repair(row["initials"], row["faults"])
    return {"cost": cost, "audit": audit}


def _between(row: dict) -> list[dict]:
    """Roles at both ends of each chunk of a group of chunks."""
    states = through(row["parts"], row["entry"], row["exit"])[2]
    return [{"entry": a, "exit": b} for a, b in zip(states, states[1:])]


def _edits(chunks: DataFrame, fan: int) -> DataFrame:
    """(key, c, at, cost, audit) of every chunk; cost is a whole conversation's, at its first chunk alone."""
    many = chunks.groupBy("key").agg(F.max("c").alias("_last")).filter("_last > 0")
    many = keep(many, "many")
    short = chunks.join(many, "key", "left_anti").withColumn("e", _told(_whole, "struct<cost: bigint, audit: string>")(F.struct("initials", "faults")))
    out = short.select("key", "c", "at", F.col("e.cost").alias("cost"), F.col("e.audit").alias("audit"))
    if not many.take(1):
        return out
    long = chunks.join(many, "key")
    facts = long.select("key", "c", _told(lambda r: _pair(summary(r["initials"], r["faults"])), _FACTS)(F.struct("initials", "faults")).alias("p"))
    levels = [keep(facts, "facts")]
    groups = []
    while levels[-1].filter("c > 0").take(1):
        by = levels[-1].groupBy("key", F.floor(F.col("c") / fan).alias("c")).agg(F.sort_array(F.collect_list(F.struct("c", "p.cost", "p.rank"))).alias("parts"))
        groups.append(keep(by, "groups"))
        levels.append(keep(groups[-1].select("key", "c", _told(lambda r: _pair(composed(r["parts"])), _FACTS)(F.struct("parts")).alias("p")), "facts"))
    end = _told(lambda r: dict(zip(("cost", "exit"), ending(r["p"]))), "struct<cost: bigint, exit: bigint>")
    top = keep(levels[-1].select("key", "c", end(F.struct("p")).alias("e")), "ends")
    ends = top.select("key", "c", F.lit(START).cast("long").alias("entry"), F.col("e.exit").alias("exit"))
    for by in reversed(groups):
        inner = by.join(ends, ["key", "c"]).select("key", "c", _told(_between, _ENDS)(F.struct("parts", "entry", "exit")).alias("ends"))
        ends = keep(inner.select("key", F.col("c"), F.posexplode("ends")).select("key", (F.col("c") * fan + F.col("pos")).alias("c"), "col.entry", "col.exit"), "ends")
    audit = _told(lambda r: repair(r["initials"], r["faults"], r["entry"], r["exit"])[1], "string")
    told = long.join(ends, ["key", "c"]).select("key", "c", "at", "_last", "exit", audit(F.struct("initials", "faults", "entry", "exit")).alias("audit"))
    told = told.join(top.select("key", F.col("e.cost").alias("cost")), "key")
    closing = F.when(F.col("c") == F.col("_last"), F.element_at(F.array(*map(F.lit, ENDS)), F.col("exit").cast("int") + 1)).otherwise("")
    return out.unionByName(told.select("key", "c", "at", F.when(F.col("c") == 0, F.col("cost")).alias("cost"), F.concat("audit", closing).alias("audit")))


_WORD = re.compile("I*[DKR]|I+$")


class _Conversation:
    """The edits and the digest of one conversation as its rows go by."""

    def __init__(self, key: str):
        self.key, self.audit, self.digest, self.any, self.state, self.words, self.at = key, [], hashlib.sha256(), False, START, [], 0

    def _put(self, role: str, text: str, state: int) -> None:
        self.digest.update((("\n" if self.any else "") + f"{role}:{text}").encode())
        self.any, self.state = True, state

    def _next(self, text: str) -> None:
        to = follows(self.state)
        self._put("user" if to == USER else "assistant", text, to)

    def chunk(self, audit: str) -> None:
        self.words, self.at = _WORD.findall(audit), 0

    def row(self, role: str, text: str, n: int) -> None:
        word = self.words[self.at]
        self.at += 1
        for _ in range(len(word) - 1):
            self._next("")
        if word[-1] == "K":
            self._put(role, text, {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]])
        elif word[-1] == "R":
            self._next(text)
        self.audit.append(word + "D" * (n - 1))
        if self.at == len(self.words) - 1 and self.words[-1][-1] == "I":  # inserts at the end
            for _ in self.words[-1]:
                self._next("")
            self.audit.append(self.words[-1])

    def told(self) -> tuple[str, str, str]:
        return self.key, "".join(self.audit), self.digest.hexdigest()


def _repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(key, audit, repaired_sha256): rows of a conversation and the edits of its chunks pass by in order."""
    marks = edits.select("key", F.col("at").alias("_at"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("n"))
    both = rows.select("key", "_at", F.lit(1).alias("kind"), "role", "text", "n").unionByName(marks)
    dealt = both.repartition(n_partitions(rows.sparkSession), "key").sortWithinPartitions("key", "_at", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def out(done: list) -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in columns], names=["key", "audit", "repaired_sha256"])

        for batch in batches:
            done = []
            for key, kind, role, text, n in zip(*(batch.column(c).to_pylist() for c in ("key", "kind", "role", "text", "n")), strict=True):
                if now is None or now.key != key:
                    if now:
                        done.append(now.told())
                    now = _Conversation(key)
                if kind == 0:
                    now.chunk(text)
                else:
                    now.row(role, text, n)
            yield out(done)
        if now:
            yield out([now.told()])

    return dealt.mapInArrow(run, "key string, audit string, repaired_sha256 string")


def repaired(rows: DataFrame, whole: DataFrame | None = None, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """A row for each conv_id of `whole` (by default rows): gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. `rows` has conv_id, turn, role, text (none null) and times, how often each row stands there."""
    whole = rows if whole is None else whole
    ids = whole.groupBy(_key(F.col("conv_id")).alias("key")).agg(F.first("conv_id").alias("conv_id"))
    with scratch(whole.sparkSession):
        ordered = _ordered(rows)
        chunks = _chunks(ordered, chunk)
        edits = keep(_edits(chunks, fan), "edits")
        digests = _repaired(ordered, edits)
        spans = ordered.groupBy("key").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"))
        border = chunks.select("key", F.col("c") + 1, F.substring("initials", -1, 1)).toDF("key", "c", "before")
        crossing = (F.col("before").isNotNull() & ~F.concat("before", F.substring("initials", 1, 1)).isin("su", "ua", "au")).cast("long")
        met = chunks.join(border, ["key", "c"], "left").withColumn("illegal", F.col("illegal") + F.coalesce(crossing, F.lit(0)))
        sums = met.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "copies")])
        costs = edits.filter("cost IS NOT NULL").select("key", F.col("cost").alias("first_cost"))
        out = ids.join(spans, "key", "left").join(sums, "key", "left").join(costs, "key", "left").join(digests, "key", "left")
        out = out.withColumn("cost", F.col("first_cost") + DELETE * F.col("copies"))
        zero = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        out = out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
        return keep(out, "repaired", result=True)


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    rows = table(spark, sf_dir, "conversations").select(*[F.col(quoted(c)) for c in ("conv_id", "turn", "role", "text")])
    return repaired(damaged(rows), rows)


def _sql() -> str:
    """crc32 a bit at a time; the best way to each role after each row, as (cost, edits) in one key with its text."""
    bit = "xor(a, b) // 2"
    crc = f"""list_reduce(flatten(list_transform(range(1, length(k) + 1), lambda p: [ascii(substr(k, p, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda a, b: xor({bit}, CASE WHEN xor(a, b) % 2 = 1 THEN 3988292384 ELSE 0 END), 4294967295::BIGINT)"""
    put = lambda w, label, price, line: f"CASE WHEN {w} IS NULL THEN NULL ELSE {{'c': {w}.c + {price}, 'a': {w}.a || '{label}', 't': {w}.t || {line}}} END"
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    # ways before a row, with what may be inserted there; more than two inserts are never best
    i_u = f"least({put('a.n', 'I', 2, user)}, {put('a.s', 'I', 2, user)}, {put('a.a', 'I', 2, user)})"
    w = {"n": "a.n", "s": "a.s", "u": f"least(a.u, {i_u})", "a": f"least(a.a, {put('a.u', 'I', 2, assistant)})"}
    # steps of a row from ways w: (to, label, price, line) by the role before
    line = "chr(10) || b.role || ':' || b.text"
    kept = "(0 + b.trunc)"

    def to(role: str, sources: list[str], word: str, initial: str) -> str:
        ways = []
        for s in sources:
            ways.append(f"CASE WHEN NOT b.must AND b.i = '{initial}' THEN {put(f'w.{s}', 'K', kept, line)} END")
            ways.append(f"CASE WHEN NOT b.must THEN {put(f'w.{s}', 'R', '(2 + b.trunc)', f"chr(10) || '{word}:' || b.text")} END")
        return "least(" + ", ".join([put(f"w.{role}", "D", 3, "''"), *ways]) + ")"

    step = f"""{{'n': {put('w.n', 'D', 3, "''")}, 's': least({put('w.s', 'D', 3, "''")}, CASE WHEN NOT b.must AND b.i = 's' THEN {put('w.n', 'K', kept, line)} END),
    'u': {to('u', ['n', 's', 'a'], 'user', 'u')}, 'a': {to('a', ['u'], 'assistant', 'a')}}}"""
    return f"""WITH RECURSIVE base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
drawn AS (SELECT *, xor({crc}, 4294967295) % 20 AS d FROM base),
rows AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM drawn, (SELECT unnest([1, 2]) AS copy) WHERE d <> 0 AND (copy = 1 OR d = 3)),
flagged AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
  regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS inner_text, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS i FROM rows),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM flagged),
told AS (SELECT *, inner_text = '' AS blank, inner_text <> '' AND nth > 1 AS dup, inner_text <> '' AND nth = 1 AND inner_text[-1] NOT IN ('.', '!', '?') AS trunc,
  lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS pair FROM ranked),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM told GROUP BY conv_id),
nothing AS (SELECT {{'c': 0::BIGINT, 'a': '', 't': ''}} AS o, CASE WHEN false THEN {{'c': 0::BIGINT, 'a': '', 't': ''}} END AS x),
ways AS (SELECT conv_id, 0::BIGINT AS pos, {{'n': o, 's': x, 'u': x, 'a': x}} AS a FROM facts, nothing
  UNION ALL
  SELECT conv_id, pos, {step} FROM (SELECT y.conv_id, b.pos, {{'n': {w['n']}, 's': {w['s']}, 'u': {w['u']}, 'a': {w['a']}}} AS w, {{'i': b.i, 'role': b.role, 'text': b.text, 'trunc': b.trunc::BIGINT, 'must': b.blank OR b.dup}} AS b
    FROM (SELECT conv_id, pos, a FROM ways) y JOIN told b ON b.conv_id IS NOT DISTINCT FROM y.conv_id AND b.pos = y.pos + 1)),
last AS (SELECT f.*, least(a.n, a.a, {put('a.u', 'I', 2, assistant)}, {put('a.s', 'II', 4, f"{user} || {assistant}")}) AS w FROM ways JOIN facts f ON f.conv_id IS NOT DISTINCT FROM ways.conv_id AND f.n = ways.pos)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(w.c, 0)::BIGINT AS cost, coalesce(w.a, '') AS audit, sha256(coalesce(substr(w.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN last l ON l.conv_id IS NOT DISTINCT FROM o.conv_id"""


OP11_SQL = _sql()
