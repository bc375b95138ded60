"""Document fingerprints: threshold-scaled sketches, with DataFrame functions only.

A text's shingles are its runs of five words (a shorter text's whole sequence; none without words), A-Z as a-z. A
shingle is retained if its hash, the first 16 hex digits of its md5, is below a fixed fraction of all values. The
fraction is the same for every text, so sketches of parts can be merged (the union of their hashes) and a small
text's sketch compared with a huge one's: shared hashes over own hashes estimate containment, over the union the
Jaccard likeness.

A fingerprint is the number of distinct shingles, a colon, and the retained hashes in ascending order with commas.
Equal texts have equal fingerprints. Likeness of two texts whose sketches are both empty is 1 if both have no
shingles and 0 if one has; if both have some but none was retained, it is 0 unless the fingerprints' texts are equal.

`chained` compares each document with the one behind it in descending doc_id without a global sort on one task:
documents are dealt out by ranges of doc_id, and each range also gets the first row of the range behind it. An id that
very many rows share fills several ranges, by the texts' md5.

Defined results: a null text is empty; repeated doc_ids follow each other in the order of their texts' md5 and then of
the texts; a null doc_id comes last; a single document is its own next one; an empty table gives an empty one; only the id and the text of docs
are read, so that other columns do not matter; texts of any length are read whole, in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.llm.store import n_partitions

WORDS = 5
#: Retained part of all hashes, in 1/16: a hash is retained if its first hex digit is below this.
SIXTEENTHS = 4
DIGITS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SPACE), "")


def shingle_hashes(text: Column, n: int = WORDS) -> Column:
    """Distinct hashes of a text's shingles, ascending."""

    def at(w: Column, i: Column) -> Column:
        return F.substring(F.md5(F.array_join(F.slice(w, i, n), " ")), 1, DIGITS)

    def of(w: Column) -> Column:
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))), lambda i: at(w, i)))

    return F.transform(F.array(words(text)), of)[0]


def fingerprint(text: Column, n: int = WORDS, sixteenths: int = SIXTEENTHS) -> Column:
    below = f"{sixteenths:x}"

    def keep(all_: Column) -> Column:
        return F.concat(F.size(all_).cast("string"), F.lit(":"), F.array_join(F.array_sort(F.filter(all_, lambda h: h < below)), ","))

    return F.transform(F.array(F.array_distinct(shingle_hashes(text, n))), keep)[0]


def hashes(fp: Column) -> Column:
    """The retained hashes of a fingerprint."""
    body = F.substring_index(fp, ":", -1)
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, ","))


def n_shingles(fp: Column) -> Column:
    return F.substring_index(fp, ":", 1).cast("long")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of the texts of two fingerprints, 0 to 1."""
    x, y = hashes(a), hashes(b)
    both, either = F.size(F.array_intersect(x, y)), F.size(x) + F.size(y)
    return F.when(a == b, 1.0).when(either == 0, 0.0).otherwise(both / (either - both))


def containment(a: Column, b: Column) -> Column:
    """Estimated part of a's shingles that b has; null where a's sketch is empty."""
    x, y = hashes(a), hashes(b)
    return F.size(F.array_intersect(x, y)) / F.nullif(F.size(x), F.lit(0))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two parts together (without a count of shingles, which parts may share)."""
    return F.concat(F.lit(":"), F.array_join(F.array_sort(F.array_union(hashes(a), hashes(b))), ","))


#: What a null doc_id counts as in the order of ids.
NONE = -(2**63)


def edges(docs: DataFrame, n: int) -> list[int]:
    """Ids that part the documents into ranges of like size; an id is there as often as it would fill ranges by itself."""
    at = ", ".join(f"{k / n:.6f}d" for k in range(1, n))
    found = docs.agg(F.expr(f"percentile_approx(coalesce(doc_id, {NONE}L), array({at}), {10 * n})")).first()[0] if n > 1 else []
    return sorted(found or [])


def _count(cut: list[int], x: Column, upto: bool) -> Column:
    """How many of the ascending numbers are below x, or not above it: whole blocks by their last number, then within one
    block, so that a row costs twice the square root of their number."""
    m = int(len(cut) ** 0.5) + 1
    count = lambda a: F.size(F.filter(a, (lambda c: c <= x) if upto else (lambda c: c < x)))
    numbers = lambda v: F.array(*[F.lit(c).cast("long") for c in v]) if v else F.array().cast("array<long>")
    return _let_one(count(numbers(cut[m - 1 :: m])), lambda b: b * m + count(F.slice(numbers(cut), b * m + 1, m)))


def _let_one(x: Column, f) -> Column:
    return F.transform(F.array(x), f)[0]


def chained(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, Window]:
    """doc_id, text and next_text, that of the next document in descending doc_id; after the last comes the first.

    Also has each range's number, and as a guest the first row of the range behind it; the window is the order of all
    rows of a range, so that other columns can be taken from the next document too before guests are left out."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("_tie", F.md5("text"))
    cut = edges(docs, n_partitions(docs.sparkSession))
    # ranges in descending order of ids; one id's rows in ascending order of the tie over all ranges that it fills
    last, key = len(cut), F.coalesce("doc_id", F.lit(NONE))
    part = F.conv(F.substring("_tie", 1, 8), 16, 10).cast("double") / 2.0**32
    rank = _let_one(F.struct(_count(cut, key, False).alias("low"), _count(cut, key, True).alias("high")), lambda c: F.when(c["low"] == c["high"], c["low"]).otherwise(c["high"] - F.floor(part * (c["high"] - c["low"]))))
    placed = docs.withColumn("_part", (F.lit(last) - rank if cut else F.lit(0)).cast("int"))
    heads = placed.groupBy("_part").agg(F.max("doc_id").alias("top"), F.count("*").alias("n")).collect()  # a row per range
    used = sorted(h["_part"] for h in heads)
    top = {h["_part"]: h["top"] for h in heads}
    before = {b: a for a, b in zip([*used[-1:], *used[:-1]], used, strict=True)}
    rows = placed.sparkSession.createDataFrame([(p, top[p], before[p]) for p in used], "_p int, _top long, _before int")
    first = placed.join(F.broadcast(rows), (F.col("_part") == F.col("_p")) & F.col("doc_id").eqNullSafe(F.col("_top")))
    # one row stands for the first of a range: of equal doc_ids the first text
    first = first.groupBy("_before", "doc_id").agg(F.min(F.struct("_tie", "text")).alias("x")).select("doc_id", "x.text", "x._tie", F.col("_before").alias("_part"), F.lit(True).alias("_guest"))
    all_ = placed.select("doc_id", "text", "_tie", "_part", F.lit(False).alias("_guest")).unionByName(first).repartitionById(last + 1, F.col("_part"))
    order = Window.partitionBy("_part").orderBy("_guest", F.desc_nulls_last("doc_id"), "_tie", "text")
    return all_.withColumn("next_text", F.lead("text").over(order)).select("doc_id", "text", "_tie", "next_text", "_part", "_guest"), order


def op5_sketch(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    return edited(table(spark, sf_dir, "documents"))


def edited(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and likeness to it and to the next document."""
    found, order = chained(docs)
    n = F.length("text")
    swap = F.floor(n / 3).cast("int")
    new = F.concat(F.col("text").substr(F.lit(1), n - swap), F.coalesce(F.col("next_text"), F.lit("")).substr(F.lit(1), swap))
    made = found.select(
        "doc_id", "text", "_tie", "_part", "_guest", n.cast("long").alias("n_chars"), F.sha2(new, 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("fingerprint"), F.when(~F.col("_guest"), fingerprint(new)).alias("edited_fingerprint"),
    )
    both = made.withColumn("_next", F.lead("fingerprint").over(order)).filter("NOT _guest")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )


def _sql() -> str:
    """Words as rows, shingles by windows over them, sketches by groups: no list is read more than once."""
    below = f"{SIXTEENTHS:x}"
    split = f"list_filter(regexp_split_to_array(translate(x, '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
    run = ", ".join(["w", *[f"lead(w, {k}) OVER q" for k in range(1, WORDS)]])
    near = lambda same, a, b, both: f"CASE WHEN {same} THEN 1.0::DOUBLE WHEN {a} + {b} = 0 THEN 0.0::DOUBLE ELSE {both}::DOUBLE / ({a} + {b} - {both}) END"
    return f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST, md5(coalesce(text, '')), coalesce(text, '')) AS r, doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT d.r, e.r AS r2, d.doc_id, d.text, length(d.text) AS n, e.text AS nxt FROM d JOIN d AS e ON e.r = CASE WHEN d.r = (SELECT max(r) FROM d) THEN 1 ELSE d.r + 1 END),
e AS MATERIALIZED (SELECT r, r2, doc_id, n, text, substr(text, 1, n - n // 3) || substr(nxt, 1, n // 3) AS edit FROM n),
t AS (SELECT r, 0 AS k, text AS x FROM e UNION ALL SELECT r, 1, edit FROM e),
l AS MATERIALIZED (SELECT r, k, {split} AS ws FROM t),
w AS (SELECT r, k, len(ws) AS m, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM l),
g AS (SELECT r, k, m, i, concat_ws(' ', {run}) AS s FROM w WINDOW q AS (PARTITION BY r, k ORDER BY i)),
h AS MATERIALIZED (SELECT DISTINCT r, k, md5(s)[1:{DIGITS}] AS h FROM g WHERE i <= greatest(m - {WORDS - 1}, 1)),
f AS MATERIALIZED (SELECT r, k, count(*) || ':' || coalesce(string_agg(h, ',' ORDER BY h) FILTER (h < '{below}'), '') AS fp, count(*) FILTER (h < '{below}') AS c FROM h GROUP BY r, k),
p AS (SELECT e.r, coalesce(a.fp, '0:') AS fa, coalesce(b.fp, '0:') AS fb, coalesce(g.fp, '0:') AS fg, coalesce(a.c, 0) AS ca, coalesce(b.c, 0) AS cb, coalesce(g.c, 0) AS cg
      FROM e LEFT JOIN f a ON a.r = e.r AND a.k = 0 LEFT JOIN f b ON b.r = e.r AND b.k = 1 LEFT JOIN f g ON g.r = e.r2 AND g.k = 0),
s AS (SELECT * FROM h WHERE h < '{below}'),
x AS (SELECT a.r, count(*) AS n FROM s a JOIN s b ON b.r = a.r AND a.k = 0 AND b.k = 1 AND a.h = b.h GROUP BY a.r),
y AS (SELECT e.r, count(*) AS n FROM e JOIN s a ON a.r = e.r AND a.k = 0 JOIN s b ON b.r = e.r2 AND b.k = 0 AND a.h = b.h GROUP BY e.r)
SELECT e.doc_id, CAST(e.n AS BIGINT) AS n_chars, sha256(e.edit) AS edited_sha256, fa AS fingerprint, fb AS edited_fingerprint,
       {near("fa = fb", "ca", "cb", "coalesce(x.n, 0)")} AS near_edited, {near("fa = fg", "ca", "cg", "coalesce(y.n, 0)")} AS near_next
FROM e JOIN p ON p.r = e.r LEFT JOIN x ON x.r = e.r LEFT JOIN y ON y.r = e.r
"""


OP5_SQL = _sql()
