"""Bounded, reproducible samples of labelled rows to fit classifiers on.

A text is in the sample if the hash of its id is below a fraction of all hashes; the fraction is chosen so that about
`size` rows of a label are. Equal texts of one label are one row. Bounds, all parameters of a fit: `size` rows of a
label (SPARE times as many at most, whatever the hashes do), and texts of at most `longest` bytes; longer ones are not
learned from (they are scored as all others). All labels count; `kinds`, if it is given, leaves those beyond so many most
frequent ones out, for columns that hold something else than a few labels. The driver holds at most SPARE * size texts of
each label. What is not in the sample changes nothing but the fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONGEST, SPARE = 200_000, 2
PARTS = 1 << 20


def drawn(rows: DataFrame, label: str, size: int | dict, seed: int = 7, kinds: int | None = None) -> tuple[DataFrame, int]:
    """The rows of the sample, about `size` for each label or all there are, and a bound on how many count."""
    counts = rows.filter(F.col(label).isNotNull()).groupBy(label).count()
    counts = (counts if kinds is None else counts.orderBy(F.desc("count"), label).limit(kinds)).collect()
    wanted = {r[0]: size[r[0]] if isinstance(size, dict) else size for r in counts}
    part = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(PARTS).cast("long"))
    keep = F.lit(False)
    for value, n in sorted((r[0], r[1]) for r in counts):
        keep = keep | ((F.col(label) == F.lit(value)) & (part < int(PARTS * min(1.0, wanted[value] / n))))
    return rows.filter(keep), SPARE * sum(wanted.values())


def listed(found: DataFrame, label: str, most: int) -> tuple[list, list]:
    """Texts and labels of distinct rows, at most so many, in an order that the rows alone settle."""
    once = found.select("doc_id", "text", label).groupBy("text", label).agg(F.min("doc_id").alias("doc_id"))
    some = once.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), label).limit(most)
    rows = sorted((tuple(r) for r in some.select("doc_id", "text", label).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], str(r[2])))
    return [r[1] for r in rows], [r[2] for r in rows]


def own(docs: DataFrame, label: str, size: int | dict, longest: int = LONGEST, kinds: int | None = None) -> tuple[list, list]:
    """Texts and labels of a sample of rows that carry their label themselves."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text", label).filter(F.octet_length("text") <= longest)
    found, most = drawn(rows, label, size, kinds=kinds)
    return listed(found, label, most)


def labelled(docs: DataFrame, labels: DataFrame, label: str, size: int | dict, longest: int = LONGEST) -> tuple[list, list]:
    """Texts and labels of a sample of the documents that a table of labels (doc_id, label) names; every text of an id
    has its labels."""
    some, most = drawn(labels.filter(F.col("doc_id").isNotNull()).select("doc_id", label).distinct(), label, size)
    spark = docs.sparkSession
    ids = spark.createDataFrame([tuple(r) for r in some.limit(most).collect()], some.schema)
    rows = docs.select("doc_id", "text").filter(F.octet_length("text") <= longest)
    return listed(rows.join(F.broadcast(ids), "doc_id"), label, most)

