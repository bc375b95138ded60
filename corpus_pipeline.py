"""A corpus pipeline of five stages; each is written as Parquet and reread as the next one's documents.

Rows that a stage is not about pass through: a null text has no near copies and nothing to replace. Rows are documents
even where they share a doc_id; an equal row is a copy. All stages but the last return the columns of documents, others
that a table may have among them; where a stage changes texts, n_chars follows. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.llm import byte_bpe, decontaminate, jaccard_join, lang_id, pii
from kinelake.llm.brown_lm import remainder
from kinelake.llm.store import drop, fresh, keep, new_path, quoted, scratch, table

#: A document goes if it has no letter, or if its best language's mean probability is not this part of the way from an
#: even guess among the languages learned (0) to certainty (1). Of the texts of check_s the lowest two, short ones with
#: foreign words, are at 0.14, those in two languages at 0.2 and above, those in one language above 0.7.
LEAST_MARGIN = 0.1
#: Near copies: word five-grams, likeness of 0.8.
SHINGLE, PERCENT = 5, 80


def _like(df: DataFrame, docs: DataFrame) -> DataFrame:
    n = {"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {}
    return df.withColumns(n).select(*[F.col(quoted(c)) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told; the model learns from those of docs that have a lang."""
    model = lang_id.fit(docs.filter(remainder(4) != 2))
    even = 1 / max(len(model.langs), 1)
    kept = docs.columns
    inner = docs.toDF(*[f"c{k}" for k in range(len(kept))])  # columns called as the outputs stay
    sure = (F.col("lang_pred") != "und") & (F.col("score") >= even + LEAST_MARGIN * (1 - even))
    return lang_id.identify(inner, model, inner.columns[kept.index("text")]).filter(sure).select(*inner.columns).toDF(*kept)


#: Nodes of rows that a doc_id does not name: above all ids, so that a row with an id of its own stays rather than they.
NAMELESS = 1 << 62


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component of near copies the row with the smallest doc_id, once. Rows whose doc_id is null or also
    another row's count as nameless: they stay only where no row with an id of its own does, one for each component."""
    node, shared, id_ = (fresh(n, docs.columns) for n in ("_node", "_shared", "_id"))
    with scratch(spark):
        twice = docs.groupBy(F.col("doc_id").alias(id_)).agg(F.count("*").alias("n")).filter(f"n > 1 OR {id_} IS NULL").select(id_, F.lit(True).alias(shared))
        twice = keep(twice, "twice", result=True)
        named = docs.join(twice, F.col("doc_id").eqNullSafe(F.col(id_)), "left").withColumn(shared, F.coalesce(shared, F.lit(False)))
        rows = named.withColumn(node, F.when(F.col(shared), NAMELESS + F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 3)).otherwise(F.col("doc_id")))
        found = jaccard_join.jaccard_components(rows, SHINGLE, PERCENT, doc_id=node)
        gone = keep(found.filter("component_id <> doc_id").select(F.col("doc_id").alias(node)).distinct(), "gone", result=True)
    left = rows.join(gone, node, "left_anti")
    once = left.filter(~F.col(shared)).unionByName(left.filter(F.col(shared)).dropDuplicates([node]))
    return once.select(*[F.col(quoted(c)) for c in docs.columns])


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every occurrence of a benchmark window out of the texts."""
    inner = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # columns called as the outputs stay
    found = decontaminate.decontaminate(inner, table(spark, sf_dir, "benchmark"), text=inner.columns[docs.columns.index("text")], clean=True)
    return _like(found.select(*inner.columns).toDF(*docs.columns), docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts pseudonyms in the place of personal data."""
    return _like(pii.pseudonymise(docs, pii.KEY, counts=False), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with digests of the ids and of the bytes that they decode to."""
    ranks, pattern = byte_bpe.production()
    columns = [c for c in docs.columns if c != "text"]
    columns = [c for c in columns if c.lower() not in ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")]
    coded = byte_bpe.encode(docs, ranks, pattern, columns=columns, decoded="decoded")
    return coded.select(
        *[F.col(quoted(c)) for c in columns], "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language identification", language),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_free),
    ("personal data", private),
    ("byte-level BPE", tokens),
]

#: Models and permutations under a key are beyond SQL; tests compare what every stage leaves with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; a stage's table goes when the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = new_path(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
            if before:
                drop(spark, before)
            before = path
    return docs
