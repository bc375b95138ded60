"""Clusters of vectors around centroids, in exact integers.

A vector's components become integers floor(scale * x). A round assigns every vector to its nearest centroid (squared
Euclidean distance, ties to the smaller number) and moves each centroid that has vectors to their componentwise
floor(sum / count).

Distances are |x|^2 - 2 x.c + |c|^2 with one matrix product a block, in float64. All terms are integers, so that the
product is exact in whatever order BLAS adds, as long as no partial sum can reach 2^53; each block's own magnitudes
prove that, and a block that fails the bound is done in int64, or in Python's integers where that could overflow too.
Assignments and sums hence do not depend on blocks, partitions or the library.

A round is one pass: each task adds its vectors up to one small row (centroids x components), and rows meet by
treeAggregate, so that no task and no driver holds more than a few of them. Vectors stay where they are: there is no
shuffle. Accepted vectors are written once, which cuts lineage and lets twelve passes read what one filter left.

Defined results: a vector that is null, has another number of components, or a null, NaN or infinite one is left out;
equal vectors have equal results, also under one vec_id; a null vec_id counts as empty text in the draw; with fewer
vectors than centroids there are as few centroids; an empty table gives an empty result; a squared distance or an
inertia over a long's range is null. Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.llm.store import keep, quoted, scratch

SIZE, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Vectors in one product; with eight centroids a block is some 2 MB of float64.
BLOCK = 4096
#: Integers of float64 and int64 are exact below these.
FLOAT, INT = 1 << 53, 1 << 63


def accepted(df: DataFrame, vec_id: str, vector: str, size: int) -> DataFrame:
    """(vec_id, v) of the vectors that count."""
    v = F.col(quoted(vector)).cast("array<double>")
    good = (F.size(v) == size) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(quoted(vec_id)).alias("vec_id"), v.alias("v")).filter(F.coalesce(good, F.lit(False)))


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): float64 where all results are below 2^53, else Python's integers. `scale` is a power of two, so
    that the product is exact."""
    if len(x) and np.abs(x).max() >= FLOAT // scale:
        exact = np.empty(x.shape, object)
        exact.flat = [int(a) * scale if abs(a) >= FLOAT else int(np.floor(a * scale)) for a in x.ravel().tolist()]
        return exact
    return np.floor(x * scale)


def integers(x: np.ndarray) -> np.ndarray:
    """The same as Python's integers; what is float64 is below 2^53."""
    return x if x.dtype == object else x.astype(np.int64).astype(object)


def magnitude(x: np.ndarray) -> int:
    return int(np.abs(x).max()) if x.size else 0


def nearest(x: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Each row's centroid and squared distance; rows of float64 (integers) or Python's integers."""
    c = np.array(centroids, object)
    m, k, n = magnitude(x), magnitude(c), c.shape[1]
    reach = n * (m + k) ** 2  # every partial sum of the three terms, whatever their signs
    kind = np.float64 if x.dtype != object and reach < FLOAT else np.int64 if reach < INT else object
    x, c = (integers(x), c) if kind is object else (x.astype(kind), c.astype(kind))
    d = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(x)), at]


def blocks(batch: pa.RecordBatch, size: int, scale: int, block: int = BLOCK) -> Iterator[np.ndarray]:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    for i in range(0, len(flat), block):
        yield whole(flat[i : i + block], scale)


@dataclass
class Sums:
    """Vectors per centroid and their componentwise sums, as Python's integers."""

    counts: np.ndarray
    sums: np.ndarray

    @staticmethod
    def none(k: int, size: int) -> Sums:
        return Sums(np.zeros(k, object), np.zeros((k, size), object))

    def add(self, x: np.ndarray, at: np.ndarray) -> None:
        exact = x.dtype != object and len(x) * magnitude(x) < FLOAT
        for j in np.unique(at).tolist():
            mine = x[at == j]
            self.counts[j] += len(mine)
            self.sums[j] += np.array([int(s) for s in (mine if exact else integers(mine)).sum(axis=0).tolist()], object)

    def plus(self, other: Sums) -> Sums:
        return Sums(self.counts + other.counts, self.sums + other.sums)


def _pack(s: Sums) -> bytes:
    return ";".join(",".join(map(str, [n, *row])) for n, row in zip(s.counts.tolist(), s.sums.tolist(), strict=True)).encode()


def _unpack(data: bytes) -> Sums:
    rows = [[int(x) for x in row.split(",")] for row in data.decode().split(";")]
    return Sums(np.array([r[0] for r in rows], object), np.array([r[1:] for r in rows], object))


def moved(vectors: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """The centroids after one round over all vectors."""
    k, size = len(centroids), len(centroids[0])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums.none(k, size)
        for batch in batches:
            for x in blocks(batch, size, scale):
                sums.add(x, nearest(x, centroids)[0])
        yield pa.RecordBatch.from_arrays([pa.array([_pack(sums)], pa.binary())], names=["sums"])

    rows = vectors.select("v").mapInArrow(partial, "sums binary").rdd
    total = rows.treeAggregate(Sums.none(k, size), lambda s, row: s.plus(_unpack(bytes(row[0]))), Sums.plus)
    return [[int(s) // int(n) for s in sums] if n else c for c, n, sums in zip(centroids, total.counts, total.sums, strict=True)]


def cluster(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int = SIZE, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that counts.

    The first centroids are the vectors with the smallest sha256 of `seed:vec_id`."""
    if scale & (scale - 1):
        raise ValueError("scale must be a power of two")
    with scratch(df.sparkSession):
        vectors = keep(accepted(df, vec_id, vector, size), "vectors")
        drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
        first = vectors.orderBy(drawn, "v").limit(clusters).collect()
        if not first:
            none = "vec_id {}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
            return df.sparkSession.createDataFrame([], none.format(dict(vectors.dtypes)["vec_id"]))
        centroids = [[int(x) for x in whole(np.array([r["v"]]), scale)[0].tolist()] for r in first]
        for _ in range(rounds):
            after = moved(vectors, centroids, scale)
            if after == centroids:  # nothing moves any more, nor would it in further rounds
                break
            centroids = after

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = [nearest(x, centroids) for x in blocks(batch, size, scale)]
                if got:
                    d = [int(v) if v < INT else None for _, part in got for v in part.tolist()]
                    at = np.concatenate([a for a, _ in got])
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(at, pa.int32()), pa.array(d, pa.int64())], names=["vec_id", "cluster", "distance"])

        near = vectors.mapInArrow(assign, f"vec_id {dict(vectors.dtypes)['vec_id']}, cluster int, distance bigint")
        near = keep(near.select("vec_id", "cluster", "distance"), "assigned", result=True)
    known = F.count("distance") == F.count(F.lit(1))
    part = near.groupBy("cluster").agg(F.when(known, F.sum(F.col("distance").cast("decimal(38, 0)"))).alias("s")).collect()  # a row a centroid
    each = {r["cluster"]: None if r["s"] is None else int(r["s"]) for r in part}
    total = None if None in each.values() else sum(each.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    fits = lambda n: n if n is not None and n < INT else None
    facts = df.sparkSession.createDataFrame([(j, fits(n), fits(total), digest[j]) for j, n in sorted(each.items())], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    told = near.join(F.broadcast(facts), "cluster")  # at most as many rows as centroids
    return told.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    return cluster(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """Every round as three tables: distances by component, the nearest centroid, floors of means."""
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {SIZE})""",
        "x AS MATERIALIZED (SELECT r, unnest(range(1, len(x) + 1)) AS p, unnest(x) AS x FROM v)",
        f"""c0 AS MATERIALIZED (SELECT j, unnest(range(1, len(x) + 1)) AS p, unnest(x) AS c
  FROM (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS j, x FROM v) WHERE j < {CLUSTERS})""",
    ]
    for k in range(ROUNDS + 1):
        parts.append(f"d{k} AS MATERIALIZED (SELECT r, j, sum((x - c) * (x - c)) AS d FROM x JOIN c{k} USING (p) GROUP BY r, j)")
        parts.append(f"a{k} AS MATERIALIZED (SELECT r, j, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)")
        if k < ROUNDS:
            mean = "(s - ((s % n) + n) % n) // n"
            parts.append(f"m{k} AS MATERIALIZED (SELECT j, p, {mean} AS m FROM (SELECT j, p, sum(x)::HUGEINT AS s, count(*) AS n FROM a{k} JOIN x USING (r) GROUP BY j, p))")
            parts.append(f"c{k + 1} AS MATERIALIZED (SELECT j, p, coalesce(m, c)::BIGINT AS c FROM c{k} LEFT JOIN m{k} USING (j, p))")
    last = f"""SELECT vec_id, j::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (r) JOIN (SELECT j, sha256(string_agg(c::VARCHAR, ',' ORDER BY p)) AS h FROM c{ROUNDS} GROUP BY j) USING (j)"""
    return "WITH " + ",\n".join(parts) + "\n" + last


OP12_SQL = _sql()
