"""Centroid clustering of integer vectors by PCA-rotated filtering.

Components become integers, and every distance that decides is an exact integer.
To compare a vector with few centroids only, its leading coordinates in the
directions of the data's principal components are stored with the length of what is
left (its residual norm).  For a vector ``x`` and a centroid ``c``

    |x - c|^2  >=  |lead(x) - lead(c)|^2 + (rest(x) - rest(c))^2

as a rotation keeps distances and the rests differ by their lengths at least.  The
centroid with the least bound is measured first; the centroids whose bounds, less a
margin for rounding, do not exceed that distance survive and are measured in
integers.  Of equal distances the smaller number wins, so the rotation decides how
much is measured but never the result.

The principal components come from all vectors (Spark's PCA, a tree aggregation).  A
round reads the stored table once; each task sends one row per centroid with exact
sums, and Spark adds them.  The driver sees the centroids only: ``k`` rows of ``dim``
integers, whatever the input's size.

Defined results: vectors that are null, of another length, or hold null or non-finite
components get no row; with fewer than ``k`` vectors every one is a centroid; rows
that repeat an id are vectors of their own; a null id is no starting centroid and its
vector is clustered like others; other columns are not read; an empty table gives
an empty result.  Integers have to stay below ``2 ** 27`` in size, for which
distances fit a long; a larger one raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.llm.common import cut

#: leading coordinates that are stored
LEAD = 16
#: integers are smaller than this in size
LIMIT = 1 << 27
#: share of the squared lengths that a bound may be off by rounding, a thousand times what it is
MARGIN = 1e-9
#: elements of one array of integer differences
CHUNK = 1 << 22


def to_integers(vectors: DataFrame, key: str, vector: str, dim: int, scale: int) -> DataFrame:
    """``(id, q)`` of the vectors with ``dim`` finite components, as arrays of integers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall("q", lambda x: F.abs(x) < LIMIT)
    found = vectors.where((F.size(vector) == dim) & finite).select(F.col(key).alias("id"), whole.alias("q"))
    q = F.when(fits, F.col("q").cast("array<int>")).otherwise(F.raise_error(F.lit(f"a component's integer reaches {LIMIT}")).cast("array<int>"))
    return found.select("id", q.alias("q"))


def rotation(ints: DataFrame, dim: int) -> np.ndarray:
    """An orthonormal basis whose first columns are the data's principal components."""
    if ints.limit(2).count() < 2:
        return np.eye(dim)
    model = PCA(k=min(LEAD, dim), inputCol="x", outputCol="y").fit(ints.select(array_to_vector(F.col("q").cast("array<double>")).alias("x")))
    return np.linalg.qr(np.nan_to_num(model.pc.toArray()), mode="complete")[0]


def _ints(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dim)


def rotate(q: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and residual norms."""
    x = q.astype(np.float64) @ basis
    return np.ascontiguousarray(x[:, :LEAD]), np.sqrt((x[:, LEAD:] ** 2).sum(axis=1))


def store(ints: DataFrame, basis: np.ndarray) -> DataFrame:
    """``ints`` with leading coordinates and residual norm, written once."""
    dim = len(basis)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                lead, rest = rotate(_ints(batch.column(1), dim), basis)
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(lead) + 1) * lead.shape[1], pa.int32()), pa.array(lead.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, listed, pa.array(rest)], names=["id", "q", "lead", "rest"])

    return cut(ints.mapInArrow(run, StructType([*ints.schema.fields, *StructType.fromDDL("lead array<double>, rest double").fields])))


def _measure(q: np.ndarray, centroids: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Exact squared distances of the given pairs."""
    out = np.empty(len(rows), np.int64)
    step = max(1, CHUNK // q.shape[1])
    for a in range(0, len(rows), step):
        d = q[rows[a : a + step]] - centroids[columns[a : a + step]]
        out[a : a + step] = (d * d).sum(axis=1)
    return out


def nearest(q: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, and how many
    distances were measured."""
    c_lead, c_rest = rotate(centroids, basis)
    x_size, c_size = (lead**2).sum(axis=1) + rest**2, (c_lead**2).sum(axis=1) + c_rest**2
    bound = (lead**2).sum(axis=1)[:, None] + (c_lead**2).sum(axis=1) - 2 * (lead @ c_lead.T) + (rest[:, None] - c_rest) ** 2
    bound -= MARGIN * (x_size[:, None] + c_size) + 1e-6
    every = np.arange(len(q))
    guess = bound.argmin(axis=1)
    best = _measure(q, centroids, every, guess)
    open_ = bound <= best[:, None]
    open_[every, guess] = False
    rows, columns = np.nonzero(open_)
    distance = _measure(q, centroids, rows, columns)
    number = guess.astype(np.int64)
    # per row the least (distance, number) of the guess and the survivors
    rows, columns, distance = np.concatenate((every, rows)), np.concatenate((number, columns)), np.concatenate((best, distance))
    order = np.lexsort((columns, distance, rows))
    first = order[np.searchsorted(rows[order], every)]
    return columns[first], distance[first], len(rows)


def _sums(centroids: np.ndarray, basis: np.ndarray):
    """Per task and centroid the number and the sum of its vectors."""
    k, dim = centroids.shape

    def run(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            if batch.num_rows:
                q = _ints(batch.column(0), dim)
                number, _, _ = nearest(q, _doubles(batch.column(1), len(q)), np.asarray(batch.column(2)), centroids, basis)
                np.add.at(total, number, q)
                count += np.bincount(number, minlength=k)
        used = np.flatnonzero(count)
        offsets = pa.array(np.arange(len(used) + 1) * dim, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.ListArray.from_arrays(offsets, pa.array(total[used].ravel()))], names=["cluster", "n", "total"]
        )

    return run


def _doubles(column: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(rows, -1)


def move(table: DataFrame, centroids: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """One round: every vector to its nearest centroid, every centroid that got one to
    the floor of its vectors' mean."""
    dim = centroids.shape[1]
    sent = table.select("q", "lead", "rest").mapInArrow(_sums(centroids, basis), "cluster int, n bigint, total array<bigint>")
    added = sent.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(dim)]).alias("total"))
    out = centroids.copy()
    for row in added.collect():  # k rows at most
        out[row.cluster] = [t // row.n for t in row.total]
    return out


def assign(table: DataFrame, centroids: np.ndarray, basis: np.ndarray) -> DataFrame:
    """``(id, cluster, distance)`` of every vector."""
    dim = centroids.shape[1]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                q = _ints(batch.column(1), dim)
                number, distance, _ = nearest(q, _doubles(batch.column(2), len(q)), np.asarray(batch.column(3)), centroids, basis)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return table.mapInArrow(run, StructType([table.schema["id"], *StructType.fromDDL("cluster int, distance bigint").fields]))


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dim: int = 64, scale: int = 256, k: int = 40, rounds: int = 5, salt: str = "2:") -> DataFrame:
    """``(key, cluster, distance, cluster_inertia, inertia, centroid)`` of every vector
    after ``rounds`` rounds.

    Centroids start as the ``k`` vectors whose ``sha256(salt + key)`` is smallest, of
    equal keys the smaller vector first.
    """
    spark = vectors.sparkSession
    ints = to_integers(vectors, key, vector, dim, scale)
    basis = rotation(ints, dim)
    table = store(ints, basis)
    first = table.where("id is not null").select("q", F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).alias("h")).orderBy("h", "q").limit(k).collect()
    out = "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    if not first:
        empty = spark.createDataFrame([], StructType([table.schema["id"], *StructType.fromDDL("cluster int, distance bigint").fields, *StructType.fromDDL(out).fields[1:]]))
        return empty.withColumnRenamed("id", key)
    centroids = np.array([r.q for r in first], np.int64)
    for _ in range(rounds):
        centroids = move(table, centroids, basis)
    found = cut(assign(table, centroids, basis))
    sums = {r.cluster: r.d for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows at most
    rows = [(int(c), sums[c], sum(sums.values()), centroids[c].tolist()) for c in sorted(sums)]
    return found.join(F.broadcast(spark.createDataFrame(rows, out)), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
