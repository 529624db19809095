"""Centroid clustering in exact integers over vectors that are dictionary-encoded by blocks of dimensions.

Vectors are cut into chunks of at most ``CHUNK_ROWS``, and the dimensions of a chunk into blocks of ``width``. A block's
distinct subvectors are its dictionary, and a vector is one code for each block, so nothing is lost. A round measures each
dictionary entry against each centroid once; a vector's distance is the sum of its entries' partial distances, and the sums
of a new centroid are entries times how often the cluster uses them. Dictionaries belong to chunks, as those of Parquet
belong to pages, so no table of subvectors has to fit anywhere or be joined by every block of every vector.

Between rounds the driver holds the centroids only; a task returns ``k * (dims + 1)`` sums, which Spark adds up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm import store

DIMS = 64
SCALE = 64
WIDTH = 2
CHUNK_ROWS = 8192
#: Components are kept within this magnitude, so that squared distances of thousands of dimensions fit into 64 bits.
LARGEST = 1 << 25
CHUNK_SCHEMA = "vec_ids array<bigint>, entries array<binary>, codes array<binary>"
_ARROW_CHUNK = pa.schema([("vec_ids", pa.list_(pa.int64())), ("entries", pa.list_(pa.binary())), ("codes", pa.list_(pa.binary()))])


def components(dims: int, scale: int) -> Column:
    """``floor(scale * x)`` of each component, x as double, within ``LARGEST``."""
    edge = F.lit(float(LARGEST))
    return F.transform(
        F.col("embedding").cast("array<double>"), lambda x: F.greatest(F.least(F.floor(F.greatest(F.least(x * scale, edge), -edge)), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))


def usable(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and integer components ``q`` of the vectors with exactly ``dims`` components, none null or non-finite."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fits = F.when(F.size("embedding") == dims, good).otherwise(False)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(fits).select("vec_id", components(dims, scale).alias("q"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int32, copy=False)


def _encoded(ids: pa.Array, q: np.ndarray, width: int) -> dict:
    entries, codes = [], []
    for first in range(0, q.shape[1], width):
        block = np.ascontiguousarray(q[:, first : first + width], "<i4")
        key = block.view("<i8" if block.shape[1] == 2 else f"V{4 * block.shape[1]}").ravel()
        _, one, code = np.unique(key, return_index=True, return_inverse=True)
        entries.append(block[one].tobytes())
        codes.append(code.astype("<u2").tobytes())
    return {"vec_ids": ids, "entries": entries, "codes": codes}


def encode(kept: DataFrame, dims: int = DIMS, width: int = WIDTH, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per chunk: its ids, and for each block of dimensions the dictionary and the codes."""
    if not 1 <= chunk_rows <= 1 << 16:
        raise ValueError("codes have 16 bits, so a chunk has 1 to 65,536 rows")
    store.prepare(kept.sparkSession)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def give() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            rows = table.to_batches()[0]
            out = _encoded(rows.column("vec_id").to_pylist(), _matrix(rows.column("q"), dims), width)
            return pa.RecordBatch.from_pylist([out], _ARROW_CHUNK)

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, chunk_rows - n)
                held.append(part)
                n, batch = n + part.num_rows, batch.slice(part.num_rows)
                if n == chunk_rows:
                    yield give()
                    held, n = [], 0
        if n:
            yield give()

    return kept.select("vec_id", "q").mapInArrow(chunks, CHUNK_SCHEMA)


class _Chunk:
    """A chunk as read back: dictionaries and codes as arrays."""

    def __init__(self, row: dict, dims: int, width: int):
        self.ids, n = row["vec_ids"], len(row["vec_ids"])
        self.columns = [slice(a, min(a + width, dims)) for a in range(0, dims, width)]
        sizes = [c.stop - c.start for c in self.columns]
        self.entries = [np.frombuffer(x, "<i4").reshape(-1, w).astype(np.int64) for x, w in zip(row["entries"], sizes)]
        self.codes = [np.frombuffer(x, "<u2") for x in row["codes"]]
        self.n = n

    def decoded(self) -> np.ndarray:
        return np.concatenate([e[c] for e, c in zip(self.entries, self.codes)], axis=1)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster (the smaller number of equals) and squared distance of each vector."""
        total = np.zeros((self.n, len(centroids)), np.int64)
        for column, entry, code in zip(self.columns, self.entries, self.codes):
            apart = entry[:, None, :] - centroids[None, :, column]
            total += np.einsum("ekw,ekw->ek", apart, apart)[code]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(self.n), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of each cluster, and its number of vectors in the last column."""
        parts = []
        for entry, code in zip(self.entries, self.codes):
            used = np.bincount(cluster * len(entry) + code, minlength=k * len(entry)).reshape(k, len(entry))
            parts.append(used @ entry)
        return np.concatenate([*parts, np.bincount(cluster, minlength=k)[:, None]], axis=1)


def _read(batches: Iterator[pa.RecordBatch], dims: int, width: int) -> Iterator[_Chunk]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield _Chunk(batch.slice(k, 1).to_pylist()[0], dims, width)


def first_centroids(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, ties (repeated ids) by their components."""
    order = F.sha2(F.concat_ws(":", F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = kept.select(order.alias("h"), "q").orderBy("h", "q").limit(k).collect()
    return np.array([r["q"] for r in rows], np.int64)


def moved(chunks: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """One round: every vector goes to its nearest centroid, every non-empty one to the floor of its vectors' mean."""
    k, dims = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for chunk in _read(batches, dims, width):
            total += chunk.sums(chunk.nearest(centroids)[0], k)
        cluster, at = np.divmod(np.arange(k * (dims + 1), dtype=np.int32), dims + 1)
        yield pa.RecordBatch.from_arrays([pa.array(cluster), pa.array(at), pa.array(total.ravel())], names=["cluster", "at", "total"])

    sums = chunks.mapInArrow(partial, "cluster int, at int, total bigint").groupBy("cluster", "at").agg(F.sum("total").alias("total"))
    total = np.zeros((k, dims + 1), object)
    for r in sums.collect():
        total[r["cluster"], r["at"]] = r["total"]
    return np.array([[s // row[-1] for s in row[:-1]] if row[-1] else old for row, old in zip(total, centroids.tolist())], np.int64)


def assigned(chunks: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> DataFrame:
    """``vec_id``, ``cluster`` and squared ``distance`` of every vector."""
    dims = centroids.shape[1] if centroids.size else 0

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _read(batches, dims, width):
            cluster, distance = chunk.nearest(centroids)
            yield pa.RecordBatch.from_arrays([pa.array(chunk.ids, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return chunks.mapInArrow(rows, "vec_id bigint, cluster int, distance bigint")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: str = "1", dims: int = DIMS, scale: int = SCALE, width: int = WIDTH) -> DataFrame:
    """Clusters of all usable vectors after ``rounds`` rounds: one row per vector.

    ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia`` and ``inertia`` (sums of distances) and
    ``centroid_sha256`` (of the components as decimal integers joined by commas). Vectors that are null, of another
    length, or hold a null, NaN or infinite component are left out. Repeated rows count each and may be several first
    centroids, of which the smaller number wins. A null ``vec_id`` is kept and hashes as ``seed`` alone. With fewer
    vectors than ``k`` there are fewer centroids; an empty table gives no rows. Components beyond ``LARGEST`` after
    scaling are taken as that. An inertia beyond 64 bits is null. Other columns are not read.
    """
    spark = vectors.sparkSession
    kept = usable(vectors, dims, scale)
    centroids = first_centroids(kept, k, seed)
    chunks = store.keep(encode(kept, dims, width), "vector-chunks")
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(chunks, centroids, width)
    found = store.keep(assigned(chunks, centroids, width), "vector-clusters")
    store.remove(spark, [chunks])
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s"))
    total = sums.agg(F.sum("s").alias("s"))
    own = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    named = spark.createDataFrame(own, "cluster int, centroid_sha256 string").join(sums, "cluster", "left")
    facts = named.select("cluster", "centroid_sha256", F.col("s").try_cast("bigint").alias("cluster_inertia"), total.scalar().try_cast("bigint").alias("inertia"))
    # One row per centroid.
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
