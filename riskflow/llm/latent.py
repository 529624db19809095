"""Latent semantic spaces of benchmark items: randomised SVD of their TF-IDF vectors, and cosine search in them.

Items of one class of length are cut into blocks of ``BLOCK_ITEMS``, and each block has a space of its own, so that the number
of dimensions never has to grow with the benchmark. Spark factors the blocks side by side, each in one task of bounded size. A
passage is projected by adding up its words' rows and compared by the cosine of both projections, so words that no item of the
block has do not count against it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

BLOCK_ITEMS = 128
DIMENSIONS = 64
OVERSAMPLE, POWER_ITERATIONS = 8, 2
#: Words whose running sums are held at once.
WORDS_AT_ONCE = 8192
_SCHEMA = "space int, places array<long>, items array<long>, basis binary, vectors binary"


@dataclass
class Space:
    places: np.ndarray  # in the vocabulary, ascending
    basis: np.ndarray  # one row of dimensions for each place, times its inverse document frequency
    items: np.ndarray
    vectors: np.ndarray  # unit length


def randomised_svd(matrix: np.ndarray, dimensions: int, seed: int = 0) -> np.ndarray:
    """An orthonormal basis (columns) of the leading right singular vectors; those of singular value 0 are left out."""
    width = min(dimensions + OVERSAMPLE, *matrix.shape)
    left = matrix @ np.random.default_rng(seed).standard_normal((matrix.shape[1], width))
    for _ in range(POWER_ITERATIONS):
        left = matrix @ np.linalg.qr(matrix.T @ np.linalg.qr(left)[0])[0]
    _, values, right = np.linalg.svd(np.linalg.qr(left)[0].T @ matrix, full_matrices=False)
    return right[: min(dimensions, int((values > 1e-9).sum()))].T


def _factor(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("item")
    size = rows.places.str.len().to_numpy()
    place, weight, idf = (np.concatenate(rows[c].to_list()) for c in ("places", "weights", "idf"))
    known, first, column = np.unique(place, return_index=True, return_inverse=True)
    matrix = np.zeros((len(rows), len(known)))
    matrix[np.repeat(np.arange(len(rows)), size), column] = weight
    basis = randomised_svd(matrix, DIMENSIONS)
    vectors = matrix @ basis
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    scaled = basis * idf[first][:, None]
    return pd.DataFrame({"space": [key[0]], "places": [known], "items": [rows["item"].to_numpy()],
                         "basis": [scaled.astype(np.float32).tobytes()], "vectors": [vectors.astype(np.float32).tobytes()]})


def fit(spark: SparkSession, blocks: list[np.ndarray], first: np.ndarray, place: np.ndarray, weight: np.ndarray, idf: np.ndarray) -> list[Space]:
    """A space for each block of items; an item's words are ``first[k]`` to ``first[k + 1]`` of the other arrays."""
    rows = [(s, int(k), *(x[first[k] : first[k + 1]].tolist() for x in (place, weight, idf))) for s, items in enumerate(blocks) for k in items]
    table = spark.createDataFrame(rows, "space int, item long, places array<long>, weights array<double>, idf array<double>")
    found = table.groupBy("space").applyInPandas(_factor, _SCHEMA).orderBy("space").collect()
    out = []
    for r in found:
        vectors = np.frombuffer(r.vectors, np.float32).reshape(len(r["items"]), -1)
        basis = np.frombuffer(r.basis, np.float32).reshape(len(r.places), -1)
        out.append(Space(np.array(r.places), basis, np.array(r["items"]), vectors))
    return out


def search(space: Space, at: np.ndarray, place: np.ndarray, begin: np.ndarray, end: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, item, cosine) of all windows (word ranges, ascending) and items of the space with a cosine of ``least`` or more.

    ``at`` and ``place`` are the words of the vocabulary, ascending, and their places in it.
    """
    row = np.full(max(int(place.max(initial=0)), int(space.places[-1])) + 1, -1, np.int32)
    row[space.places] = np.arange(len(space.places))
    own = row[place]
    at, own = at[own >= 0], own[own >= 0]
    lo, hi = np.searchsorted(at, begin), np.searchsorted(at, end)
    k = 0
    while k < len(begin):
        stop = max(k + 1, int(np.searchsorted(lo, lo[k] + WORDS_AT_ONCE)))
        a, b = lo[k], hi[k:stop].max()
        total = np.zeros((b - a + 1, space.basis.shape[1]), np.float32)
        np.cumsum(space.basis[own[a:b]], axis=0, out=total[1:])
        z = total[hi[k:stop] - a] - total[lo[k:stop] - a]
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-6)
        cosine = z @ space.vectors.T
        window, item = np.nonzero(cosine >= least)
        if len(window):
            yield k + window, space.items[item], cosine[window, item]
        k = stop
