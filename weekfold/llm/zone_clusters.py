"""Centroid clustering over zone maps along a Hilbert curve.

Vectors are turned to the principal axes of a bounded sample and sorted along a
Hilbert curve through the first of these axes, then cut into blocks. Each block
keeps the box that its vectors fill (on all axes), their number and their sum:
a zone map. In each round the boxes decide which centroids can be nearest to
any vector of a block. With one candidate left the zone map answers for the
whole block; otherwise its vectors are compared with the candidates, exactly,
in whole numbers. Axes, curve and boxes only decide how much is compared, never
what comes out.

Tasks send one sum for each cluster and component; the centroids, whose number
is a parameter, are all that the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekfold.session import settle

SCALE, DIMENSIONS, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, "1"
#: Vectors of the sample for the axes, axes and bits of the curve, vectors in a block.
SAMPLE_ROWS, CURVE_AXES, CURVE_BITS, BLOCK_ROWS = 4_096, 6, 10, 256
#: Squared distances between vectors of smaller components fit into a long.
LIMIT = 2.0**27
#: Below it, inner products are exact in doubles.
EXACT = 2**22


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (rows x axes, ``bits`` each) on the Hilbert curve through the grid."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    # undo the turns of each level, from the coarsest
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(x)):
            mirrored = (x[i] >> level) & 1 == 1
            swapped = np.where(mirrored, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(mirrored, x[0] ^ low, x[0] ^ swapped)
            x[i] = x[i] ^ swapped if i else x[0]
    # Gray code across the axes
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros(len(cells), dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> level) & 1)
    return key


class Axes:
    """Principal axes of a sample, and the grid that the curve runs through."""

    def __init__(self, sample: np.ndarray, axes: int = CURVE_AXES, bits: int = CURVE_BITS):
        self.bits = bits
        centred = sample - sample.mean(axis=0)
        # columns by falling variance
        self.turn = np.linalg.eigh(centred.T @ centred)[1][:, ::-1].copy()
        along = sample @ self.turn[:, :axes]
        self.low = along.min(axis=0)
        self.step = np.maximum((along.max(axis=0) - self.low) / 2**bits, 1e-12)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        cells = np.floor((vectors @ self.turn[:, :len(self.low)] - self.low) / self.step)
        return hilbert_keys(np.clip(cells, 0, 2**self.bits - 1), self.bits)


def kept_vectors(vectors: DataFrame, key: str, embedding: str, dimensions: int, scale: float) -> DataFrame:
    """(vec_id, vector array<long>) of ``floor(scale * x)``, of the rows that take part."""
    e = F.col(embedding).cast("array<double>")
    fits = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LIMIT))
    return vectors.where((F.size(F.col(embedding)) == dimensions) & fits).select(
        F.col(key).cast("long").alias("vec_id"),
        F.transform(e, lambda x: F.floor(x * scale).cast("long")).alias("vector"),
    )


def _keyed(axes: Axes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = np.array(batch["vector"].tolist(), dtype=np.int64)
                small = np.abs(found).max(axis=1) < 2**15
                yield pd.DataFrame({
                    "vec_id": batch["vec_id"], "place": axes.keys(found.astype(np.float64)),
                    "vector": [v.astype(np.int16 if s else np.int64).tobytes() for v, s in zip(found, small)],
                })

    return run


def _vectors(packed, dimensions: int) -> np.ndarray:
    """Vectors of two or of eight bytes for each component."""
    return np.array(
        [np.frombuffer(v, dtype=np.int16 if len(v) == 2 * dimensions else np.int64) for v in packed], dtype=np.int64
    )


def _blocks(axes: Axes, dimensions: int, rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list = []
        packed: list = []

        def block(n: int) -> dict:
            found = _vectors(packed[:n], dimensions)
            along = found @ axes.turn
            out = {
                "ids": ids[:n], "n": n, "low": along.min(axis=0), "high": along.max(axis=0),
                "total": found.sum(axis=0), "vectors": b"".join(packed[:n]),
                "widths": bytes(len(v) // dimensions for v in packed[:n]),
            }
            del ids[:n], packed[:n]
            return out

        for batch in batches:
            ids += [None if pd.isna(i) else int(i) for i in batch["vec_id"]]
            packed += batch["vector"].tolist()
            made = []
            while len(ids) >= rows:
                made.append(block(rows))
            if made:
                yield pd.DataFrame(made)
        if ids:
            yield pd.DataFrame([block(len(ids))])

    return run


_ZONE = (
    "ids array<long>, n long, low array<double>, high array<double>, total array<long>, vectors binary, widths binary"
)


class Centroids:
    """Whole-number centroids, and what a box tells about them."""

    def __init__(self, points: list[list[int]], axes: Axes):
        self.points = np.array(points, dtype=np.int64)
        self.along = self.points @ axes.turn
        self.squares = (self.along**2).sum(axis=1)
        self.small = int(np.abs(self.points).max()) < EXACT

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers of the centroids that may be nearest to some point of the box, ties included."""
        # far above the rounding of turned coordinates
        slack = 1e-9 * (np.maximum(np.abs(low), np.abs(high)) ** 2).sum() + 1e-9 * self.squares + 1e-6
        below, above = low - self.along, self.along - high
        nearest = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=1)
        farthest = np.maximum(below**2, above**2)
        # the far side of the box on each axis
        farthest = np.maximum(farthest, np.maximum((high - self.along) ** 2, (self.along - low) ** 2)).sum(axis=1)
        best = int(farthest.argmin())
        left = np.flatnonzero(nearest <= farthest[best] + slack)
        # least difference of the distances to each and to the best one, over the box
        across = 2 * (self.along[best] - self.along[left])
        least = self.squares[left] - self.squares[best] + np.minimum(across * low, across * high).sum(axis=1)
        return left[least <= slack[left] + slack[best]]

    def assign(self, vectors: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each vector, ties to the smaller number, and its squared distance."""
        points = self.points[among]
        if self.small and int(np.abs(vectors).max(initial=0)) < EXACT:
            v, p = vectors.astype(np.float64), points.astype(np.float64)
        else:
            v, p = vectors, points
        far = (v * v).sum(axis=1)[:, None] - 2 * (v @ p.T) + (p * p).sum(axis=1)[None, :]
        which = far.argmin(axis=1)
        return among[which], far[np.arange(len(v)), which].astype(np.int64)


def _unpacked(vectors: bytes, widths: bytes, dimensions: int) -> np.ndarray:
    if widths.count(2) == len(widths):
        return np.frombuffer(vectors, dtype=np.int16).reshape(-1, dimensions).astype(np.int64)
    ends = np.cumsum(np.frombuffer(widths, dtype=np.uint8).astype(np.int64) * dimensions)
    return _vectors([vectors[e - w * dimensions:e] for e, w in zip(ends.tolist(), widths)], dimensions)


def _sums(centroids: Centroids, dimensions: int):
    """For each task and cluster: its number of vectors and their sum, and how many vectors were compared."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(centroids.points), dtype=np.int64)
        totals = np.zeros(centroids.points.shape, dtype=np.int64)
        for batch in batches:
            for zone in batch.itertuples(index=False):
                among = centroids.candidates(np.asarray(zone.low), np.asarray(zone.high))
                if len(among) == 1:
                    counts[among[0]] += zone.n
                    totals[among[0]] += np.asarray(zone.total)
                    continue
                vectors = _unpacked(zone.vectors, zone.widths, dimensions)
                own, _ = centroids.assign(vectors, among)
                counts += np.bincount(own, minlength=len(counts))
                order = np.argsort(own, kind="stable")
                starts = np.searchsorted(own[order], among)
                held = np.append(starts[1:], len(own)) > starts
                totals[among[held]] += np.add.reduceat(vectors[order], starts[held], axis=0)
        some = np.flatnonzero(counts)
        if len(some):
            yield pd.DataFrame({"cluster": some, "n": counts[some], "total": [totals[c] for c in some]})

    return run


def _assigned(centroids: Centroids, dimensions: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for zone in batch.itertuples(index=False):
                among = centroids.candidates(np.asarray(zone.low), np.asarray(zone.high))
                own, far = centroids.assign(_unpacked(zone.vectors, zone.widths, dimensions), among)
                yield pd.DataFrame({
                    "vec_id": pd.array([None if pd.isna(i) else int(i) for i in zone.ids], dtype="Int64"),
                    "cluster": own, "distance": far,
                })

    return run


def _moved(zones: DataFrame, centroids: Centroids, dimensions: int) -> list[list[int]]:
    """The centroids after one round: componentwise floor of the mean; empty ones stay."""
    sums = zones.mapInPandas(_sums(centroids, dimensions), "cluster int, n long, total array<long>")
    rows = (
        sums.select("cluster", "n", F.posexplode("total").alias("at", "total"))
        .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()  # one number for each cluster and component
    )
    points = centroids.points.tolist()
    for r in rows:
        points[r.cluster][r["at"]] = int(r.total) // int(r.n)
    return points


def clusters(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, key: str = "vec_id",
    embedding: str = "embedding", dimensions: int = DIMENSIONS, scale: float = SCALE, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): one row for each row that takes part.

    Components become ``floor(scale * x)``. Centroids start as the k vectors of
    the smallest SHA-256 of ``<seed>:<vec_id>`` (ties by the vector, rows
    without an id last), all if there are fewer; each round assigns every vector
    to the nearest one (squared distance, ties to the smaller number) and moves
    each to the floor of its vectors' mean, empty ones not at all. Null vectors,
    those of another length, with null or non-finite components, or with scaled
    components of 2^27 or more (their squared distances fit into no long) take
    no part. Repeated rows and ids count each. Inertias beyond a long are null;
    an empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, key, embedding, dimensions, scale)
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(by_hash.asc_nulls_last(), "vector").limit(k).collect()
    if not first:
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    # a sample for the axes alone: at most so many vectors, the same ones on every run
    sample = kept.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(SAMPLE_ROWS).select("vector").collect()
    axes = Axes(np.array([r.vector for r in sample], dtype=np.float64), min(CURVE_AXES, dimensions))
    keyed = kept.mapInPandas(_keyed(axes), "vec_id long, place long, vector binary")
    # ids, too, part the vectors of one place: many may be equal
    spread = F.xxhash64("vec_id")
    zones = settle(
        keyed.repartitionByRange("place", spread).sortWithinPartitions("place", spread)
        .mapInPandas(_blocks(axes, dimensions, block_rows), _ZONE),
        "zones",
    )
    points = [r.vector for r in first]
    for _ in range(rounds):
        points = _moved(zones, Centroids(points, axes), dimensions)
    assigned = settle(
        zones.mapInPandas(_assigned(Centroids(points, axes), dimensions), "vec_id long, cluster int, distance long"),
        "assigned",
    )
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    own = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(exact.alias("total")).collect()}
    every = sum(own.values())

    def held(n: int) -> int | None:
        return n if n < 2**63 else None

    described = spark.createDataFrame(
        [(c, held(own.get(c, 0)), held(every), hashlib.sha256(",".join(map(str, p)).encode()).hexdigest())
         for c, p in enumerate(points)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # k rows
    return assigned.join(F.broadcast(described), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
