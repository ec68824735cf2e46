"""Exact top-k search by inner product with ball trees.

The candidates are dealt out to shards; each shard builds a ball tree over its
vectors. A node's centre and radius bound every inner product in it by
``query . centre + |query| * radius``; nodes are opened in the order of this
bound, and a query is done with a shard when the best bound left is below its
kth score. That score is shared between shards: each query first searches its
own shard, and starts with what it found there in all the others.

Queries and shards meet in blocks of bounded size, so that a task never holds
more than one shard and one block of queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekfold.session import settle

SCALE = 256
LEAF = 64
SHARD_ROWS = 16_384
SPREAD = 16
QUERY_ROWS = 8_192
EXACT = 2.0**52
#: Inner products of vectors with smaller components fit into a long.
LIMIT = 2.0**26


class BallTree:
    """Vectors in leaves, each node with the centre and the radius of what is below it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.leaf = leaf
        self.whole = vectors  # scores come from these, bounds from doubles
        vectors = vectors.astype(np.float64, copy=False)
        self.order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids, vectors
        self.nodes: list[tuple[int, int, int, int]] = []  # start, end, left, right
        centres, radii = [], []
        # depth first without recursion: (start, end, parent, side)
        todo = [(0, len(ids), -1, 0)]
        while todo:
            s, e, parent, side = todo.pop()
            me = len(self.nodes)
            self.nodes.append((s, e, -1, -1))
            if parent >= 0:
                a, b, left, right = self.nodes[parent]
                self.nodes[parent] = (a, b, me, right) if side == 0 else (a, b, left, me)
            points = vectors[self.order[s:e]]
            centre = points.mean(axis=0)
            away = ((points - centre) ** 2).sum(axis=1)
            centres.append(centre)
            radii.append(np.sqrt(away.max()) if len(points) else 0.0)
            if e - s > leaf and away.max() > 0:
                # two far points; the others go with the half they are nearer to
                one = points[away.argmax()]
                two = points[((points - one) ** 2).sum(axis=1).argmax()]
                along = points @ (two - one)
                half = (e - s) // 2
                self.order[s:e] = self.order[s:e][np.argpartition(along, half)]
                todo += [(s + half, e, me, 1), (s, s + half, me, 0)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.lengths = np.sqrt((self.centres**2).sum(axis=1))

    def search(self, query_id: int, query: np.ndarray, k: int, floor: float) -> list[tuple[int, int]]:
        """The k best (score, id), ties to smaller ids; only scores of ``floor`` or more matter."""
        # rounding of centres and radii is far below this slack; scores are exact
        about = query.astype(np.float64, copy=False)
        size = float(np.linalg.norm(about))
        bounds = self.centres @ about + size * self.radii
        bounds += 1e-9 * size * (self.lengths + self.radii) + 1e-6
        best: list[tuple[int, int]] = []  # smallest first, of (score, -id)
        todo = [(-bounds[0], 0)]
        while todo:
            bound, node = heapq.heappop(todo)
            if -bound < floor:
                break
            s, e, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    if bounds[child] >= floor:
                        heapq.heappush(todo, (-bounds[child], child))
                continue
            own = self.order[s:e]
            scores = self.whole[own] @ query
            for at in np.flatnonzero(scores >= floor).tolist():
                if self.ids[own[at]] == query_id:
                    continue
                entry = (int(scores[at]), -int(self.ids[own[at]]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                floor = max(floor, best[0][0])
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _matrix(column: pd.Series) -> np.ndarray:
    """Vectors of whole numbers; as doubles, if all their inner products are exact in them."""
    found = np.array(column.tolist(), dtype=np.int64)
    largest = float(np.abs(found).max()) if found.size else 0.0
    return found.astype(np.float64) if largest * largest * max(found.shape[1], 1) < EXACT else found


def _search(k: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        isq = group["is_query"].to_numpy(bool)
        queries, rows = group[isq], group[~isq]
        out: list[tuple[int, int, int]] = []
        if len(queries) and len(rows):
            every = _matrix(pd.concat([queries["vector"], rows["vector"]]))
            tree = BallTree(rows["vec_id"].to_numpy(), every[len(queries):])
            # as a double a floor may be rounded up: one step below it is safe
            floors = np.nextafter(queries["floor"].fillna(-np.inf).to_numpy(), -np.inf)
            for i, (query_id, floor) in enumerate(zip(queries["vec_id"].tolist(), floors.tolist())):
                out += [(query_id, n, s) for s, n in tree.search(query_id, every[i], k, floor)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


_FOUND = "query_id long, vec_id long, score long"


def scaled(vectors: DataFrame, key: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector array<long>): whole numbers, without rows that hold null or non-finite components."""
    e = F.col(embedding).cast("array<double>")
    # the longer a vector, the smaller the components whose products sum up to a long
    limit = LIMIT * F.sqrt(F.least(F.lit(1.0), 1024.0 / F.size(e)))
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < limit))
    return (
        vectors.where(F.col(embedding).isNotNull() & F.col(key).isNotNull() & finite)
        .select(F.col(key).cast("long").alias("vec_id"), F.transform(e, lambda x: F.floor(x * scale).cast("long")).alias("vector"))
        .where(F.size("vector") > 0)
        .distinct()
    )


def _parts(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", embedding: str = "embedding",
    scale: int = SCALE, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k best among all other vectors.

    ``is_query`` is a condition on ``vec_id``. Components become
    ``floor(scale * x)``; scores are exact integers, ties go to the smaller id.
    A query never finds rows of its own id. Null vectors, empty vectors, those
    with null or non-finite components and rows without an id take no part;
    equal rows count once; vectors meet only those of their own length; fewer
    than k others give fewer rows. Where doubles cannot hold the inner products
    exactly, they are computed in whole numbers; vectors with scaled components
    of 2^26 or more, whose products no long need hold, take no part. Other
    columns are ignored.
    """
    rows = settle(
        scaled(vectors, key, embedding, scale).withColumn("length", F.size("vector")), "vectors"
    )
    counted = rows.agg(F.count("*").alias("rows"), F.count_if(is_query).alias("queries")).first()
    # a few shards at least, so that small tables are spread as well
    shards = max(-(-counted["rows"] // shard_rows), min(SPREAD, -(-counted["rows"] // LEAF)), 1)
    blocks = max(-(-counted["queries"] // query_rows), 1)
    hashed = F.xxhash64("vec_id", "vector")
    rows = rows.withColumn("shard", F.pmod(hashed, F.lit(shards)).cast("int"))
    queries = rows.where(is_query).withColumn("block", F.pmod(F.xxhash64(hashed), F.lit(blocks)).cast("int"))
    columns = ["is_query", "vec_id", "vector", "floor", "length", "shard", "block"]

    def searched(asked: DataFrame, among: DataFrame) -> DataFrame:
        """Each block of queries in each of its shards."""
        both = asked.withColumn("is_query", F.lit(True)).select(columns).unionByName(
            among.withColumn("is_query", F.lit(False)).withColumn("floor", F.lit(None).cast("double")).select(columns)
        )
        return both.groupBy("length", "shard", "block").applyInPandas(_search(k), _FOUND)

    # first every query in its own shard: their ratio is fixed, so this needs no blocks
    first = settle(
        _best(searched(
            queries.withColumns({"floor": F.lit(None).cast("double"), "block": F.lit(0)}),
            rows.withColumn("block", F.lit(0)),
        ), k),
        "first-shard",
    )
    if shards == 1:
        return first.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    floors = first.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor")
    )
    others = (
        queries.join(floors, F.col("vec_id") == F.col("query_id"), "left").drop("query_id")
        .withColumn("own", F.col("shard")).withColumn("shard", _parts(shards)).where("shard <> own")
    )
    rest = searched(others, rows.withColumn("block", _parts(blocks)))
    return _best(first.drop("rank").unionByName(rest), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
