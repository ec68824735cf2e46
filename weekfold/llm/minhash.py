"""Near-duplicates by min-max hashing.

Each permutation of the shingles gives two signature values, its minimum and
its maximum: half the hash evaluations of plain MinHash. Bands of values from
different permutations make documents meet; every meeting is confirmed on the
full shingle sets. With ``BANDS`` bands of ``ROWS`` values a pair of similarity
0.8 meets in no band with a probability of (1 - 0.8^5)^40, about 1e-7.

Documents with equal sets are one node from the start. The members of a bucket
are not all paired. First each is compared with the bucket's hub, the member
that meets most others; what that links is one component. Left are pairs of
which at least one is no neighbour of the hub. They are found by how they differ
from it: if ``x`` and ``y`` are similar enough but ``y`` and the hub are not, then
``x`` and ``y`` must share so many of these differences that one of the rarest of
``x`` is among those of ``y`` (a prefix filter on the differences, exact by
counting; see ``_prefixes``). Components are contracted before anything is
paired: what only one component has is of no use, and two groups of near copies
are compared by their hubs first. The distance of sets is a metric, so hubs that
are farther apart than a link and the way from each to its farthest member tell
that no two members are linked (``_hubs_within_reach``). So a large group of near
copies costs one comparison per member and hub, and no link is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekfold.llm.components import components
from weekfold.llm.tables import narrow
from weekfold.session import settle

BANDS = 40
ROWS = 5
SIMILAR = 80  # of 100
CHUNK = 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well mixing bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        seeds = _mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * _ODD)
    return seeds[:count], seeds[count:] | np.uint64(1)


class Shingler:
    """Distinct word shingles of a text as sorted 64-bit hashes."""

    def __init__(self, words: int):
        self.words = words
        self.seen: dict[bytes, int] = {}

    def shingles(self, text: str) -> np.ndarray:
        # bytes: lower() and split() know ASCII only, which is what is asked for
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(self.seen) > 200_000:
            self.seen.clear()
        seen = self.seen
        for w in words:
            if w not in seen:
                seen[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.array([seen[w] for w in words], dtype=np.uint64)
        width = min(self.words, len(words))
        with np.errstate(over="ignore"):
            out = np.full(len(words) - width + 1, width, dtype=np.uint64)
            for i in range(width):
                out = _mixed(out * _ODD + hashes[i:len(words) - width + 1 + i])
        return np.unique(out)


class Signer:
    """Band keys of a shingle set."""

    def __init__(self, bands: int, rows: int):
        if bands % 2:
            raise ValueError("half of the bands take minima, half maxima: their number must be even")
        self.bands, self.rows = bands, rows
        self.xor, self.factor = _permutations(bands * rows // 2)

    def extremes(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Minimum and maximum of the set under each permutation."""
        low = high = None
        with np.errstate(over="ignore"):
            for at in range(0, len(shingles), CHUNK):
                # one row for each permutation
                h = (shingles[None, at:at + CHUNK] ^ self.xor[:, None]) * self.factor[:, None]
                low = h.min(axis=1) if low is None else np.minimum(low, h.min(axis=1))
                high = h.max(axis=1) if high is None else np.maximum(high, h.max(axis=1))
        return low, high

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        values = np.concatenate(self.extremes(shingles)).reshape(self.bands, self.rows)
        with np.errstate(over="ignore"):
            key = np.arange(1, self.bands + 1, dtype=np.uint64)
            for i in range(self.rows):
                key = _mixed(key * _ODD + values[:, i])
        return key.view(np.int64)


def _prints(words: int, bands: int, rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, signer = Shingler(words), Signer(bands, rows)
        for batch in batches:
            sets = [shingler.shingles(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "n_shingles": [len(s) for s in sets],
                "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "keys": [signer.keys(s) if len(s) else None for s in sets],
            })

    return run


def _sets(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            # in slices: the sets of a batch take more room than its texts
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at:at + 1000]
                yield pd.DataFrame({
                    "node": part["doc_id"], "set": [shingler.shingles(t).view(np.int64) for t in part["text"]],
                })

    return run


def _with_sets(pairs: DataFrame, sets: DataFrame, one: str, other: str) -> DataFrame:
    of_one = sets.select(F.col("node").alias(one), F.col("set").alias("set_one"))
    of_other = sets.select(F.col("node").alias(other), F.col("set").alias("set_other"))
    return pairs.join(of_one, one).join(of_other, other)


def _linked(similar: int) -> Column:
    both = F.size(F.array_intersect("set_one", "set_other"))
    return 100 * both >= similar * (F.size("set_one") + F.size("set_other") - both)


def _compared(stars: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Each (hub, node, wide) with how its sets differ; the differences themselves only where ``wide``.

    ``short`` is below zero for linked pairs: it counts by how much the pair
    misses the similarity, in the units of ``_prefixes``.
    """
    lost = F.array_except("set_one", "set_other")
    gained = F.array_except("set_other", "set_one")
    return (
        _with_sets(stars, sets, "hub", "node")
        .withColumns({"lost": lost, "gained": gained})
        .withColumn("weight", 100 * F.size("lost") + similar * F.size("gained"))
        .select(
            "hub", "node", "weight",
            (F.col("weight") - (100 - similar) * F.size("set_one")).alias("short"),
            ((F.size("lost") + F.size("gained")) / (F.size("set_one") + F.size("gained"))).alias("far"),
            F.when(F.col("wide"), F.concat("lost", "gained")).alias("differences"),
        )
    )


def _prefixes(compared: DataFrame, similar: int) -> tuple[DataFrame, DataFrame]:
    """(hub, token, node) rows of all members and of outlying ones: pairs that may be linked share a hub and a token.

    With sets of size H (hub), ``lost`` and ``gained`` elements of x and y
    against the hub and S common differences, ``100 * intersection >= similar *
    union`` means ``(100 + similar) * S >= weight(x) + weight(y) - (100 -
    similar) * H``, where ``weight = 100 * lost + similar * gained``. With
    ``short(y) = weight(y) - (100 - similar) * H > 0`` for an outlier y,
    S is more than ``weight(x) / (100 + similar)`` and, as S is at most
    ``weight(x) / similar``, at least ``short(y) / 100``. Two sets with S common
    elements share one among the first ``size - S + 1`` of each, in any common
    order; here the rarest differences of a hub's members come first.
    """
    outliers = compared.where("short > 0 and differences is not null").select("hub").distinct()
    contested = settle(
        compared.where("differences is not null").join(settle(outliers, "outliers"), "hub", "left_semi")
        .select("hub", "node", "weight", "short", F.size("differences").alias("size"),
                F.explode("differences").alias("token")),
        "differences",
    )
    common = settle(contested.groupBy("hub", "token").agg(F.count("*").alias("n")).where("n > 1"), "common")
    # a difference that no other member has is rarest, and cannot be shared
    order = Window.partitionBy("hub", "node").orderBy("n", "token")
    alone = F.col("size") - F.count("*").over(Window.partitionBy("hub", "node"))
    placed = settle(
        contested.join(common, ["hub", "token"]).withColumn("place", alone + F.row_number().over(order)), "placed"
    )
    first = placed.where(F.col("place") <= F.col("size") - F.expr(f"weight div {100 + similar}"))
    outlying = placed.where((F.col("short") > 0) & (F.col("place") <= F.col("size") - F.ceil(F.col("short") / 100) + 1))
    return first.select("hub", "token", "node"), outlying.select("hub", "token", "node")


def _hubs_within_reach(first: DataFrame, outlying: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """(hub, token, near_x, near_y): where members of hubs of different components meet, if some may be linked.

    A link between x and y means that their hubs are at most ``distance(x) +
    distance(y) + 1 - similar / 100`` apart, by the triangle inequality.
    """
    def ranges(rows: DataFrame, side: str) -> DataFrame:
        return rows.groupBy("hub", "token", "component", "near").agg(F.max("far").alias(f"far_{side}")).select(
            "hub", "token", F.col("component").alias(f"component_{side}"), F.col("near").alias(f"near_{side}"), f"far_{side}"
        )

    met = settle(
        ranges(first, "x").join(ranges(outlying, "y"), ["hub", "token"]).where("component_x <> component_y")
        .select("hub", "token", "near_x", "near_y", (F.col("far_x") + F.col("far_y")).alias("reach")),
        "meeting-hubs",
    )
    pairs = settle(met.groupBy("near_x", "near_y").agg(F.max("reach").alias("reach")), "hub-pairs")
    both = F.size(F.array_intersect("set_one", "set_other"))
    apart = 1 - both / (F.size("set_one") + F.size("set_other") - both)
    close = _with_sets(pairs, sets, "near_x", "near_y").where(
        apart <= F.col("reach") + (1 - similar / 100) + 1e-9
    ).select("near_x", "near_y")
    return met.join(settle(close, "close-hubs"), ["near_x", "near_y"], "left_semi").select(
        "hub", "token", "near_x", "near_y"
    ).distinct()


def _candidates(
    first: DataFrame, outlying: DataFrame, near: DataFrame, sets: DataFrame, similar: int,
) -> DataFrame:
    """Pairs (a, b) of different components that may be linked; ``near`` has (node, component, near, far)."""
    def known(rows: DataFrame) -> DataFrame:
        return rows.join(near, "node", "left").select(
            "hub", "token", "node", F.coalesce("component", "node").alias("component"),
            F.coalesce("near", "node").alias("near"), F.coalesce("far", F.lit(0.0)).alias("far"),
        )

    first, outlying = known(first), known(outlying)
    # differences that only one component has lead nowhere
    several = settle(
        first.unionByName(outlying).groupBy("hub", "token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("hub", "token"),
        "several",
    )
    first = settle(first.join(several, ["hub", "token"], "left_semi"), "first")
    outlying = settle(outlying.join(several, ["hub", "token"], "left_semi"), "outlying")
    reach = settle(_hubs_within_reach(first, outlying, sets, similar), "reach")
    of_x = first.select("hub", "token", F.col("node").alias("x"), F.col("near").alias("near_x"), F.col("component").alias("component_x"))
    of_y = outlying.select("hub", "token", F.col("node").alias("y"), F.col("near").alias("near_y"), F.col("component").alias("component_y"))
    return (
        of_x.join(reach, ["hub", "token", "near_x"]).join(of_y, ["hub", "token", "near_y"])
        .where("component_x <> component_y")
        .select(*_ordered("x", "y")).distinct()
    )


def _ordered(one: str, other: str) -> list:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def near_duplicates(
    docs: DataFrame, words: int = 5, similar: int = SIMILAR, bands: int = BANDS, rows: int = ROWS,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row for each row of ``docs``.

    Two documents are linked if ``100 * intersection >= similar * union`` of
    their sets of ``words``-word shingles (a shorter text is one shingle);
    ``component_id`` is the smallest id a document reaches, and it is ``kept``
    if that is its own. Texts without words, null texts among them, have no
    shingles and are linked with nothing; rows without an id are never linked
    and always kept. Repeated rows get equal results; rows that share an id are
    judged by their own texts. Other columns are ignored.
    """
    source = narrow(docs, key, text)
    prints = settle(
        source.mapInPandas(
            _prints(words, bands, rows), "doc_id long, n_shingles long, digest binary, keys array<long>"
        ),
        "prints",
    )
    # nodes: one document for each different set
    classes = settle(
        prints.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("node")),
        "classes",
    )
    members = (
        prints.where("digest is not null").select(F.col("doc_id").alias("node"), "digest", "keys")
        .join(classes, ["node", "digest"])
        .select("node", F.explode("keys").alias("bucket"))
    )
    members = settle(members, "members")
    meeting = settle(
        members.groupBy("bucket").agg(F.count_distinct("node").alias("size")).where("size > 1"), "meeting"
    )
    # written tables, so that the joins can split a hot bucket
    shared = settle(members.join(meeting, "bucket").distinct(), "shared-buckets")
    central = settle(shared.groupBy("node").agg(F.sum("size").alias("met")), "central")
    hubs = settle(
        shared.join(central, "node").groupBy("bucket")
        .agg(F.max(F.struct("met", (-F.col("node")).alias("node"))).alias("hub"))
        .select("bucket", (-F.col("hub.node")).alias("hub")),
        "hubs",
    )
    sets = settle(
        source.join(central.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
        .mapInPandas(_sets(words), "node long, set array<long>"),
        "sets",
    )
    stars = (
        shared.join(hubs, "bucket").where("node <> hub")
        .groupBy("hub", "node").agg((F.max("size") > 2).alias("wide"))
    )
    compared = settle(_compared(settle(stars, "stars"), sets, similar), "compared")
    near_hub = compared.where("short <= 0").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    labels = components(near_hub)
    # each node's nearest hub that it is linked to; without one it stands for itself
    own = F.min(F.struct("far", F.col("hub").alias("near")))
    hub_itself = compared.select(F.col("hub").alias("node")).distinct().select(
        F.lit(0.0).alias("far"), F.col("node").alias("hub"), "node"
    )
    nearest = compared.where("short <= 0").select("far", "hub", "node").unionByName(hub_itself).groupBy("node").agg(
        own.alias("own")
    )
    near = settle(
        nearest.join(labels, "node", "left").select(
            "node", F.coalesce("component", "node").alias("component"), "own.near", "own.far"
        ),
        "near",
    )
    others = settle(_candidates(*_prefixes(compared, similar), near, sets, similar), "others")
    found = settle(_with_sets(others, sets, "a", "b").where(_linked(similar)).select("a", "b"), "links")
    if not found.isEmpty():
        labels = components(near_hub.unionByName(found))
    belongs = settle(
        classes.join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id")),
        "belongs",
    )
    return (
        prints.select("doc_id", "n_shingles", "digest").join(belongs, "digest", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .select(
            "doc_id", "n_shingles", "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    An id goes if none of its rows is kept; rows without an id stay.
    """
    report = near_duplicates(docs, key=key, text=text, **options)
    gone = settle(
        report.groupBy("doc_id").agg(F.bool_or("kept").alias("any_kept")).where("not any_kept")
        .select(F.col("doc_id").alias("gone_id")),
        "gone",
    )
    return docs.join(gone, docs[key] == gone["gone_id"], "left_anti")
