"""Exact duplicates with a split of the heavy hitters.

Texts are compared by SHA-256. Misra-Gries counters over all digests find the
frequent ones; an exact second count verifies them and finds the row that
stays. These winners, at most ``COUNTERS`` rows, are broadcast: their copies
are decided where they are read and never shuffled. All other digests, each
with less than ``2 / COUNTERS`` of the rows, take the ordinary shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekfold.llm.tables import text_or_empty
from weekfold.session import settle

COUNTERS = 1024


def _shrink(counts: Counter, size: int) -> Counter:
    """Misra-Gries: subtract the largest count beyond ``size`` counters from all of them."""
    if len(counts) <= size:
        return counts
    cut = sorted(counts.values(), reverse=True)[size]
    return Counter({d: n - cut for d, n in counts.items() if n > cut})


def _counters(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            counts.update(batch["digest"].tolist())
            counts = _shrink(counts, size)
        if counts:
            yield pd.DataFrame({"digest": list(counts), "n": list(counts.values())})

    return run


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest): at most ``counters`` digests, among them all with over 2 / counters of the rows.

    A digest loses at most rows / (counters + 1) of its count to the partial
    summaries, and fewer than ``counters`` digests can have more than that left.
    """
    return (
        digests.select("digest")
        .mapInPandas(_counters(counters), "digest binary, n long")
        .groupBy("digest").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "digest").limit(counters)
        .select("digest")
    )


def heavy_winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, winner, size): exact counts of the frequent digests and the largest id of each."""
    return (
        digests.join(F.broadcast(frequent_digests(digests, counters)), "digest")
        .groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count("*").alias("size"))
        .where("size > 1")
        .limit(counters)
    )


def _split(rows: DataFrame, winners: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows decided by a heavy winner, and those that need the shuffle (winners among them)."""
    # null ids rank lowest: a group without any id has its rows settled in the shuffle
    marked = rows.join(F.broadcast(winners), "digest", "left")
    loses = F.col("size").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("winner"))
    return marked.where(loses), marked.where(~loses)


def digests_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest): the SHA-256 of every text."""
    return docs.select(
        F.col(key).alias("doc_id"), F.unhex(F.sha2(text_or_empty(text).cast("binary"), 256)).alias("digest")
    )


def duplicate_report(
    docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = COUNTERS,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for each row of ``docs``.

    Of equal texts the row with the largest id stays; a null text equals the
    empty one; a null id is the smallest. Of rows with equal id and text one
    stays. Other columns are ignored.
    """
    digests = settle(digests_of(docs, key, text), "digests")
    winners = settle(heavy_winners(digests, counters), "winners")
    removed, rest = _split(digests, winners)
    group = Window.partitionBy("digest")
    ordinary = rest.select(
        "doc_id", "digest",
        F.max("doc_id").over(group).alias("keep_id"),
        F.coalesce("size", F.count("*").over(group)).alias("group_size"),
        (F.row_number().over(group.orderBy(F.desc_nulls_last("doc_id"))) == 1).alias("kept"),
    )
    decided = removed.select(
        "doc_id", "digest", F.col("winner").alias("keep_id"), F.col("size").alias("group_size"),
        F.lit(False).alias("kept"),
    )
    return ordinary.unionByName(decided).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def without_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = COUNTERS,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; the rules are those of ``duplicate_report``.

    Copies of heavy digests are dropped where they are read; only rows that may
    stay are shuffled.
    """
    digests = settle(digests_of(docs, key, text), "digests")
    winners = settle(heavy_winners(digests, counters), "winners")
    own = [F.col(f"whole.`{c}`").alias(c) for c in docs.columns]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
        F.col(f"`{key}`").alias("doc_id"),
        F.unhex(F.sha2(text_or_empty(text).cast("binary"), 256)).alias("digest"),
    )
    _, rest = _split(rows, winners)
    first = Window.partitionBy("digest").orderBy(F.desc_nulls_last("doc_id"))
    return rest.withColumn("rank", F.row_number().over(first)).where("rank = 1").select(*own)
