"""Mixing sources to target weights by Pareto order sampling.

Each source is to give a target number of words. Documents first get the whole
copies that the target allows to all of them; the rest of the target, a share
of the source, is drawn. Chances differ: a longer document is likelier to be
drawn, a shorter one less, so that the chances times the sizes sum up to what is
missing. Every document has a random number, ranked by its odds divided by the
odds of the document's inclusion, and the first ones in this order are taken
until the words are reached. The cut is found with counts per
slice of the order; only the rows of the one slice per source in which the cut
falls are ever sorted together. What follows from it, one row per source, is
all that a second pass needs to decide every row where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekfold.llm.tables import text_or_empty, word_count
from weekfold.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SLICES = 2_048
#: Words of a document that is neither long nor short.
TYPICAL = 256
_TWO_52 = float(2**52)


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
) -> DataFrame:
    """(source, source_size, target) from (source, size) rows: one row per source.

    Sources in code-point order, null last, weigh ``weights``, repeating.
    Together they get ``share`` of all words, but none more than ``most`` times
    its own: what is above is shared anew by weight among the others until none
    is above. The last level is found directly: with the sources ordered by
    cap per weight, exactly a prefix of them is capped. With share above
    ``most`` every source stops at its cap; sources without words get none.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    numbered = totals.withColumn("nth", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(1))
    upto = Window.orderBy("fill", "nth").rowsBetween(Window.unboundedPreceding, -1)
    leveled = (
        numbered.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("all", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("capped", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
        .withColumn("lighter", F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
        .withColumn("heft", F.sum("weight").over(everything))
        # the level if all sources before this one are capped and this one is not
        .withColumn("level", (F.col("all") - F.col("capped")) / (F.col("heft") - F.col("lighter")))
        .withColumn("open", F.col("fill") > F.col("level"))
        .withColumn("water", F.min(F.when(F.col("open"), F.struct("fill", "nth", "level"))).over(everything)["level"])
    )
    return leveled.select(
        "source", "source_size",
        F.coalesce(F.least("cap", F.col("weight") * F.col("water")), F.col("cap")).alias("target"),
    )


def _uniform(key: Column, text: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from the id (the text, where the id is null), as SQL can give it."""
    named = F.coalesce(key.cast("string"), text)
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), named).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / _TWO_52


def _measured(docs: DataFrame, key: str, text: str, source: str, seed: str, weight: str | None) -> DataFrame:
    """``docs`` with what sampling needs: ``mix_id``, ``mix_source``, ``mix_size``, ``mix_u``, ``mix_weight``."""
    size = word_count(F.col(text))
    if weight is None:
        # thousandths from 0 for no words up to 1 for very many; whole numbers, whose sums are exact
        own = F.floor(1000 * size / (size + TYPICAL)).cast("double")
    else:
        own = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    return docs.withColumns({
        "mix_id": F.col(key),
        "mix_source": F.col(source).cast("string"),
        "mix_size": size,
        "mix_u": _uniform(F.col(key), text_or_empty(text), seed),
        "mix_weight": own,
        "mix_by_size": F.lit(weight is None),
    })


_NEEDED = ("mix_id", "mix_source", "mix_size", "mix_u", "mix_weight", "mix_by_size")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan. A stored plan has a known size, by which Spark chooses the join."""
    return rows.join(plan, F.col("mix_source").eqNullSafe(F.col("source")), "left").drop("source")


def _odds_ratio() -> Column:
    """The Pareto ranking number: odds of the random number over odds of inclusion.

    By size, the chance is the missing share of the source, tilted by how far
    the document's weight is from the mean one; this stays between 0 and 1, and
    sums of chances times sizes are what is missing. With weights of the
    caller, the chance is proportional to them.
    """
    share = F.try_divide(F.col("missing"), F.col("source_size"))
    tilted = share + F.least(share, 1 - share) * (F.col("mix_weight") - F.col("mean_weight")) / 1000
    weighed = F.try_divide(share * F.col("mix_weight"), F.col("mean_weight"))
    chance = F.when(F.col("mix_by_size"), tilted).otherwise(weighed)
    chance = F.least(F.greatest(F.coalesce(chance, F.lit(0.0)), F.lit(1e-12)), F.lit(1 - 1e-12))
    return F.col("mix_u") / (1 - F.col("mix_u")) / (chance / (1 - chance))


def _slice() -> Column:
    """Slices in the order of the ranking number, even in the random number where weights are equal.

    The number is taken times the odds that all rows of the source would have
    with equal weights, so that slices are as even for a small or large chance.
    """
    chance = F.coalesce(F.try_divide(F.col("missing"), F.col("source_size")), F.lit(0.0))
    chance = F.least(F.greatest(chance, F.lit(1e-12)), F.lit(1 - 1e-12))
    odds = _odds_ratio() * (chance / (1 - chance))
    return F.least(F.floor(odds / (1 + odds) * SLICES), F.lit(SLICES - 1)).cast("long")


def _place() -> Column:
    return F.struct(_odds_ratio().alias("q"), F.col("mix_id").alias("id"), F.col("mix_size").alias("size"))


def sampling_plan(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
) -> DataFrame:
    """One row per source: its target, whole copies, missing words, and the place of the last row drawn."""
    plain = rows.select(F.col("mix_source").alias("source"), F.col("mix_size").alias("size"), "mix_weight")
    mean = plain.groupBy("source").agg(
        F.coalesce(F.try_divide(F.sum(F.col("size") * F.col("mix_weight")), F.sum("size")), F.lit(0.0)).alias("mean_weight")
    ).withColumnRenamed("source", "source_")
    whole = F.floor(F.try_divide(F.col("target"), F.col("source_size")))
    goal = settle(
        targets(plain, weights, share, most)
        .withColumn("whole", F.when(F.col("source_size") > 0, whole).otherwise(0).cast("long"))
        .withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
        .join(mean, F.col("source").eqNullSafe(F.col("source_"))).drop("source_"),
        "mix-goal",
    )
    drawn = _with_plan(rows, goal).select(
        F.col("mix_source").alias("source"), "missing", F.col("mix_size").alias("size"), _place().alias("place"),
        _slice().alias("slice"),
    ).where("missing > 0")  # else there is nothing to draw, and no cut
    slices = drawn.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("missing").alias("missing"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # the slice of each source in which the sum passes the missing words
    cuts = settle(
        slices.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .where("before <= missing and before + words > missing")
        .groupBy("source").agg(F.min(F.struct("slice", "before")).alias("cut"))
        .select(F.col("source").alias("source_"), "cut"),
        "mix-cuts",
    )
    order = Window.partitionBy("source").orderBy("place")
    # the rows in front of the cut slice are all drawn; in it, as many as come nearest
    last = (
        drawn.join(cuts, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
        .where(F.col("slice") <= F.col("cut.slice"))
        .withColumn("inside", F.col("slice") == F.col("cut.slice"))
    )
    front = last.where("not inside").groupBy("source").agg(F.max("place").alias("last"))
    border = (
        last.where("inside")
        .withColumn("sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cut.before"))
        .where(F.col("sum") - F.col("size") / 2 <= F.col("missing"))
        .groupBy("source").agg(F.max("place").alias("last"))
    )
    ends = front.unionByName(border).groupBy("source").agg(F.max("last").alias("last"))
    ends = ends.select(F.col("source").alias("source_"), "last")
    has_cut = cuts.select(F.col("source_").alias("cut_source"), F.lit(True).alias("has_cut"))
    return settle(
        goal.join(ends, F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")
        .join(has_cut, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source"),
        "mix-plan",
    )


def _copies() -> Column:
    """Whole copies, and one more for a row that is drawn. Without a cut, all words are missing or none."""
    drawn = F.when(F.col("has_cut"), F.coalesce(_place() <= F.col("last"), F.lit(False))).otherwise(F.col("missing") > 0)
    return F.coalesce(F.col("whole") + drawn.cast("long"), F.lit(0))


def mixture(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
    key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix",
    weight: str | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): one row for each row of ``docs``.

    ``taken`` is the number of words of the document in the mix: its size times
    its copies. All documents of a source get ``floor(target / source_size)``
    copies; of the words then missing, documents are drawn in Pareto order up to
    where the sum is nearest. Their inclusion probabilities grow with their
    sizes; with a column ``weight`` they are proportional to it (at most 1;
    weights of 0 or null are drawn last). Random numbers come
    from the id alone: reruns agree, and rows of equal id and size are drawn
    together. Null and empty texts have no words; null sources form one source;
    with a null id the text takes its place. No row is lost, and an empty table
    gives an empty result.
    """
    rows = settle(_measured(docs, key, text, source, seed, weight).select(*_NEEDED), "mix-rows")
    return _with_plan(rows, sampling_plan(rows, weights, share, most)).select(
        F.col("mix_id").alias("doc_id"), F.col("mix_source").alias("source"), F.col("mix_size").alias("size"),
        "source_size", "target", (F.col("mix_size") * _copies()).cast("long").alias("taken"),
    )


def mixed_rows(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
    key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix",
    weight: str | None = None,
) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: each as often as ``mixture`` takes it.

    Rows without words are in it as often as their place in the order says.
    """
    measured = _measured(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row"), "*"),
                         key, text, source, seed, weight).select("whole_row", *_NEEDED)
    rows = settle(measured.select(*_NEEDED), "mix-rows")
    return (
        _with_plan(measured, sampling_plan(rows, weights, share, most))
        .withColumn("copies", _copies())
        .where("copies > 0")
        .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
        .select(*[F.col(f"whole_row.`{c}`").alias(c) for c in docs.columns])
    )
