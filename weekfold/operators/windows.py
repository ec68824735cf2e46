"""Windows over an entity's past.

Two layouts are supported.

* ``rolling`` takes one row per entity and period. An entity then has at most
  as many rows as there are periods, so one sort partition per entity is
  bounded no matter how large the table grows, and every statistic of every
  window size shares a single exchange and a single sort.
* ``rolling_events`` takes raw events, where one entity may own a large share
  of all rows. It numbers rows from per-slice counts and evaluates windows in
  fixed-size blocks that carry a small halo, so no task ever holds an entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekfold import config
from weekfold.functions.scalars import as_col, existing, ordinal
from weekfold.operators import long_windows
from weekfold.session import compile_by_parts, ship_package

MEASURES = ("avg", "stddev", "trend", "min", "max")


# SQL text rather than Column objects: a wide table needs hundreds of these, and
# text crosses to the JVM in one call each
_MEASURE_SQL = {
    "avg": "avg(cast({v} AS double))",
    "stddev": "stddev_samp(cast({v} AS double))",
    "trend": "regr_slope(cast({v} AS double), cast({x} AS double))",
    "min": "min(cast({v} AS double))",
    "max": "max(cast({v} AS double))",
}


def column_name(stat: str, measure: str, window: int) -> str:
    return f"{stat}_{measure}_{window}"


def game_number(df: DataFrame, entity=("player_id",), order=("season", "week"), name: str = "game_number") -> DataFrame:
    """Sequence number of each row within its entity."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*entity).orderBy(*order)))


def _all_measures(stats, windows, measures, partition, order, position, extra=()) -> list[str]:
    """Every measure of every statistic over every window, and the window sizes.

    ``extra`` lists further (statistic, measure, window) triples.
    """
    unknown = {*measures, *(m for _, m, _ in extra)} - set(_MEASURE_SQL)
    if unknown:
        raise ValueError(f"unknown measures {sorted(unknown)}")
    by = f"PARTITION BY {', '.join(partition)} ORDER BY {', '.join(order)}"

    def frame(n: int) -> str:
        return f"OVER ({by} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"

    triples = [(s, m, n) for n in windows for s in stats for m in measures]
    triples += [t for t in extra if t not in triples]
    return [
        f"{_MEASURE_SQL[m].format(v=f'`{s}`', x=position)} {frame(n)} AS `{column_name(s, m, n)}`"
        for s, m, n in triples
    ] + [f"count(1) {frame(n)} AS games_in_window_{n}" for n in windows]


def rolling(
    df: DataFrame,
    entity=("player_id",),
    order=("season", "week"),
    stats=(),
    windows=config.ROLLING_WINDOWS,
    measures=MEASURES,
    keep=None,
    drop_first_before: bool = False,
    extra=(),
) -> DataFrame:
    """Rolling measures over the previous n rows, current row excluded.

    Two rows of an entity with the same ``order`` raise an error: which of them
    is the earlier one would be left to chance. ``drop_first_before`` removes
    the first row of every entity *before* the windows see it, reproducing a
    filter that SQL applies ahead of window evaluation.
    """
    stats = existing(df, stats)
    keep = _kept(df, stats, keep)
    numbered = _numbered(df.select(*dict.fromkeys([*entity, *order, *keep, *stats])), entity, order, drop_first_before)
    return numbered.selectExpr(
        *[f"`{c}`" for c in keep], "game_number",
        *_all_measures(stats, windows, measures, entity, order, "game_number", extra),
    )


def _kept(df: DataFrame, stats, keep) -> list[str]:
    keep = list(keep) if keep is not None else [c for c in df.columns if c not in stats]
    return [c for c in keep if c != "game_number"]


def _numbered(df: DataFrame, entity, order, drop_first_before: bool) -> DataFrame:
    """Rows with their number; refuses rows whose order is open."""
    numbered = game_number(df, entity, order)
    # over the same window as the numbers, so it takes no further sort
    place = F.struct(*order)
    again = F.lag(place).over(Window.partitionBy(*entity).orderBy(*order)) == place
    refused = F.raise_error(F.lit(f"two rows of one entity share {list(order)}"))
    numbered = numbered.withColumn("_again", again).filter(
        F.when(F.col("_again"), refused.cast("boolean")).otherwise(F.lit(True))
    ).drop("_again")
    return numbered.filter(F.col("game_number") > 1) if drop_first_before else numbered


def rolling_long(
    df: DataFrame,
    entity=("player_id",),
    order=("season", "week"),
    stats=(),
    windows=config.ROLLING_WINDOWS,
    measures=MEASURES,
    keep=None,
    drop_first_before: bool = False,
    groups: dict[str, list[str]] | None = None,
    group_by: str = "position",
    places: int | None = None,
) -> DataFrame:
    """``rolling`` as one row per entity, period and statistic, whatever the number of statistics.

    Columns: ``keep``, game_number, stat, value, ``<measure>_<n>`` and
    games_in_window_<n>. Rows are shuffled once, in their wide form; a task computes
    all statistics of a batch of them together (``long_windows``). With ``groups``
    (the statistics of each value of ``group_by``) an entity has only those of the
    groups it ever was in; the others are null throughout. With ``places`` the
    measures are rounded.
    """
    stats = existing(df, stats)
    keep = _kept(df, stats, keep)
    unknown = {*measures} - set(_MEASURE_SQL)
    if unknown:
        raise ValueError(f"unknown measures {sorted(unknown)}")
    ship_package(df.sparkSession)
    compile_by_parts(df.sparkSession)
    columns = [*entity, *order, *keep, *stats, *([group_by] if groups else [])]
    rows = _numbered(df.select(*dict.fromkeys(columns)), entity, order, drop_first_before)
    groups = groups or {}
    bit = {g: 1 << i for i, g in enumerate(groups)}
    ever = F.lit(0).cast("bigint")
    if groups:
        own = F.coalesce(*[F.when(F.col(group_by) == g, F.lit(b).cast("bigint")) for g, b in bit.items()], F.lit(0).cast("bigint"))
        ever = F.bit_or(own).over(Window.partitionBy(*entity))
    bits = [sum(bit[g] for g, names in groups.items() if s in names) for s in stats]
    keep = [c for c in keep if c not in ("stat", "value")]
    # the numbers' window has left the rows so: the plan holds no further sort
    wide = rows.withColumn("_groups", ever).sortWithinPartitions(*entity, *order).select(
        *keep, "game_number", "_groups", *[F.col(f"`{s}`").cast("double").alias(s) for s in stats if s not in keep],
    )
    schema = T.StructType([
        *[wide.schema[c] for c in (*keep, "game_number")],
        T.StructField("stat", T.StringType()), T.StructField("value", T.DoubleType()),
        *[T.StructField(f"{m}_{n}", T.DoubleType()) for n in windows for m in measures],
        *[T.StructField(f"games_in_window_{n}", T.LongType()) for n in windows],
    ])
    first = 2 if drop_first_before else 1

    def long(batches):
        import numpy as np

        masks = np.array(bits, dtype=np.int64)
        return long_windows.long_rows(batches, stats, masks == 0, masks, first, tuple(windows), tuple(measures), keep, places)

    return wide.mapInArrow(long, schema)


def number_events(df: DataFrame, entity, order, slice_by: Column, name: str = "event_number") -> DataFrame:
    """Row number per entity without sorting a whole entity in one task.

    ``slice_by`` must not decrease along ``order``. Rows are counted per
    (entity, slice) with map-side combine; only those counts are accumulated
    over the entity, and rows are then ranked inside their slice.
    """
    entity = list(entity)
    sliced = df.withColumn("_slice", slice_by)
    counts = sliced.groupBy(*entity, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*entity).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *entity, "_slice", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(*entity, "_slice").orderBy(*order)
    return (
        sliced.join(starts, [*entity, "_slice"])
        .withColumn(name, F.col("_start") + F.row_number().over(within))
        .drop("_slice", "_start")
    )


def rolling_events(
    df: DataFrame,
    entity,
    order,
    stats,
    slice_by: Column,
    windows=config.ROLLING_WINDOWS,
    measures=MEASURES,
    keep=None,
    block_rows: int = 500_000,
) -> DataFrame:
    """``rolling`` for event streams in which one entity may dominate.

    Rows are numbered (``number_events``), cut into blocks of ``block_rows``
    and the last rows of each block are also sent to the next one, so a window
    that reaches back over a block edge still sees every row it needs. Entities
    smaller than a block simply stay whole.
    """
    entity, order = list(entity), list(order)
    stats = existing(df, stats)
    keep = list(keep) if keep is not None else [c for c in df.columns if c not in stats]
    reach = max(windows)
    if block_rows < reach:
        raise ValueError("a block must hold at least the longest window")
    numbered = number_events(
        df.select(*dict.fromkeys([*entity, *order, *keep, *stats])), entity, order, slice_by
    )
    at = (F.col("event_number") - 1) % block_rows
    block = F.floor((F.col("event_number") - 1) / block_rows)
    spread = numbered.withColumn("_own", block).withColumn(
        "_block",
        F.explode(
            F.when(at >= block_rows - reach, F.array(block, block + 1)).otherwise(F.array(block))
        ),
    )
    wide = spread.selectExpr(
        "_own", "_block", "event_number", *[f"`{c}`" for c in keep],
        *_all_measures(stats, windows, measures, [*entity, "_block"], ["event_number"], "event_number"),
    )
    return wide.filter(F.col("_own") == F.col("_block")).drop("_own", "_block")


def rank_in_period(df: DataFrame, value, period=("season", "week"), name: str = "rank", extra=()) -> DataFrame:
    """Competition rank of ``value`` within each period, smallest first."""
    w = Window.partitionBy(*period, *extra).orderBy(as_col(value))
    return df.withColumn(name, F.rank().over(w))


def period_rank(df: DataFrame, period=("season", "week")) -> DataFrame:
    """Rank of every distinct period and how many there are.

    The un-partitioned window runs over the distinct periods only, a table that
    grows with the calendar and not with the data.
    """
    periods = df.select(*period).distinct()
    w = Window.orderBy(*period)
    return periods.select(
        *period,
        F.row_number().over(w).alias("time_rank"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("total_periods"),
    )


def spread_forward(df: DataFrame, weeks: int = config.TEAM_LOOKBACK_WEEKS, name: str = "target_week") -> DataFrame:
    """Send each row to the ``weeks`` following target weeks it contributes to.

    Turns a calendar range window into an ordinary grouping, which also allows
    distinct counts. The fan-out is fixed, and callers aggregate first.
    """
    return df.withColumn(
        name, F.explode(F.array(*[F.col("week") + k for k in range(1, weeks + 1)]))
    )


def lookback(df: DataFrame, at: DataFrame, stats, n: int, entity: str = "player_id") -> DataFrame:
    """Mean of the last ``n`` rows strictly before each (entity, season, week) in ``at``.

    The asked-for points are interleaved with the facts and evaluated as one
    window per entity: a marker row reads the ``n`` fact rows before it.
    """
    stats = existing(df, stats)
    facts = df.select(
        F.col(entity), ordinal().alias("_t"), F.lit(1).alias("_fact"),
        F.lit(None).cast("bigint").alias("season"), F.lit(None).cast("bigint").alias("week"),
        *[F.col(s).cast("double").alias(s) for s in stats],
    )
    asked = at.select(
        F.col(entity), ordinal().alias("_t"), F.lit(0).alias("_fact"),
        F.col("season").cast("bigint").alias("season"), F.col("week").cast("bigint").alias("week"),
        *[F.lit(None).cast("double").alias(s) for s in stats],
    ).distinct()
    # a marker sorts ahead of the facts of its own period
    w = Window.partitionBy(entity).orderBy("_t", "_fact")
    seen = F.sum("_fact").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # counting facts gives every fact its number and every marker the count before it
    numbered = facts.unionByName(asked).withColumn("_seen", seen)
    span = Window.partitionBy(entity).orderBy("_seen").rangeBetween(-(n - 1), 0)
    return (
        numbered.select(
            entity, "season", "week", "_fact",
            *[F.coalesce(F.avg(s).over(span), F.lit(0.0)).alias(f"avg_{s}") for s in stats],
            F.sum("_fact").over(span).alias("games_in_window"),
        )
        .filter(F.col("_fact") == 0)
        .drop("_fact")
    )
