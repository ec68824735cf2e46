"""Reading the raw feeds: season layout, availability, derived keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekfold import config, schemas
from weekfold.functions.scalars import parse_period
from weekfold.session import compile_by_parts


def feed_available(feed: str, season: int, first_loaded: int) -> bool:
    """Whether a feed exists for a season, given the earliest season loaded."""
    first, last, once = config.FEED_SEASONS[feed]
    if once:
        return season == first_loaded
    return (first is None or season >= first) and (last is None or season <= last)


def availability(df: DataFrame, feeds=None) -> DataFrame:
    """Season gate as rows: each distinct season of ``df`` with each feed it may read.

    The gate is a fixed list of feeds exploded per season, so the result is
    seasons x feeds and needs no join.
    """
    feeds = list(feeds or config.FEED_SEASONS)
    seasons = df.select(F.col("season").cast("int").alias("season")).distinct()
    first_loaded = seasons.agg(F.min("season")).scalar()

    def gate(feed: str) -> Column:
        first, last, once = config.FEED_SEASONS[feed]
        if once:
            return F.col("season") == first_loaded
        ok = F.lit(True)
        if first is not None:
            ok = ok & (F.col("season") >= first)
        if last is not None:
            ok = ok & (F.col("season") <= last)
        return ok

    return (
        seasons.select(
            "season",
            F.explode(
                F.array(*[F.struct(F.lit(f).alias("feed"), gate(f).alias("available")) for f in feeds])
            ).alias("g"),
        )
        .select("season", "g.feed", "g.available")
    )


def season_filter(df: DataFrame, seasons) -> DataFrame:
    """Keep the given seasons; on a season-partitioned layout this prunes files."""
    return df.filter(F.col("season").isin(*[int(s) for s in seasons]))


def with_entity_key(df: DataFrame, key: str = "player_id", source: str = "gsis_id") -> DataFrame:
    """Derive the entity key from another id when the feed does not carry it."""
    if key in df.columns or source not in df.columns:
        return df
    return df.withColumn(key, F.col(source))


def with_stamped_weeks(df: DataFrame, ts_col: str = "dt") -> DataFrame:
    """Weeks of the depth feed, which carries a timestamp from 2025 on."""
    if ts_col not in df.columns:
        return df
    given = F.col("_week") if "week" in df.columns else F.lit(1)
    stamped = parse_period(
        df.withColumnRenamed("week", "_week") if "week" in df.columns else df, ts_col
    )
    from_text = (F.col("season") >= config.DEPTH_TIMESTAMP_FIRST_SEASON) & F.col(ts_col).isNotNull()
    return stamped.withColumn("week", F.when(from_text, F.col("week")).otherwise(given)).drop("_week")


def read_feed(
    spark: SparkSession, root: str, feed: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """One feed with its declared schema, or another one; CSV files are read with a header row.

    For CSV a schema must list the file's columns in order.
    """
    table = f"raw_{feed}"
    path = f"{root.rstrip('/')}/{feed}"
    given, schema = schema is not None, schema or schemas.RAW[table]
    if feed == "depth_charts" and not given:
        schema = T.StructType([*schema.fields, T.StructField("dt", T.StringType())])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", "true").csv(path)
    return reader.format(fmt).load(path)


def with_refusals(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the declared columns and types, with a list ``refused`` of the (column, value, type) that do not fit.

    A cell is refused when it has a value that its type cannot hold; the typed
    column is null there. Columns that the frame lacks are null, others are
    left out. All cells of a row are judged in one projection.
    """
    compile_by_parts(df.sparkSession)
    have = {c.lower(): c for c in df.columns}
    none = F.array().cast("array<struct<column:string,value:string,type:string>>")
    typed, found = [], []
    for f in schema:
        own = have.get(f.name.lower())
        if own is None:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f"`{own}`")
        text = F.trim(value.cast("string"))
        cast = value if df.schema[own].dataType == f.dataType else _cast_text(text, f.dataType)
        typed.append(cast.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            # an empty text is a missing value
            cell = F.struct(F.lit(f.name).alias("column"), text.alias("value"), F.lit(f.dataType.simpleString()).alias("type"))
            found.append(F.when(cast.isNull() & (text != ""), F.array(cell)).otherwise(none))
    # short lists put together rather than one list filtered: a lambda would have its cells cast again, uncompiled
    return df.select(*typed, (F.concat(*found) if found else none).alias("refused"))


def _cast_text(text: Column, kind: T.DataType) -> Column:
    """``text`` as ``kind``, null where it does not fit.

    A cast that fails costs an exception with its message, a hundred times a cast
    that works. No number starts with a character from ":" to "~", but for the
    names of infinity and not-a-number, so such texts are not tried.
    """
    if not isinstance(kind, (T.IntegralType, T.FractionalType)):
        return text.try_cast(kind)
    tried = (text < ":") | (text >= "\x7f")
    if not isinstance(kind, T.IntegralType):
        tried = tried | F.lower(F.substring(text, 1, 3)).isin("inf", "nan")
    return F.when(tried, text.try_cast(kind))


def split_refused(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The rows that fit, typed, and a table of the cells that do not: (row, column, value, type).

    ``row`` is the row as JSON text, so it can be corrected and loaded again.
    """
    whole = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]))
    judged = with_refusals(df.withColumn("_whole", whole), T.StructType([*schema.fields, T.StructField("_whole", T.StringType())]))
    good = judged.where(F.size("refused") == 0).drop("refused", "_whole")
    bad = judged.where(F.size("refused") > 0).select(F.col("_whole").alias("row"), F.explode("refused").alias("c"))
    return good, bad.select("row", "c.*")


def read_fitting(spark: SparkSession, root: str, feed: str, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """A CSV feed as (rows that fit its declared schema, cells that do not); columns are matched by name."""
    path = f"{root.rstrip('/')}/{feed}"
    text = spark.read.option("header", "true").csv(path)
    return split_refused(text, schema or schemas.RAW[f"raw_{feed}"])


def load_feeds(
    spark: SparkSession, root: str, seasons, feeds=None, fmt: str = "parquet",
    play_schema: T.StructType | None = None,
) -> dict[str, DataFrame]:
    """The raw tables of the given seasons, each restricted to when it exists.

    ``root/<feed>`` holds the files of a feed, ideally partitioned by season.
    Feeds that none of the seasons offers are left out.
    """
    seasons = sorted(int(s) for s in seasons)
    out = {}
    for feed in feeds or config.FEED_SEASONS:
        wanted = [s for s in seasons if feed_available(feed, s, seasons[0])]
        if not wanted:
            continue
        df = read_feed(spark, root, feed, fmt, play_schema if feed == "pbp" else None)
        if not config.FEED_SEASONS[feed][2] and "season" in df.columns:
            df = season_filter(df, wanted)
        if feed == "players":
            df = with_entity_key(df)
        if feed == "depth_charts":
            df = with_stamped_weeks(df)
        out[f"raw_{feed}"] = df
    return out
