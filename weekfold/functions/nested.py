"""Arrays, structs and JSON documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekfold.functions.scalars import ColumnLike, as_col


def json_value(column: str) -> Column:
    """JSON text of one column's value, null when the value is null."""
    wrapped = F.to_json(F.struct(F.col(column).alias("v")))
    inner = F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)
    return F.when(F.col(column).isNotNull(), inner)


def spaced_json(columns: list[str]) -> Column:
    """``{"a": 1, "b": "x"}`` with names sorted and null fields left out.

    The ``": "`` and ``", "`` spacing matches the text hashed by earlier loads,
    so row hashes already stored stay comparable.
    """
    fields = [F.concat(F.lit(f'"{c}": '), json_value(c)) for c in sorted(columns)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))


def json_object(**fields: Column) -> Column:
    """JSON object text that keeps null fields."""
    return F.to_json(
        F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"}
    )


def json_number(document: ColumnLike, path: str, default: float | None = None) -> Column:
    """Number at a JSON path; missing, null or non-numeric gives ``default``."""
    found = F.get_json_object(as_col(document), path).try_cast("double")
    return found if default is None else F.coalesce(found, F.lit(float(default)))


def json_text(document: ColumnLike, path: str) -> Column:
    return F.get_json_object(as_col(document), path)


def sparse_json(columns: dict[str, Column]) -> Column:
    """JSON object holding only the non-null columns, as doubles."""
    return F.to_json(F.struct(*[c.cast("double").alias(n) for n, c in columns.items()]))


def merge_lists(a: ColumnLike, b: ColumnLike) -> Column:
    """Sorted union of two lists without duplicates; a null side is ignored."""
    a, b = as_col(a), as_col(b)
    both = F.array_sort(F.array_union(a, b))
    return F.when(a.isNotNull() & b.isNotNull(), both).otherwise(
        F.coalesce(F.array_sort(a), F.array_sort(b))
    )


def count_matching(values: ColumnLike, test) -> Column:
    return F.size(F.filter(as_col(values), test))


def set_flags(flags: dict[str, Column]) -> Column:
    """Names of the conditions that hold, in the given order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))


def append_flag(flags: ColumnLike, name: str, condition: Column) -> Column:
    present = F.coalesce(as_col(flags), F.array().cast("array<string>"))
    return F.when(condition, F.array_append(present, F.lit(name))).otherwise(as_col(flags))


def double_array(columns) -> Column:
    """Array of doubles with nulls as 0."""
    return F.array(*[F.coalesce(as_col(c).cast("double"), F.lit(0.0)) for c in columns])


def text_array(names) -> Column:
    return F.array(*[F.lit(n) for n in names])


def concat_all(arrays) -> Column:
    return F.concat(*arrays)


def flag_histogram(df: DataFrame, column: str) -> DataFrame:
    """How often each array element occurs."""
    return df.select(F.explode(column).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def widen_metrics(df: DataFrame, column: str, names: list[str] | None = None) -> DataFrame:
    """JSON object of numbers -> one double column per name.

    With ``names`` this is a projection. Without, the names present are found
    first (one distinct over keys, which is bounded by the metric vocabulary).
    """
    if names is None:
        keys = df.select(F.explode(F.json_object_keys(column)).alias("k")).distinct()
        names = [r.k for r in keys.orderBy("k").toLocalIterator()]
    # parsed once into a map rather than once per name
    parsed = F.from_json(F.col(column), "map<string,double>")
    wide = df.withColumn("_metrics", parsed)
    return wide.select(
        *df.columns, *[F.element_at("_metrics", F.lit(n)).alias(n) for n in names]
    )


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)
