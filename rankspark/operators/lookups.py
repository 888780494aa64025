"""The key lookup with defaults (J1/J2) and one-row statistics for every row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_struct(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, T.StructType)


def lookup(df: DataFrame, table: DataFrame, key: str, defaults: dict[str, Column | float] | None = None,
           ) -> DataFrame:
    """Left join ``table`` (one row per key) onto ``df`` and fill unmatched
    rows with ``defaults``.  Scalar keys: null never matches (pandas map);
    composite (struct) keys: null parts are values, so the join is null-safe."""
    defaults = defaults or {}
    t = table.withColumnRenamed(key, "_lk")
    cond = F.col(key).eqNullSafe(F.col("_lk")) if is_struct(df, key) else (F.col(key) == F.col("_lk"))
    out = df.join(t, cond, "left").drop("_lk")
    fills = [F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)).alias(c)
             for c, v in defaults.items()]
    if not fills:
        return out
    keep = [c for c in out.columns if c not in defaults]
    return out.select(*keep, *fills)


def with_globals(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Every row against a one-row statistics frame.

    The statistics are one struct and so one scalar subquery, planned and run
    once; its fields are inlined as values into the row expressions.  No join
    is planned."""
    g = one_row.select(F.struct(*one_row.columns).alias("_g")).scalar()
    return df.withColumn("_globals", g).selectExpr(*[f"`{c}`" for c in df.columns], *[f"_globals.`{c}` AS `{c}`" for c in one_row.columns])


def picked(df: DataFrame, keep: list[str], new: list[str]) -> DataFrame:
    """The columns ``keep`` and the expressions ``new``, which are text: hundreds of column objects would take longer to make than their jobs to run."""
    return df.selectExpr(*[f"`{c}`" for c in keep], *new)


_PACKABLE = (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType)


def packed(df: DataFrame, apart: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with its numeric columns but ``apart`` as one array, and what takes them out again.

    A join or projection copies an array as one block; hundreds of columns it copies one by one, which is most of
    the time of lookups on wide rows.  All packed types are exact as doubles; longs stay columns.
    """
    inside = [f for f in df.schema.fields if f.name not in apart and isinstance(f.dataType, _PACKABLE)]
    names = [f.name for f in inside]
    if not inside:
        return df, lambda d: d
    out = df.selectExpr(*[f"`{c}`" for c in df.columns if c not in names], f"array({', '.join(f'CAST(`{c}` AS DOUBLE)' for c in names)}) AS _packed")

    def unpacked(d: DataFrame) -> DataFrame:
        return d.selectExpr(*[f"`{c}`" for c in d.columns if c != "_packed"],
                            *[f"CAST(get(_packed, {i}) AS {f.dataType.simpleString()}) AS `{f.name}`" for i, f in enumerate(inside)])

    return out, unpacked
