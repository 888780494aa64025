"""Registered queries: one per operator of the inventory.

Each entry takes (spark, sf_dir) and returns a DataFrame that reads the whole
driver tables through the search-log adapter; ``ORACLES`` holds the matching
DuckDB SQL (absent for model/sink steps checked on rows only).
Doubles are rounded to 6 digits at the output boundary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import r6
from ..operators.labels import add_relevance
from ..sources.tables import search_log, test_frame, train_frame
from .oracle import exact_rounding, ndcg_ctes, with_base

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = exact_rounding(oracle)
        return fn
    return deco


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    return add_relevance(search_log(spark, sf))


def train(spark: SparkSession, sf: str) -> DataFrame:
    return train_frame(labeled(spark, sf))


def test(spark: SparkSession, sf: str) -> DataFrame:
    return test_frame(search_log(spark, sf))


_INTEGRAL = ("byte", "short", "integer", "long")


def round_doubles(df: DataFrame) -> DataFrame:
    """Output boundary: doubles rounded to 6 digits, integral types as BIGINT."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("double", "float", "decimal"):
            out.append(r6(F.col(f.name)).alias(f.name))
        elif t in _INTEGRAL:
            out.append(F.col(f.name).cast("long").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


from . import queries_core, queries_rows, queries_within, queries_fitted, queries_eval, queries_eda, queries_misc  # noqa: E402,F401  (registers entries)
