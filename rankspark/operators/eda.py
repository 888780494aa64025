"""Profiling queries (D1-D36): distribution, label, position, missingness,
coverage, drift and popularity tables.  Each is one or a few aggregates; wide
per-column profiles are computed in a single pass and unpivoted with
``stack`` instead of one job per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import dbl
from ..specs import GROUP_COL
from .lookups import with_globals
from .quantiles import exact_quantiles


def rates(prefix_rows: str = "rows") -> list[Column]:
    return [F.count(F.lit(1)).alias(prefix_rows), F.avg(dbl("click_bool")).alias("click_rate"),
            F.avg(dbl("booking_bool")).alias("booking_rate"), F.avg(dbl("relevance")).alias("relevance_mean")]


def unpivot(one_row: DataFrame, names: list[str], value_cols: dict[str, str], key: str = "column_name") -> DataFrame:
    """Turn a one-row frame of ``{prefix}{name}`` values into one row per name."""
    n = len(names)
    exprs = []
    for name in names:
        exprs.append(f"'{name}'")
        exprs += [f"`{tmpl.format(name)}`" for tmpl in value_cols.values()]
    stack = f"stack({n}, {', '.join(exprs)}) AS ({key}, {', '.join(value_cols)})"
    return one_row.selectExpr(stack)


def null_pct(df: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    return df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(f"{prefix}{c}") for c in cols])


def distinct_counts(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``column_name`` and how many values it has, nulls apart.

    The columns are unpivoted to narrow (column, value) pairs, which are made distinct before and after one shuffle: a
    ``countDistinct`` of each would send every row once a column, in the width of all of them.
    """
    kinds, spark = {f.name: f.dataType for f in df.schema.fields}, df.sparkSession

    def pair(i: int, c: str) -> Column:
        own = F.col(c)
        whole = own.cast("long") if isinstance(kinds[c], T.IntegralType) else F.unix_micros(own) if isinstance(kinds[c], T.TimestampType) else None
        real = own.cast("double") if isinstance(kinds[c], T.FractionalType) and not isinstance(kinds[c], T.DecimalType) else None
        text = own.cast("string") if whole is None and real is None else None
        parts = (("w", whole, "long"), ("d", real, "double"), ("t", text, "string"))
        return F.struct(F.lit(i).alias("k"), *[(F.lit(None) if x is None else x).cast(kind).alias(at) for at, x, kind in parts])

    pairs = F.array(*[pair(i, c) for i, c in enumerate(columns)])
    values = df.select(F.inline(pairs)).where("w IS NOT NULL OR d IS NOT NULL OR t IS NOT NULL").distinct()
    counts = values.groupBy("k").agg(F.count(F.lit(1)).alias("_n"))
    names = spark.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("k", "column_name"))
    return names.join(counts, "k", "left").select("column_name", F.coalesce("_n", F.lit(0).cast("long")).alias(name))


def missingness_report(train: DataFrame, test: DataFrame, columns: list[str], top_n: int = 80) -> DataFrame:
    """Null % in each split, absolute difference, top n."""
    a = unpivot(null_pct(train, columns, "tr_"), columns, {"train_missing_pct": "tr_{}"})
    b = unpivot(null_pct(test, columns, "te_"), columns, {"test_missing_pct": "te_{}"})
    out = a.join(b, "column_name").withColumn("abs_diff_pct", F.abs(F.col("train_missing_pct") - F.col("test_missing_pct")))
    return out.orderBy(F.col("abs_diff_pct").desc(), F.col("train_missing_pct").desc(),
                       F.col("test_missing_pct").desc(), F.col("column_name")).limit(top_n)


def search_labels(train: DataFrame, group: str = GROUP_COL) -> DataFrame:
    """Per-search candidates, clicks, bookings, max relevance and flags."""
    g = train.groupBy(group).agg(F.count(F.lit(1)).alias("candidates"), F.sum("click_bool").alias("clicks"),
                                 F.sum("booking_bool").alias("bookings"), F.max("relevance").alias("max_relevance"),
                                 F.max("random_bool").alias("random_bool"))
    return g.select("*", (F.col("clicks") - F.col("bookings")).alias("clicked_no_booking"),
                    (F.col("clicks") > 0).cast("int").alias("has_click"),
                    (F.col("bookings") > 0).cast("int").alias("has_booking"),
                    (F.col("max_relevance") > 0).cast("int").alias("has_any_relevance"))


DESCRIBE_PCTS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def describe(df: DataFrame, cols: list[str], pcts=DESCRIBE_PCTS) -> DataFrame:
    """Count, mean, std, min, percentiles (linear interpolation), max."""
    aggs = []
    for c in cols:
        x = dbl(c)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.percentile(x, F.array(*[F.lit(p) for p in pcts])).alias(f"{c}__pct")]
    one = df.agg(*aggs)
    stat_cols = {"count": "{}__count", "mean": "{}__mean", "std": "{}__std", "min": "{}__min", "max": "{}__max"}
    out = unpivot(one.select("*", *[F.col(f"{c}__pct")[i].alias(f"{c}__p{int(p * 100)}") for c in cols
                                    for i, p in enumerate(pcts)]),
                  cols, {**stat_cols, **{f"p{int(p * 100)}": "{}__p" + str(int(p * 100)) for p in pcts}})
    return out


def numeric_drift_report(train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """Standardized mean difference with pooled std and missing-share drift
    (whole tables: no sampling needed)."""
    def side(df, p):
        return unpivot(df.agg(*[e for c in columns for e in (
            F.avg(dbl(c)).alias(f"{p}m_{c}"), F.stddev_samp(dbl(c)).alias(f"{p}s_{c}"),
            F.avg(F.col(c).isNull().cast("double")).alias(f"{p}n_{c}"))]),
            columns, {f"{p}mean": f"{p}m_{{}}", f"{p}std": f"{p}s_{{}}", f"{p}null": f"{p}n_{{}}"})
    j = side(train, "tr_").join(side(test, "te_"), "column_name")
    pooled = F.sqrt((F.pow("tr_std", 2) + F.pow("te_std", 2)) / 2)
    return j.select(
        "column_name", F.col("tr_mean").alias("train_mean"), F.col("te_mean").alias("test_mean"),
        (F.col("te_mean") - F.col("tr_mean")).alias("mean_diff"),
        F.when(pooled > 0, (F.col("te_mean") - F.col("tr_mean")) / pooled).alias("standardized_mean_diff"),
        (F.col("tr_null") * 100).alias("train_missing_pct"), (F.col("te_null") * 100).alias("test_missing_pct"),
        ((F.col("te_null") - F.col("tr_null")) * 100).alias("missing_diff_pct"))


def quantile_edges(df: DataFrame, features: list[str], q: int = 10) -> DataFrame:
    """One row of the features' distinct edges, all found together."""
    found = exact_quantiles(df, {f: F.col(f) for f in features}, {f: [i / q for i in range(q + 1)] for f in features})
    return found.select(*[F.array_distinct(F.array_sort(f)).alias(f) for f in features])


def target_by_quantile(df: DataFrame, feature: str, q: int = 10, extra=(), edges: DataFrame | None = None) -> DataFrame:
    """Label rates per quantile bucket (duplicate edges dropped, intervals
    (lo, hi], lowest included); rows with a missing feature are left out."""
    x = dbl(feature)
    edges = (quantile_edges(df, [feature], q) if edges is None else edges).select(F.col(feature).alias("_e"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    j = df.filter(x.isNotNull()).transform(lambda _d: with_globals(_d, edges))
    b = F.greatest(F.lit(1), F.size(F.filter(F.col("_e"), lambda e: e < x)))
    j = j.withColumn("_b", b).filter(F.size("_e") >= 2)
    out = j.groupBy("_b").agg(F.first(F.col("_e")[F.col("_b") - 1]).alias("bucket_lo"),
                              F.first(F.col("_e")[F.col("_b")]).alias("bucket_hi"), *rates(), *extra)
    return out.transform(lambda _d: with_globals(_d, total)).select(
        F.lit(feature).alias("feature"), F.col("_b").alias("bucket"), "bucket_lo", "bucket_hi", "rows",
        "click_rate", "booking_rate", "relevance_mean", (F.col("rows") / F.col("_total")).alias("row_pct"),
        *[c for c in out.columns if c not in ("_b", "bucket_lo", "bucket_hi", "rows", "click_rate", "booking_rate", "relevance_mean")])


def label_aggregate(df: DataFrame, keys: list[str], min_rows: int) -> DataFrame:
    """Popularity per key set with a minimum row count (HAVING)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(GROUP_COL).alias("searches"),
                              F.avg(dbl("click_bool")).alias("click_rate"), F.avg(dbl("booking_bool")).alias("booking_rate"),
                              F.avg(dbl("relevance")).alias("relevance_mean"), F.avg(dbl("position")).alias("avg_position"),
                              F.avg(dbl("price_usd")).alias("avg_price"))
    return g.filter(F.col("rows") >= min_rows)


def top_share(df: DataFrame, key: str, share: float = 0.1) -> DataFrame:
    """Row share of the top ceil(share * n) keys by row count."""
    from .folds import global_rank

    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    ranked = global_rank(counts, [F.col("_c").desc(), F.col(key).asc()], "_r")
    stats = ranked.agg(F.count(F.lit(1)).alias("keys"), F.sum("_c").alias("_rows"))
    j = ranked.transform(lambda _d: with_globals(_d, stats)).filter(F.col("_r") <= F.ceil(F.col("keys") * share))
    return j.groupBy("keys", "_rows").agg(F.count(F.lit(1)).alias("top_keys"), F.sum("_c").alias("_top")).select(
        F.lit(key).alias("key"), "keys", "top_keys", (F.col("_top") / F.col("_rows")).alias("top_share"))
