"""Fitted tables and lookups: item profiles (A1), quantile buckets (A2, J7),
missing-value variants (A3), segment profiles (A4), frequency (A5), context
affinity (A6), and the key lookup with defaults (J1/J2/J8).

Every table is a hash aggregate (map-side partial aggregation, so a hot key
is combined before the shuffle) joined back to the rows with a left join.
Join strategy is left to AQE, which switches to a broadcast when the measured
table is small and splits skewed partitions otherwise; only one-row tables
(global priors) are broadcast explicitly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import dbl, finite_or_zero, flag, safe_divide
from ..session import joined_up, materialize, release_shuffles
from ..specs import (FREQUENCY_KEY_SPECS, ITEM_COL, MISSING_VALUE_FEATURE_COLS,
                     PROP_PROFILE_DELTA_COLS, PROP_PROFILE_SOURCE_COLS, SEGMENT_PROFILE_SOURCE_COLS,
                     SEGMENT_PROFILE_SPECS, ZERO_AS_MISSING_COLS, AFFINITY_KEY_SPECS,
                     BUCKET_SOURCE_SPECS)
from . import keyed as keyed_passes
from .keyed import keyed
from .lookups import is_struct, lookup, picked, with_globals  # noqa: F401  (is_struct: part of this module's interface)
from .quantiles import exact_medians, exact_quantiles
from .row_features import cleaned_missing


# ---- A1 item numeric profiles ------------------------------------------------
def prop_profile_source_columns(fit: DataFrame, apply: DataFrame) -> list[str]:
    """Configured profile sources present (and numeric) in both frames."""
    shared = set(fit.columns) & set(apply.columns)
    num = {f.name for f in fit.schema.fields if isinstance(f.dataType, T.NumericType)}
    return [c for c in PROP_PROFILE_SOURCE_COLS if c in shared and c in num]


def add_prop_numeric_profiles(fit: DataFrame, apply: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A1: mean/median per item over fit UNION apply rows, log1p(count); a null
    statistic falls back to the global one; 8 deltas mean/median to the row."""
    src = prop_profile_source_columns(fit, apply)
    if not src:
        return fit, apply
    both = fit.select(ITEM_COL, *src).unionByName(apply.select(ITEM_COL, *src))
    aggs, gaggs = [], []
    for c in src:
        aggs += [F.avg(dbl(c)).alias(f"prop_profile_{c}_mean"), F.median(dbl(c)).alias(f"prop_profile_{c}_median")]
        gaggs.append(finite_or_zero(F.avg(dbl(c))).alias(f"_g_{c}_mean"))
    table = _dealt_by_item(both, lambda rows: rows.groupBy(ITEM_COL).agg(*aggs, F.log1p(F.count(F.lit(1)).cast("double")).alias("prop_profile_log_count")))
    medians = exact_medians(both, {f"_g_{c}_median": F.col(c) for c in src})
    glob = with_globals(both.agg(*gaggs), medians.select(*[finite_or_zero(F.col(c)).alias(c) for c in medians.columns]))
    names = [f"prop_profile_{c}_{s}" for c in src for s in ("mean", "median")] + ["prop_profile_log_count"]
    # statistics that are null inside the table take the global value
    table = with_globals(table, glob).select(
        ITEM_COL, *[F.coalesce(F.col(n), F.col("_g_" + n[len("prop_profile_"):])).alias(n)
                    for n in names if n != "prop_profile_log_count"], "prop_profile_log_count")

    def attach(df: DataFrame) -> DataFrame:
        j = with_globals(lookup(df, table, ITEM_COL), glob)
        fills = []
        for n in names:
            g = F.lit(0.0) if n == "prop_profile_log_count" else F.col("_g_" + n[len("prop_profile_"):])
            fills.append(F.coalesce(F.col(n), g).alias(n))
        base = [c for c in df.columns]
        j = j.select(*base, *fills)
        deltas = []
        for c in PROP_PROFILE_DELTA_COLS:
            if c in df.columns and f"prop_profile_{c}_mean" in j.columns:
                deltas += [(dbl(c) - F.col(f"prop_profile_{c}_mean")).alias(f"{c}_prop_mean_diff"),
                           (dbl(c) - F.col(f"prop_profile_{c}_median")).alias(f"{c}_prop_median_diff")]
        return j.select("*", *deltas)

    return attach(fit), attach(apply)


def _dealt_by_item(rows: DataFrame, table_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``table_of`` the rows dealt by item: a median's partial state is all its values, and more bytes than the rows.  More rows than
    a pass holds are fitted in passes, a share of the items each."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    passes = -(-rows.count() * len(rows.columns) // keyed_passes.PASS_CELLS)
    if passes < 2:
        return table_of(rows.repartition(n, ITEM_COL))
    parts = []
    for i in range(passes):
        own = rows.where(F.pmod(F.xxhash64(ITEM_COL, F.lit("share")), F.lit(passes)) == i)
        parts.append(materialize(table_of(own.repartition(n, ITEM_COL)), "items"))
        del own
        release_shuffles(spark)
    return joined_up(parts)


# ---- A2 / J7 quantile buckets -------------------------------------------------
def bucket_edges(fit: DataFrame, specs=BUCKET_SOURCE_SPECS) -> DataFrame:
    """A2: one-row frame with, for each spec, the sorted distinct interior quantile
    edges (exact, linear interpolation); [] when the column has no values."""
    found = exact_quantiles(fit, {b: F.col(c) for c, b, _ in specs}, {b: [i / n for i in range(1, n)] for _, b, n in specs})
    return found.select(*[F.array_distinct(F.array_sort(b)).alias(f"_edges_{b}") for _, b, _ in specs])


def apply_buckets(df: DataFrame, specs, edges: DataFrame) -> DataFrame:
    """bucket = number of edges <= value (searchsorted right); missing -> -1."""
    j = with_globals(df, edges)
    new = []
    for c, b, n in specs:
        # at most n - 1 edges, each compared in compiled code, which an array's filter isn't
        below = " + ".join(f"IF(get(`_edges_{b}`, {i}) <= CAST(`{c}` AS DOUBLE), 1, 0)" for i in range(n - 1)) or "0"
        new.append(f"CASE WHEN `{c}` IS NULL THEN -1 ELSE {below} END AS `{b}`")
    return picked(j, df.columns, new)


def add_fit_buckets(fit: DataFrame, applies: list[DataFrame], specs=BUCKET_SOURCE_SPECS) -> list[DataFrame]:
    """A2 fitted in one pass over ``fit``, applied in one to each frame."""
    own = [s for s in specs if s[0] in fit.columns]
    if not own:
        return list(applies)
    edges = bucket_edges(fit, own)
    return [apply_buckets(d, [s for s in own if s[0] in d.columns], edges) for d in applies]


# ---- A3 missing-value variants ------------------------------------------------
def add_missing_value_features(fit: DataFrame, applies: list[DataFrame],
                               cols=MISSING_VALUE_FEATURE_COLS, segment: str = "prop_country_id") -> list[DataFrame]:
    """A3: missing flag, country-median imputation (-> global median), worst
    sentinel min - max(1, std), median diff (quirk Q2), zero clean/flag."""
    cols = [c for c in cols if c in fit.columns]
    if not cols:
        return applies
    gaggs = []
    for c in cols:
        x = cleaned_missing(c)
        gaggs += [(finite_or_zero(F.min(x)) - F.greatest(F.lit(1.0), finite_or_zero(F.stddev_samp(x))))
                  .alias(f"_sent_{c}")]
    medians = exact_medians(fit, {f"_gmed_{c}": cleaned_missing(c) for c in cols})
    glob = with_globals(fit.agg(*gaggs), medians.select(*[finite_or_zero(F.col(c)).alias(c) for c in medians.columns]))
    has_seg = segment in fit.columns
    seg = None
    if has_seg:
        seg = fit.groupBy(segment).agg(*[F.median(cleaned_missing(c)).alias(f"_smed_{c}") for c in cols])
    out = []
    for df in applies:
        present = [c for c in cols if c in df.columns]
        j = with_globals(df, glob)
        if has_seg and segment in df.columns:
            j = lookup(j, seg, segment)
        new = []
        for c in present:
            clean = cleaned_missing(c)
            smed = F.col(f"_smed_{c}") if (has_seg and segment in df.columns) else F.lit(None).cast("double")
            imputed = F.coalesce(clean, smed, F.col(f"_gmed_{c}"))
            new += [flag(clean.isNull()).alias(f"{c}_missing_or_zero"),
                    imputed.alias(f"{c}_country_imputed"),
                    F.coalesce(clean, F.col(f"_sent_{c}")).alias(f"{c}_missing_worst_sentinel"),
                    F.coalesce(clean - imputed, F.lit(0.0)).alias(f"{c}_country_median_diff")]
            if c in ZERO_AS_MISSING_COLS:
                new += [clean.alias(f"{c}_zero_clean"), flag(dbl(c) == 0).alias(f"{c}_zero_flag")]
        out.append(j.select(*df.columns, *new))
    return out


# ---- A4 segment profiles ------------------------------------------------------
def _std(c: str) -> Column:
    """Sample deviation, null for 0.  Equal values have none: merging their partial states leaves some 1e-17, by which a row's
    difference, as small, would be divided."""
    return F.when((F.min(dbl(c)) != F.max(dbl(c))) & (F.stddev_samp(dbl(c)) != 0), F.stddev_samp(dbl(c)))


def add_segment_profiles(fit: DataFrame, applies: list[DataFrame], specs=SEGMENT_PROFILE_SPECS,
                         sources=SEGMENT_PROFILE_SOURCE_COLS) -> list[DataFrame]:
    """A4: per-segment mean and std; std 0/null -> global std; global std 0/null
    -> 1; row diff to the segment mean and z-score."""
    num = {f.name for f in fit.schema.fields if isinstance(f.dataType, T.NumericType)}
    src = [c for c in sources if c in fit.columns and c in num]
    if not src:
        return applies
    glob = fit.agg(*[e for c in src for e in (
        F.avg(dbl(c)).alias(f"_gm_{c}"),
        F.coalesce(_std(c), F.lit(1.0)).alias(f"_gs_{c}"))])
    own = [(key, alias) for alias, key in specs if key in fit.columns]

    def table_of(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(*[e for c in src for e in (
            F.avg(dbl(c)).alias(f"sm_{c}"), _std(c).alias(f"ss_{c}"))])

    out = []
    for df, j in zip(applies, keyed(fit, applies, own, src, table_of, [f"{s}_{c}" for c in src for s in ("sm", "ss")], deal=True)):
        j = with_globals(j, glob)
        new = []
        for key, alias in own:
            for c in src if key in df.columns else ():
                diff = f"(CAST(`{c}` AS DOUBLE) - coalesce(`_{alias}_sm_{c}`, `_gm_{c}`))"
                std = f"nullif(coalesce(`_{alias}_ss_{c}`, `_gs_{c}`), 0D)"
                new += [f"{diff} AS `{alias}_{c}_segment_mean_diff`", f"coalesce(try_divide({diff}, {std}), 0D) AS `{alias}_{c}_segment_zscore`"]
        out.append(picked(j, df.columns, new))
    return out


# ---- A5 frequency ---------------------------------------------------------------
def add_frequency_features(fit: DataFrame, applies: list[DataFrame], specs=FREQUENCY_KEY_SPECS) -> list[DataFrame]:
    """A5: log1p(count of the key in fit), unseen -> 0."""
    own = [s for s in specs if s[0] in fit.columns]
    return [picked(j, df.columns, [f"log1p(CAST(coalesce(`_{alias}_n`, 0) AS DOUBLE)) AS `{alias}_log_frequency`" for key, alias in own if key in df.columns])
            for df, j in zip(applies, keyed(fit, applies, own, [], _counted, ["n"]))]


def _counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# ---- A6 context affinity --------------------------------------------------------
def add_affinity_features(fit: DataFrame, applies: list[DataFrame], specs=AFFINITY_KEY_SPECS) -> list[DataFrame]:
    """Cross count of (left, right) in fit, its shares of the left and right
    counts, and lift (cross + 1)/(left*right/N + 1)."""
    n_fit = fit.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).cast("double").alias("_n_fit"))
    own = [s for s in specs if s[1] in fit.columns and s[2] in fit.columns]

    def paired(df: DataFrame) -> DataFrame:
        """With the pairs as composite keys beside the single ones."""
        return df.select("*", *[F.struct(left, right).alias(f"_pair_{alias}") for alias, left, right in own if {left, right} <= set(df.columns)])

    singles = dict.fromkeys(c for _, left, right in own for c in (left, right))
    keys = [(f"_pair_{alias}", f"pair_{alias}") for alias, _, _ in own] + [(c, f"one_{c}") for c in singles]
    out = []
    for df, j in zip(applies, keyed(paired(fit), [paired(d) for d in applies], keys, [], _counted, ["n"])):
        j = with_globals(j, n_fit)
        new = []
        for alias, left, right in own:
            if not {left, right} <= set(df.columns):
                continue
            c, lc, rc = (f"CAST(coalesce(`_{n}_n`, 0) AS DOUBLE)" for n in (f"pair_{alias}", f"one_{left}", f"one_{right}"))
            new += [f"log1p({c}) AS `{alias}_log_count`", f"coalesce(try_divide({c}, {lc}), 0D) AS `{alias}_left_share`",
                    f"coalesce(try_divide({c}, {rc}), 0D) AS `{alias}_right_share`",
                    f"coalesce(try_divide({c} + 1D, {lc} * {rc} / _n_fit + 1D), 0D) AS `{alias}_lift`"]
        out.append(picked(j, df.columns, new))
    return out

