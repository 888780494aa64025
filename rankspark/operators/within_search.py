"""Within-search (query-group) features W1-W9.

W1-W5 unpivot the base columns: one window partition and sort per (search,
base) gives every statistic and rank, and one aggregate brings them back to the
rows.  W6 and W9 rank in windows by search; W9's means and medians are a hash
aggregate by search, joined back.
Ranks: min rank = ``rank()``; ties = ``count(*)`` over a RANGE frame of
peers; average pct rank = (min rank + (ties - 1)/2) / non-null count; the
descending min rank is derived from the same sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import clip_lower, dbl, flag, safe_divide
from ..specs import GROUP_COL, RELATIVE_FEATURE_BASES, ROW_ID


def _w(col: str, group: str | list[str], ascending: bool = True):
    groups = [group] if isinstance(group, str) else list(group)
    o = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    return Window.partitionBy(*groups).orderBy(o)


def rank_min(col: str, group=GROUP_COL, ascending: bool = True) -> Column:
    """pandas rank(method='min'): null for null values."""
    return F.when(F.col(col).isNotNull(), F.rank().over(_w(col, group, ascending)).cast("double"))


def peer_count(col: str, group=GROUP_COL) -> Column:
    w = _w(col, group).rangeBetween(Window.currentRow, Window.currentRow)
    return F.count(F.lit(1)).over(w)


def pct_rank_average(col: str, group=GROUP_COL, ascending: bool = True) -> Column:
    """pandas rank(method='average', pct=True) within the group."""
    groups = [group] if isinstance(group, str) else list(group)
    n = F.count(F.col(col)).over(Window.partitionBy(*groups))
    r = F.rank().over(_w(col, group, ascending))
    ties = F.count(F.lit(1)).over(_w(col, group, ascending).rangeBetween(Window.currentRow, Window.currentRow))
    return F.when(F.col(col).isNotNull(), (r + (ties - 1) / 2.0) / n)


def add_within_search_features(df: DataFrame, cols: list[str] | None = None,
                               group: str = GROUP_COL) -> DataFrame:
    """W1-W5 on every present base column (``RELATIVE_FEATURE_BASES``).

    The rows are dealt by search once.  There the bases are unpivoted to
    (group, base, x) rows, the first of which carries the row's other columns;
    one window partition (group, base) with one sort gives every statistic and
    rank, and an aggregate by row gathers them.  Neither what the bases
    multiply nor the result is shuffled or joined.
    """
    if group not in df.columns:
        raise ValueError(f"within-search features need the column {group}")
    src = [c for c in (cols or RELATIVE_FEATURE_BASES) if c in df.columns]
    if not src:
        return df
    others = [c for c in df.columns if c not in (group, ROW_ID)]
    row = F.struct(*others)
    none = F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType)
    pairs = F.array(*[F.struct(F.lit(i).alias("k"), dbl(c).alias("x"), (none if i else row).alias("_row")) for i, c in enumerate(src)])
    # a task holds a row for each base: more bases make more tasks, which adaptive execution must not merge by the rows' size
    tasks = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * -(-len(src) // 5)
    long_ = df.repartition(tasks, group).select(group, ROW_ID, F.inline(pairs))
    wg = Window.partitionBy(group, "k")
    wo = wg.orderBy(F.col("x").asc_nulls_last())
    x = F.col("x")
    n = F.count(x).over(wg)
    r = F.rank().over(wo)
    ties = F.count(F.lit(1)).over(wo.rangeBetween(Window.currentRow, Window.currentRow))
    mean = F.avg(x).over(wg)
    std = F.stddev_samp(x).over(wg)
    present = x.isNotNull()
    feats = long_.select(
        group, ROW_ID, "k", "_row",
        (x - mean).alias("mean_diff"), (x - F.median(x).over(wg)).alias("median_diff"),
        (x - F.min(x).over(wg)).alias("min_diff"), (x - F.max(x).over(wg)).alias("max_diff"),
        safe_divide(x - mean, F.when(std != 0, std), 0.0).alias("zscore"),
        F.when(present, (r + (ties - 1) / 2.0) / n).alias("pct_rank"),
        F.when(present, r.cast("double")).alias("rank_asc"),
        F.when(present, (n - r - ties + 2).cast("double")).alias("rank_desc"))
    names = ["mean_diff", "median_diff", "min_diff", "max_diff", "zscore", "pct_rank", "rank_asc", "rank_desc"]
    rows = feats.groupBy(group, ROW_ID).agg(F.first("_row", ignorenulls=True).alias("_row"),
                                            F.map_from_entries(F.collect_list(F.struct("k", F.struct(*names)))).alias("_m"))
    own = [ROW_ID, *[c for c in df.columns if c != ROW_ID]]
    out = rows.selectExpr(*[f"`_row`.`{c}` AS `{c}`" if c in others else f"`{c}`" for c in own],
                          *[f"_m[{i}].`{nm}` AS `{c}_srch_{nm}`" for i, c in enumerate(src) for nm in names])
    return add_best_in_search_flags(out)


def add_best_in_search_flags(df: DataFrame) -> DataFrame:
    """price_order, cheapest, most expensive, best review, best value."""
    cols = set(df.columns)
    new = []
    if "price_usd_srch_rank_asc" in cols:
        new += [F.col("price_usd_srch_rank_asc").alias("price_order"),
                flag(F.col("price_usd_srch_rank_asc") == 1).alias("price_is_cheapest")]
    if "price_usd_srch_rank_desc" in cols:
        new.append(flag(F.col("price_usd_srch_rank_desc") == 1).alias("price_is_most_expensive"))
    if "prop_review_score_srch_rank_desc" in cols:
        new.append(flag(F.col("prop_review_score_srch_rank_desc") == 1).alias("review_is_best_in_search"))
    if "value_score_srch_rank_desc" in cols:
        new.append(flag(F.col("value_score_srch_rank_desc") == 1).alias("value_is_best_in_search"))
    return df.select("*", *new) if new else df


def score_ranks(df: DataFrame, score_cols: list[str], group: str = GROUP_COL) -> DataFrame:
    """``<score>_rank_pct`` average percentile rank per score column."""
    return df.select("*", *[pct_rank_average(s, group).alias(f"{s}_rank_pct") for s in score_cols])


def top_k(df: DataFrame, order: list[Column], k: int, group: str = GROUP_COL,
          name: str = "rank_in_group") -> DataFrame:
    """First k rows per group in ``order`` plus the running rank (cumcount+1).

    ``row_number() <= k`` is planned as WindowGroupLimit (pre-shuffle pruning).
    """
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def relative_diagnostics(df: DataFrame, cols: list[str], group: str = GROUP_COL) -> DataFrame:
    """Asc and desc pct ranks and deltas to the search mean/median."""
    stats = df.groupBy(group).agg(*[e for c in cols for e in (
        F.avg(dbl(c)).alias(f"{c}_search_mean"), F.median(dbl(c)).alias(f"{c}_search_median"))])
    j = df.join(stats, group)
    new = []
    for c in cols:
        new += [pct_rank_average(c, group, True).alias(f"{c}_rank_pct_asc"),
                pct_rank_average(c, group, False).alias(f"{c}_rank_pct_desc"),
                (dbl(c) - F.col(f"{c}_search_mean")).alias(f"{c}_diff_mean"),
                (dbl(c) - F.col(f"{c}_search_median")).alias(f"{c}_diff_median")]
    if "price_usd" in df.columns:
        log_price = F.log1p(clip_lower(dbl("price_usd"), 0.0))
        new.append(log_price.alias("log_price_usd"))
        new += [safe_divide(F.col(c), F.when(log_price != 0, log_price), None).alias(name) for c, name in (
            ("prop_starrating", "value_star_per_log_price"), ("prop_review_score", "value_review_per_log_price")) if c in df.columns]
    return j.select("*", *new)
