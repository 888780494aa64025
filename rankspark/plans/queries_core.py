"""Flagship slice: label -> time split -> popularity table -> lookup -> NDCG@5."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import folds, metrics
from .catalog import labeled, register, round_doubles
from .oracle import ndcg_ctes, with_base

_E15_SQL = with_base(
    "g AS (SELECT srch_id, min(date_time) AS t FROM labeled GROUP BY srch_id)",
    "r AS (SELECT srch_id, row_number() OVER (ORDER BY t DESC, srch_id DESC) AS rn, count(*) OVER () AS n FROM g)",
    "v AS (SELECT srch_id FROM r WHERE rn <= CAST(floor(n * 0.2) AS BIGINT))",
    "fit AS (SELECT * FROM labeled WHERE srch_id NOT IN (SELECT srch_id FROM v))",
    "val AS (SELECT * FROM labeled WHERE srch_id IN (SELECT srch_id FROM v))",
    "gstat AS (SELECT avg(relevance) AS gm FROM fit)",
    "pop AS (SELECT prop_id, (avg(relevance) * count(*) + (SELECT gm FROM gstat) * 100) / (count(*) + 100) AS s "
    "FROM fit GROUP BY prop_id)",
    "sc AS (SELECT val.*, coalesce(pop.s, (SELECT gm FROM gstat)) AS score FROM val LEFT JOIN pop USING (prop_id))",
    *ndcg_ctes("sc", "score"),
    select="SELECT round(avg(ndcg), 6) AS ndcg_at_5, count(*) AS groups FROM n_per",
)


@register("e15_popularity_ndcg", _E15_SQL)
def e15_popularity_ndcg(spark, sf):
    """Item popularity (alpha 100) fitted on the earliest 80% of searches,
    scored on the latest 20% (time split, n_valid = int(0.2 n))."""
    log = labeled(spark, sf)
    flags = folds.split_groups(log, "time", 0.2, seed=0, min_one=False)
    valid_ids = flags.filter("is_valid").select("srch_id")
    fit = log.join(valid_ids, "srch_id", "left_anti")
    val = log.join(valid_ids, "srch_id", "left_semi")
    scored = metrics.popularity_score(fit, val, "prop_id", alpha=100.0, name="score")
    return round_doubles(metrics.mean_ndcg(scored, "score"))
