"""Ranking evaluation, baselines and blend tuning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blend, folds as fo, metrics
from .catalog import labeled, register, round_doubles
from .oracle import ndcg_ctes, with_base
from .queries_fitted import _FOLD_CTE
from ..operators.fitted import with_globals
from ..session import materialize


def _u(seed: int):
    return F.conv(F.substring(F.md5(F.concat(F.col("row_id").cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10) \
        .cast("double") / float(16 ** 8)


def _u_sql(seed: int) -> str:
    return f"(CAST(('0x' || substr(md5(concat(CAST(row_id AS VARCHAR), ':{seed}')), 1, 8)) AS BIGINT) / {float(16 ** 8)})"


def scored(spark, sf):
    """Labeled log with three synthetic scores: two noisy labels and a price order."""
    return labeled(spark, sf).select(
        "*", (F.col("relevance") + 2.0 * _u(1)).alias("s_a"),
        (F.col("relevance") * 0.5 + 3.0 * _u(2)).alias("s_b"),
        (-F.col("price_usd")).alias("s_c"))


_SCORED = (f"scored AS (SELECT *, relevance + 2.0 * {_u_sql(1)} AS s_a, relevance * 0.5 + 3.0 * {_u_sql(2)} AS s_b, "
           "-price_usd AS s_c FROM labeled)")


def _pct_sql(c, src_alias=""):
    p = "PARTITION BY srch_id"
    return (f"(rank() OVER ({p} ORDER BY {c}) + (count(*) OVER ({p}, {c}) - 1) / 2.0) / count({c}) OVER ({p})")


@register("e1_dcg_per_search", with_base(
    _SCORED, f"rk AS (SELECT srch_id, relevance, row_number() OVER (PARTITION BY srch_id ORDER BY s_a DESC, row_id) AS rn FROM scored)",
    select="SELECT srch_id, round(sum(CASE WHEN rn <= 5 THEN (pow(2, relevance) - 1) / log2(rn + 1) ELSE 0 END), 6) AS dcg "
           "FROM rk GROUP BY srch_id"))
def e1_dcg_per_search(spark, sf):
    df = scored(spark, sf)
    return round_doubles(metrics.dcg_by_group(df, [F.col("s_a").desc(), F.col("row_id")], k=5))


@register("e2_mean_ndcg", with_base(
    _SCORED, *ndcg_ctes("scored", "s_a", "a"), *ndcg_ctes("scored", "s_b", "b"), *ndcg_ctes("scored", "s_c", "c"),
    select="SELECT round((SELECT avg(ndcg) FROM a_per), 6) AS ndcg_s_a, round((SELECT avg(ndcg) FROM b_per), 6) AS ndcg_s_b, "
           "round((SELECT avg(ndcg) FROM c_per), 6) AS ndcg_s_c"))
def e2_mean_ndcg(spark, sf):
    df = scored(spark, sf)
    a = metrics.mean_ndcg(df, "s_a", name="ndcg_s_a").select("ndcg_s_a")
    b = metrics.mean_ndcg(df, "s_b", name="ndcg_s_b").select("ndcg_s_b")
    c = metrics.mean_ndcg(df, "s_c", name="ndcg_s_c").select("ndcg_s_c")
    return round_doubles(with_globals(with_globals(a, b), c))


_VAL = [
    "g AS (SELECT srch_id, min(date_time) AS t FROM labeled GROUP BY srch_id)",
    "r AS (SELECT srch_id, row_number() OVER (ORDER BY t DESC, srch_id DESC) AS rn, count(*) OVER () AS n FROM g)",
    "v AS (SELECT srch_id FROM r WHERE rn <= CAST(floor(n * 0.2) AS BIGINT))",
    "fit AS (SELECT * FROM labeled WHERE srch_id NOT IN (SELECT srch_id FROM v))",
    "val AS (SELECT * FROM labeled WHERE srch_id IN (SELECT srch_id FROM v))",
]


def _split(spark, sf):
    log = labeled(spark, sf)
    flags = fo.split_groups(log, "time", 0.2, seed=0, min_one=False)
    ids = flags.filter("is_valid").select("srch_id")
    return log.join(ids, "srch_id", "left_anti"), log.join(ids, "srch_id", "left_semi")


@register("e3_position_ndcg", with_base(*_VAL, *ndcg_ctes("val", "position", "p", desc=False),
                                        select="SELECT round(avg(ndcg), 6) AS ndcg_at_5, count(*) AS groups FROM p_per"))
def e3_position_ndcg(spark, sf):
    _, val = _split(spark, sf)
    return round_doubles(metrics.mean_ndcg(val, "position", ascending=True))


def _e4_sql():
    parts = []
    ctes = [_SCORED, "seg AS (SELECT *, max(booking_bool) OVER (PARTITION BY srch_id) AS query_has_booking, "
            "month(date_time) AS search_month FROM scored)"]
    for segc in ("random_bool", "search_month", "query_has_booking"):
        for sc in ("s_a", "s_b"):
            pre = f"{segc[:3]}{sc}"
            ctes.append(f"{pre}_rk AS (SELECT CAST({segc} AS VARCHAR) AS sv, srch_id, relevance AS rel, "
                        f"row_number() OVER (PARTITION BY {segc}, srch_id ORDER BY {sc} DESC, row_id) AS rn, "
                        f"row_number() OVER (PARTITION BY {segc}, srch_id ORDER BY relevance DESC, row_id) AS irn FROM seg)")
            ctes.append(f"{pre}_per AS (SELECT sv, srch_id, sum(CASE WHEN rn <= 5 THEN (pow(2, rel) - 1) / log2(rn + 1) ELSE 0 END) AS dcg, "
                        f"sum(CASE WHEN irn <= 5 THEN (pow(2, rel) - 1) / log2(irn + 1) ELSE 0 END) AS idcg FROM {pre}_rk GROUP BY sv, srch_id)")
            parts.append(f"SELECT '{segc}' AS segment, sv AS value, '{sc}' AS score_col, "
                         f"round(avg(CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END), 6) AS ndcg, count(*) AS groups FROM {pre}_per GROUP BY sv")
    return with_base(*ctes, select=" UNION ALL ".join(parts))


@register("e4_segment_ndcg", _e4_sql())
def e4_segment_ndcg(spark, sf):
    df = metrics.add_query_has_booking(scored(spark, sf)).withColumn("search_month", F.month("date_time"))
    return round_doubles(metrics.segment_ndcg(df, ["s_a", "s_b"], ["random_bool", "search_month", "query_has_booking"]))


@register("e6_weighted_rank_average", with_base(_SCORED, select=(
    f"SELECT row_id, round((0.55 * {_pct_sql('s_a')} + 0.30 * {_pct_sql('s_b')} + 0.15 * {_pct_sql('s_c')}) / 1.0, 6) "
    "AS rank_average FROM scored")))
def e6_weighted_rank_average(spark, sf):
    out = blend.weighted_rank_average(scored(spark, sf), ["s_a", "s_b", "s_c"], [0.55, 0.30, 0.15])
    return round_doubles(out.select("row_id", "rank_average"))


def _grid_sql(src_cte: str, cols: list[str], u: int):
    m = len(cols)
    rng = ", ".join(f"range(0, {u + 1}) AS g{i}(u)" for i in range(m))
    us = ", ".join(f"g{i}.u AS u{i + 1}" for i in range(m))
    order = ", ".join(f"g{i}.u" for i in range(m))
    tot = " + ".join(f"g{i}.u" for i in range(m))
    blend_expr = " + ".join(f"u{i + 1} * p{i}" for i in range(m))
    ws = ", ".join(f"u{i + 1} / {float(u)} AS w{i + 1}" for i in range(m))
    return [
        src_cte,
        "pr AS (SELECT srch_id, row_id, relevance, " + ", ".join(f"{_pct_sql(c)} AS p{i}" for i, c in enumerate(cols)) + " FROM src)",
        "irk AS (SELECT srch_id, relevance, row_number() OVER (PARTITION BY srch_id ORDER BY relevance DESC, row_id) AS irn FROM pr)",
        "idc AS (SELECT srch_id, sum(CASE WHEN irn <= 5 THEN (pow(2, relevance) - 1) / log2(irn + 1) ELSE 0 END) AS idcg FROM irk GROUP BY srch_id)",
        "live AS (SELECT pr.*, idc.idcg FROM pr JOIN idc USING (srch_id) WHERE idc.idcg > 0)",
        f"grid AS (SELECT row_number() OVER (ORDER BY {order}) AS wid, {us} FROM {rng} WHERE {tot} = {u})",
        f"x AS (SELECT wid, srch_id, relevance, idcg, row_number() OVER (PARTITION BY wid, srch_id ORDER BY "
        f"round(({blend_expr}) / {float(u)}, 9) DESC, row_id) AS rn FROM live CROSS JOIN grid)",
        "d AS (SELECT wid, srch_id, sum(CASE WHEN rn <= 5 THEN (pow(2, relevance) - 1) / log2(rn + 1) ELSE 0 END) / max(idcg) AS nd "
        "FROM x GROUP BY wid, srch_id)",
        f"gs AS (SELECT grid.wid, {ws}, coalesce(sum(d.nd), 0) / (SELECT count(*) FROM idc) AS ndcg FROM grid "
        f"LEFT JOIN d USING (wid) GROUP BY grid.wid, {', '.join(f'u{i + 1}' for i in range(m))})",
    ]


_E8 = _grid_sql(f"src AS (SELECT * FROM scored)", ["s_a", "s_b", "s_c"], 20)


@register("e8_weight_grid_table", with_base(_SCORED, *_E8, select=(
    "SELECT wid, round(w1, 6) AS w1, round(w2, 6) AS w2, round(w3, 6) AS w3, round(ndcg, 6) AS ndcg FROM gs")))
def e8_weight_grid_table(spark, sf):
    return round_doubles(blend.grid_ndcg(scored(spark, sf), ["s_a", "s_b", "s_c"], 0.05))


_E7 = _grid_sql(f"src AS (SELECT * FROM scored)", ["s_a", "s_b", "s_c"], 10)


@register("e5_e7_tune_weights", with_base(_SCORED, *_E7, select=(
    "SELECT wid, round(w1, 6) AS w1, round(w2, 6) AS w2, round(w3, 6) AS w3, round(ndcg, 6) AS ndcg FROM gs "
    "ORDER BY round(ndcg, 12) DESC, wid LIMIT 1")))
def e5_e7_tune_weights(spark, sf):
    return round_doubles(blend.best_weights(blend.grid_ndcg(scored(spark, sf), ["s_a", "s_b", "s_c"], 0.1)))


_E9_SRC = ("src AS (SELECT *, round((0.75 * " + _pct_sql("s_a") + " + 0.25 * " + _pct_sql("s_c") + ") / 1.0, 9) AS stage1 FROM scored)")
_E9 = _grid_sql(_E9_SRC, ["stage1", "s_b"], 20)


@register("e9_two_stage_grid", with_base(_SCORED, *_E9, select=(
    "SELECT wid, round(w1, 6) AS w1, round(w2, 6) AS w2, round(ndcg, 6) AS ndcg FROM gs")))
def e9_two_stage_grid(spark, sf):
    st1 = blend.weighted_rank_average(scored(spark, sf), ["s_a", "s_c"], [0.75, 0.25], name="stage1")
    st1 = st1.withColumn("stage1", F.round("stage1", 9))  # blend ties compared after rounding (T15)
    return round_doubles(blend.grid_ndcg(st1, ["stage1", "s_b"], 0.05))


# ---- out-of-fold popularity scores (E12, E13) -------------------------------------
def _oof_popularity(spark, sf):
    # stored: every fold's table and rows are made of it
    log = materialize(labeled(spark, sf).select("srch_id", "row_id", "prop_id", "relevance"), "log")
    folds = fo.group_folds(log, 5, 2026)
    lf = materialize(fo.attach_folds(log, folds), "folds")
    parts = []
    for f in range(5):
        fit, hold = lf.filter(F.col("fold") != f), lf.filter(F.col("fold") == f)
        parts.append(materialize(metrics.popularity_score(fit, hold, "prop_id", alpha=100.0, name="oof_pop_score")
                                 .select("srch_id", "row_id", "fold", "relevance", "oof_pop_score"), "oof"))
    return blend.assemble_oof(parts, log.count(), ["oof_pop_score"])


_OOF = [
    _FOLD_CTE.replace("FROM train", "FROM labeled"),
    "lf AS (SELECT labeled.*, fv.fold FROM labeled JOIN fv USING (srch_id))",
    "pf AS (SELECT fold, sum(relevance) AS s, count(*) AS n FROM lf GROUP BY fold)",
    "tot AS (SELECT sum(relevance) AS s, count(*) AS n FROM lf)",
    "kp AS (SELECT prop_id, sum(relevance) AS s, count(*) AS n FROM lf GROUP BY prop_id)",
    "kpf AS (SELECT prop_id, fold, sum(relevance) AS s, count(*) AS n FROM lf GROUP BY prop_id, fold)",
    "oof AS (SELECT lf.srch_id, lf.row_id, lf.fold, lf.relevance, "
    "CASE WHEN kp.n - coalesce(kpf.n, 0) > 0 THEN ((kp.s - coalesce(kpf.s, 0)) + (tot.s - pf.s) / (tot.n - pf.n) * 100.0) "
    "/ ((kp.n - coalesce(kpf.n, 0)) + 100.0) ELSE (tot.s - pf.s) / (tot.n - pf.n) END AS oof_pop_score "
    "FROM lf JOIN pf ON lf.fold = pf.fold CROSS JOIN tot JOIN kp ON lf.prop_id = kp.prop_id "
    "LEFT JOIN kpf ON lf.prop_id = kpf.prop_id AND lf.fold = kpf.fold)",
]


@register("e12_oof_score_assembly", with_base(*_OOF, select=(
    "SELECT row_id, CAST(fold AS BIGINT) AS fold, round(oof_pop_score, 6) AS oof_pop_score FROM oof")))
def e12_oof_score_assembly(spark, sf):
    return round_doubles(_oof_popularity(spark, sf).select("row_id", "fold", "oof_pop_score"))


@register("e13_fold_metric_table", with_base(
    *_OOF, *ndcg_ctes("oof", "oof_pop_score", "m", group="fold, srch_id"),
    select=("SELECT CAST(o.fold AS BIGINT) AS fold, o.rows, o.groups, round(p.ndcg, 6) AS ndcg_at_5 FROM "
            "(SELECT fold, count(*) AS rows, count(DISTINCT srch_id) AS groups FROM oof GROUP BY fold) o "
            "JOIN (SELECT fold, avg(ndcg) AS ndcg FROM m_per GROUP BY fold) p USING (fold)")))
def e13_fold_metric_table(spark, sf):
    oof = _oof_popularity(spark, sf)
    sizes = oof.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("srch_id").alias("groups"))
    per = metrics.ndcg_by_group(oof, "oof_pop_score", group=["fold", "srch_id"])
    nd = per.groupBy("fold").agg(F.avg("ndcg").alias("ndcg_at_5"))
    return round_doubles(sizes.join(nd, "fold"))


@register("e14_random_baseline", with_base(
    *_VAL, f"rs AS (SELECT *, {_u_sql(42)} AS random_score FROM val)", *ndcg_ctes("rs", "random_score", "q"),
    select="SELECT round(avg(ndcg), 6) AS ndcg_at_5, count(*) AS groups FROM q_per"))
def e14_random_baseline(spark, sf):
    _, val = _split(spark, sf)
    return round_doubles(metrics.mean_ndcg(metrics.random_score(val, 42), "random_score"))


def _heur_sql(src):
    p = "PARTITION BY srch_id"

    def pr(c, d):
        return (f"CASE WHEN {c} IS NOT NULL THEN (rank() OVER ({p} ORDER BY {c} {d} NULLS LAST) + "
                f"(count(*) OVER ({p}, {c}) - 1) / 2.0) / count({c}) OVER ({p}) END")
    return (f"hs AS (SELECT *, 0.20 * (1 - coalesce({pr('price_usd', 'ASC')}, 0.5)) + 0.25 * coalesce({pr('prop_starrating', 'DESC')}, 0.5) "
            f"+ 0.25 * coalesce({pr('prop_review_score', 'DESC')}, 0.5) + 0.20 * coalesce({pr('prop_location_score1', 'DESC')}, 0.5) "
            f"+ 0.05 * coalesce({pr('prop_location_score2', 'DESC')}, 0.5) + 0.05 * coalesce(CAST(promotion_flag AS DOUBLE), 0) "
            f"AS heuristic_score FROM {src})")


@register("e16_heuristic_baseline", with_base(
    *_VAL, _heur_sql("val"), *ndcg_ctes("hs", "round(heuristic_score, 9)", "h"),
    select="SELECT round(avg(ndcg), 6) AS ndcg_at_5, count(*) AS groups FROM h_per"))
def e16_heuristic_baseline(spark, sf):
    _, val = _split(spark, sf)
    hs = metrics.heuristic_score(val).withColumn("heuristic_score", F.round("heuristic_score", 9))
    return round_doubles(metrics.mean_ndcg(hs, "heuristic_score"))


@register("e17_baseline_table", with_base(
    *_VAL, f"rs AS (SELECT *, {_u_sql(42)} AS random_score FROM val)", _heur_sql("val"),
    "gstat AS (SELECT avg(relevance) AS gm FROM fit)",
    "pop AS (SELECT prop_id, (avg(relevance) * count(*) + (SELECT gm FROM gstat) * 100) / (count(*) + 100) AS s FROM fit GROUP BY prop_id)",
    "ps AS (SELECT val.*, coalesce(pop.s, (SELECT gm FROM gstat)) AS score FROM val LEFT JOIN pop USING (prop_id))",
    *ndcg_ctes("val", "position", "p", desc=False), *ndcg_ctes("rs", "random_score", "q"),
    *ndcg_ctes("ps", "score", "o"), *ndcg_ctes("hs", "round(heuristic_score, 9)", "h"),
    select=("SELECT 'train display position (diagnostic/leaky)' AS baseline, round(avg(ndcg), 6) AS ndcg_at_5 FROM p_per "
            "UNION ALL SELECT 'random', round(avg(ndcg), 6) FROM q_per UNION ALL SELECT 'property popularity', round(avg(ndcg), 6) FROM o_per "
            "UNION ALL SELECT 'simple relative heuristic', round(avg(ndcg), 6) FROM h_per")))
def e17_baseline_table(spark, sf):
    fit, val = _split(spark, sf)
    rows = [
        ("train display position (diagnostic/leaky)", metrics.mean_ndcg(val, "position", ascending=True)),
        ("random", metrics.mean_ndcg(metrics.random_score(val, 42), "random_score")),
        ("property popularity", metrics.mean_ndcg(metrics.popularity_score(fit, val, name="score"), "score")),
        ("simple relative heuristic", metrics.mean_ndcg(
            metrics.heuristic_score(val).withColumn("heuristic_score", F.round("heuristic_score", 9)), "heuristic_score")),
    ]
    out = None
    for name, df in rows:
        part = df.select(F.lit(name).alias("baseline"), "ndcg_at_5")
        out = part if out is None else out.unionByName(part)
    return round_doubles(out.orderBy(F.col("ndcg_at_5").desc()))
