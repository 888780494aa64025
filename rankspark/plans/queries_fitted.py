"""Fitted tables and lookups (A1-A12, J1-J8) fit on train, applied to test
(or out-of-fold on train), each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encodings as enc
from ..operators import fitted as ft
from ..operators import folds as fo
from ..operators import row_features as rf
from ..session import drop_stored, materialize, release_shuffles
from ..sources.tables import test_frame, train_frame
from ..specs import AFFINITY_KEY_SPECS, BUCKET_CROSS_KEY_SPECS, BUCKET_SOURCE_SPECS, CROSS_KEY_SPECS, FREQUENCY_KEY_SPECS, MISSING_VALUE_FEATURE_COLS, POSITION_AGG_KEY_SPECS, \
    PROP_PROFILE_DELTA_COLS, PROP_PROFILE_SOURCE_COLS, TARGET_KEY_SPECS
from .catalog import labeled, register, round_doubles, test, train
from .oracle import with_base
from .queries_rows import _F3_EXPRS

ALPHA = 40.0
SEED = 2026
_FOLD_CTE = ("fv AS (SELECT srch_id, CAST((row_number() OVER (ORDER BY md5(concat(CAST(srch_id AS VARCHAR), ':2026')), "
             "srch_id) - 1) % 5 AS INTEGER) AS fold FROM (SELECT DISTINCT srch_id FROM train))")

# composite keys: name -> parts
_PAIRS = dict(CROSS_KEY_SPECS) | dict(BUCKET_CROSS_KEY_SPECS)
_EXT = ", ".join(f"{_F3_EXPRS[c]} AS {c}" for c in ("price_per_night", "price_per_room_night"))


def _edge_ctes():
    """Frames ``trk`` and ``tek``: train and test with trip values and all fitted buckets."""
    ctes = [f"trx AS (SELECT *, {_EXT} FROM train)", f"tex AS (SELECT *, {_EXT} FROM test)"]
    sel = []
    for i, (c, b, n) in enumerate(BUCKET_SOURCE_SPECS):
        qs = ", ".join(str(j / n) for j in range(1, n))
        ctes.append(f"e{i} AS (SELECT list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), [{qs}]))) AS edges FROM trx)")
        sel.append(f"CAST(CASE WHEN t.{c} IS NULL THEN -1 ELSE len(list_filter(e{i}.edges, lambda e: e <= CAST(t.{c} AS DOUBLE))) END AS BIGINT) AS {b}")
    joins = " ".join(f"CROSS JOIN e{i}" for i in range(len(BUCKET_SOURCE_SPECS)))
    return ctes + [f"{k} AS MATERIALIZED (SELECT t.*, {', '.join(sel)} FROM {x} t {joins})" for k, x in (("trk", "trx"), ("tek", "tex"))]


def _stored_log(spark, sf, names, make=lambda d: d):
    """Train and test with the named columns of ``make(log)``, of one narrow table stored before anything reads it; the shuffles
    of the log's joins go with it."""
    log = make(labeled(spark, sf))
    stored = materialize(log.select(*[c for c in log.columns if c in {"row_id", "srch_id", *names}]), "log")
    release_shuffles(spark)
    return stored, train_frame(stored), test_frame(stored).drop("relevance", "dcg_gain")


def _keyed(spark, sf):
    """Train and test with trip values, all fitted buckets and all composite keys.  Stored are rows of numbers without the buckets'
    sources; composite keys are made of their parts where they are read."""
    parts = [p for cols in dict(CROSS_KEY_SPECS).values() for p in cols]
    sources = [c for c, _, _ in BUCKET_SOURCE_SPECS]
    log, tr, te = _stored_log(spark, sf, ["position", "random_bool", *(t for t, _ in _TS), *sources, *parts], rf.add_trip_and_value_features)
    kept = [materialize(d.drop(*sources), "keyed") for d in ft.add_fit_buckets(tr, [tr, te])]
    drop_stored(log)
    return [rf.add_bucket_cross_keys(rf.add_cross_keys(d)) for d in kept]


def _cols(key):
    return list(_PAIRS[key]) if key in _PAIRS else [key]


def _on(a, b, key):
    cs = _cols(key)
    if key in _PAIRS:
        return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cs)
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in cs)


def _with_parts(specs):
    """Keys and the columns that composite ones are made of."""
    return dict.fromkeys(c for k, _ in specs for c in (*_cols(k), k))


def _with_keys(df):
    return rf.add_cross_keys(df)


# ---- A5 frequency ---------------------------------------------------------------
_A5_KEYS = FREQUENCY_KEY_SPECS


def _a5_sql():
    ctes, sel, joins = _edge_ctes(), [], []
    for i, (k, a) in enumerate(_A5_KEYS):
        cs = ", ".join(_cols(k))
        ctes.append(f"c{i} AS (SELECT {cs}, count(*) AS n FROM trk GROUP BY {cs})")
        joins.append(f"LEFT JOIN c{i} ON {_on('t', f'c{i}', k)}")
        sel.append(f"round(ln(1 + coalesce(c{i}.n, 0)), 6) AS {a}_log_frequency")
    return with_base(*ctes, select=f"SELECT t.row_id, {', '.join(sel)} FROM tek t {' '.join(joins)}")


@register("a5_frequency_encoding", _a5_sql())
def a5_frequency_encoding(spark, sf):
    tr, te = _keyed(spark, sf)
    tr, te = (d.select("row_id", *_with_parts(_A5_KEYS)) for d in (tr, te))
    out = ft.add_frequency_features(tr, [te], _A5_KEYS)[0]
    return round_doubles(out.select("row_id", *[f"{a}_log_frequency" for _, a in _A5_KEYS]))


# ---- A6 affinity ----------------------------------------------------------------
def _a6_sql():
    ctes = ["nf AS (SELECT CAST(greatest(count(*), 1) AS DOUBLE) AS n FROM train)"]
    sel, joins = [], []
    for i, (a, l, r) in enumerate(AFFINITY_KEY_SPECS):
        ctes += [f"x{i} AS (SELECT {l}, {r}, count(*) AS c FROM train GROUP BY {l}, {r})",
                 f"l{i} AS (SELECT {l}, count(*) AS c FROM train GROUP BY {l})",
                 f"r{i} AS (SELECT {r}, count(*) AS c FROM train GROUP BY {r})"]
        joins += [f"LEFT JOIN x{i} ON t.{l} IS NOT DISTINCT FROM x{i}.{l} AND t.{r} IS NOT DISTINCT FROM x{i}.{r}",
                  f"LEFT JOIN l{i} ON t.{l} = l{i}.{l}", f"LEFT JOIN r{i} ON t.{r} = r{i}.{r}"]
        c, lc, rc = f"CAST(coalesce(x{i}.c, 0) AS DOUBLE)", f"CAST(coalesce(l{i}.c, 0) AS DOUBLE)", f"CAST(coalesce(r{i}.c, 0) AS DOUBLE)"
        sel += [f"round(ln(1 + {c}), 6) AS {a}_log_count",
                f"round(coalesce({c} / NULLIF({lc}, 0), 0), 6) AS {a}_left_share",
                f"round(coalesce({c} / NULLIF({rc}, 0), 0), 6) AS {a}_right_share",
                f"round(({c} + 1) / ({lc} * {rc} / nf.n + 1), 6) AS {a}_lift"]
    return with_base(*ctes, select=f"SELECT t.row_id, {', '.join(sel)} FROM test t CROSS JOIN nf {' '.join(joins)}")


@register("a6_context_affinity", _a6_sql())
def a6_context_affinity(spark, sf):
    out = ft.add_affinity_features(train(spark, sf), [test(spark, sf)])[0]
    names = [f"{a}_{s}" for a, _, _ in AFFINITY_KEY_SPECS for s in ("log_count", "left_share", "right_share", "lift")]
    return round_doubles(out.select("row_id", *names))


# ---- A7 / A8 target encoding ----------------------------------------------------
_TS = [("relevance", "relevance"), ("dcg_gain", "gain"), ("booking_bool", "booking"), ("click_bool", "click")]


def _te_prior_cte(name="pr", src="train"):
    return f"{name} AS (SELECT " + ", ".join(f"avg(CAST({t} AS DOUBLE)) AS p_{s}" for t, s in _TS) + f" FROM {src})"


def _te_exprs(sum_, n, pri, alias, matched="TRUE"):
    bpc = f"coalesce({pri}.p_booking / NULLIF({pri}.p_click, 0), 0)"
    out = [f"round(CASE WHEN {matched} THEN ({sum_('relevance')} + {pri}.p_relevance * {ALPHA}) / ({n} + {ALPHA}) "
           f"ELSE {pri}.p_relevance END, 6) AS {alias}_relevance_te"]
    for _, s in _TS[1:]:
        out.append(f"round(CASE WHEN {matched} THEN ({sum_(s)} + {pri}.p_{s} * {ALPHA}) / ({n} + {ALPHA}) "
                   f"ELSE {pri}.p_{s} END, 6) AS {alias}_{s}_te")
    out.append(f"round(CASE WHEN {matched} THEN ({sum_('booking')} + {bpc} * {ALPHA}) / ({sum_('click')} + {ALPHA}) "
               f"ELSE {bpc} END, 6) AS {alias}_booking_per_click_te")
    return out


def _sums_cte(name, key, src="train", extra=""):
    cs = ", ".join(_cols(key)) + extra
    return (f"{name} AS (SELECT {cs}, " + ", ".join(f"sum(CAST({t} AS DOUBLE)) AS s_{s}" for t, s in _TS)
            + f", count(*) AS n FROM {src} GROUP BY {cs})")


@register("a7_target_encoding_table", with_base(
    _te_prior_cte(), _sums_cte("st", "prop_id"),
    select="SELECT st.prop_id, " + ", ".join(_te_exprs(lambda s: f"st.s_{s}", "st.n", "pr", "prop"))
           + ", st.n AS prop_te_count FROM st CROSS JOIN pr"))
def a7_target_encoding_table(spark, sf):
    table, _ = enc.fit_target_encoding_table(train(spark, sf), "prop_id", "prop", ALPHA)
    return round_doubles(table)


_A8_KEYS = TARGET_KEY_SPECS


def _a8_sql():
    ctes, sel, joins = [*_edge_ctes(), _te_prior_cte()], [], []
    for i, (k, a) in enumerate(_A8_KEYS):
        ctes.append(_sums_cte(f"s{i}", k, "trk"))
        joins.append(f"LEFT JOIN s{i} ON {_on('t', f's{i}', k)}")
        sel += _te_exprs(lambda s, i=i: f"s{i}.s_{s}", f"s{i}.n", "pr", a, f"s{i}.n IS NOT NULL")
        sel.append(f"round(ln(1 + coalesce(s{i}.n, 0)), 6) AS {a}_te_log_count")
    return with_base(*ctes, select=f"SELECT t.row_id, {', '.join(sel)} FROM tek t CROSS JOIN pr {' '.join(joins)}")


@register("a8_apply_target_encoding", _a8_sql())
def a8_apply_target_encoding(spark, sf):
    tr, te = _keyed(spark, sf)
    out = enc.add_fit_target_encodings(tr, [te], ALPHA, _A8_KEYS)[0]
    return round_doubles(out.select("row_id", *[n for _, a in _A8_KEYS for n in enc.te_feature_names(a)]))


# ---- A9 out-of-fold target encoding --------------------------------------------
_A9_KEYS = TARGET_KEY_SPECS


def _a9_sql():
    ctes = [*_edge_ctes(), _FOLD_CTE, "tf AS (SELECT trk.*, fv.fold FROM trk JOIN fv USING (srch_id))",
            "tot AS (SELECT " + ", ".join(f"sum(CAST({t} AS DOUBLE)) AS T_{s}" for t, s in _TS) + ", count(*) AS N FROM tf)",
            "pf AS (SELECT fold, " + ", ".join(f"sum(CAST({t} AS DOUBLE)) AS F_{s}" for t, s in _TS) + ", count(*) AS NF FROM tf GROUP BY fold)",
            "fp AS (SELECT pf.fold, " + ", ".join(f"(tot.T_{s} - pf.F_{s}) / (tot.N - pf.NF) AS p_{s}" for _, s in _TS)
            + " FROM pf CROSS JOIN tot)"]
    sel, joins = [], []
    for i, (k, a) in enumerate(_A9_KEYS):
        ctes.append(_sums_cte(f"k{i}", k, "tf"))
        ctes.append(_sums_cte(f"kf{i}", k, "tf", ", fold"))
        joins.append(f"LEFT JOIN k{i} ON {_on('t', f'k{i}', k)}")
        joins.append(f"LEFT JOIN kf{i} ON {_on('t', f'kf{i}', k)} AND t.fold = kf{i}.fold")
        n = f"CAST(coalesce(k{i}.n, 0) - coalesce(kf{i}.n, 0) AS DOUBLE)"
        sel += _te_exprs(lambda s, i=i: f"(coalesce(k{i}.s_{s}, 0) - coalesce(kf{i}.s_{s}, 0))", n, "fp", a, f"{n} > 0")
        sel.append(f"round(ln(1 + {n}), 6) AS {a}_te_log_count")
    return with_base(*ctes, select=f"SELECT t.row_id, {', '.join(sel)} FROM tf t JOIN fp ON t.fold = fp.fold {' '.join(joins)}")


@register("a9_oof_target_encoding", _a9_sql())
def a9_oof_target_encoding(spark, sf):
    tr = _keyed(spark, sf)[0]
    folds = fo.group_folds(tr, 5, SEED)
    out = enc.add_oof_target_encodings(tr.select("row_id", "srch_id", *[t for t, _ in _TS], *_with_parts(_A9_KEYS)), folds, ALPHA, _A9_KEYS)
    return round_doubles(out.select("row_id", *[n for _, a in _A9_KEYS for n in enc.te_feature_names(a)]))


# ---- A10-A12 position aggregates ---------------------------------------------------
_SRC = ("src AS (SELECT b.* FROM (SELECT * FROM train WHERE position IS NOT NULL) b, "
        "(SELECT max(CASE WHEN random_bool = 0 THEN 1 ELSE 0 END) AS a FROM train WHERE position IS NOT NULL) f "
        "WHERE coalesce(f.a, 0) = 0 OR b.random_bool = 0)")


def _pos_aggs(alias):
    return (f"avg(CAST(position AS DOUBLE)) AS {alias}_position_mean, median(CAST(position AS DOUBLE)) AS {alias}_position_median, "
            f"avg(CASE WHEN position <= 5 THEN 1.0 ELSE 0.0 END) AS {alias}_top5_rate, "
            f"avg(1.0 / CASE WHEN position < 1 THEN 1 ELSE position END) AS {alias}_reciprocal_position_mean, "
            f"ln(1 + count(*)) AS {alias}_position_count_log")


_POS_FEATS = ["position_mean", "position_median", "top5_rate", "reciprocal_position_mean", "position_count_log"]


@register("a10_position_table", with_base(_SRC, select=(
    "SELECT prop_id, " + ", ".join(f"round(prop_{f}, 6) AS prop_{f}" for f in _POS_FEATS)
    + f" FROM (SELECT prop_id, {_pos_aggs('prop')} FROM src GROUP BY prop_id)")))
def a10_position_table(spark, sf):
    table, _ = enc.fit_position_table(train(spark, sf), "prop_id", "prop")
    return round_doubles(table)


_A11_KEYS = POSITION_AGG_KEY_SPECS


def _a11_sql():
    ctes = [*_edge_ctes(), _SRC.replace("FROM train", "FROM trk"), f"pp AS (SELECT {_pos_aggs('g')} FROM src)"]
    sel, joins = [], []
    for i, (k, a) in enumerate(_A11_KEYS):
        cs = ", ".join(_cols(k))
        ctes.append(f"p{i} AS (SELECT {cs}, {_pos_aggs('x')} FROM src GROUP BY {cs})")
        joins.append(f"LEFT JOIN p{i} ON {_on('t', f'p{i}', k)}")
        for f in _POS_FEATS[:-1]:
            sel.append(f"round(coalesce(p{i}.x_{f}, pp.g_{f}, 0), 6) AS {a}_{f}")
        sel.append(f"round(coalesce(p{i}.x_position_count_log, 0), 6) AS {a}_position_count_log")
    return with_base(*ctes, select=f"SELECT t.row_id, {', '.join(sel)} FROM tek t CROSS JOIN pp {' '.join(joins)}")


@register("a11_apply_position_aggregates", _a11_sql())
def a11_apply_position_aggregates(spark, sf):
    tr, te = _keyed(spark, sf)
    out = enc.add_fit_position_aggregates(tr, [te], _A11_KEYS)[0]
    return round_doubles(out.select("row_id", *[f"{a}_{f}" for _, a in _A11_KEYS for f in _POS_FEATS]))


def _a12_sql():
    ctes = [*_edge_ctes(), _FOLD_CTE, "tf AS (SELECT trk.*, fv.fold FROM trk JOIN fv USING (srch_id))",
            "rep AS (SELECT tf.*, t.tf FROM tf JOIN (SELECT DISTINCT fold AS tf FROM fv) t ON t.tf <> tf.fold "
            "WHERE tf.position IS NOT NULL)",
            "anr AS (SELECT tf, max(CASE WHEN random_bool = 0 THEN 1 ELSE 0 END) AS a FROM rep GROUP BY tf)",
            "src AS (SELECT rep.* FROM rep JOIN anr USING (tf) WHERE anr.a = 0 OR rep.random_bool = 0)",
            f"pp AS (SELECT tf, {_pos_aggs('g')} FROM src GROUP BY tf)"]
    sel, joins = [], ["LEFT JOIN pp ON pp.tf = t.fold"]
    for i, (k, a) in enumerate(_A11_KEYS):
        cs = ", ".join(_cols(k))
        ctes.append(f"p{i} AS (SELECT {cs}, tf, {_pos_aggs('x')} FROM src GROUP BY {cs}, tf)")
        joins.append(f"LEFT JOIN p{i} ON {_on('t', f'p{i}', k)} AND p{i}.tf = t.fold")
        for f in _POS_FEATS[:-1]:
            sel.append(f"round(coalesce(p{i}.x_{f}, pp.g_{f}, 0), 6) AS {a}_{f}")
        sel.append(f"round(coalesce(p{i}.x_position_count_log, 0), 6) AS {a}_position_count_log")
    return with_base(*ctes, select=f"SELECT t.row_id, {', '.join(sel)} FROM tf t {' '.join(joins)}")


@register("a12_oof_position_aggregates", _a12_sql())
def a12_oof_position_aggregates(spark, sf):
    tr = _keyed(spark, sf)[0]
    folds = fo.group_folds(tr, 5, SEED)
    out = enc.add_oof_position_aggregates(tr.select("row_id", "srch_id", "position", *_with_parts(_A11_KEYS)), folds, _A11_KEYS)
    return round_doubles(out.select("row_id", *[f"{a}_{f}" for _, a in _A11_KEYS for f in _POS_FEATS]))


# ---- A1 item profiles ----------------------------------------------------------------
def _a1_sql():
    src = ", ".join(PROP_PROFILE_SOURCE_COLS)
    aggs = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, median(CAST({c} AS DOUBLE)) AS d_{c}" for c in PROP_PROFILE_SOURCE_COLS)
    g = ", ".join(f"coalesce(avg(CAST({c} AS DOUBLE)), 0) AS gm_{c}, coalesce(median(CAST({c} AS DOUBLE)), 0) AS gd_{c}"
                  for c in PROP_PROFILE_SOURCE_COLS)
    sel = []
    for c in PROP_PROFILE_SOURCE_COLS:
        sel += [f"round(coalesce(p.m_{c}, g.gm_{c}), 6) AS prop_profile_{c}_mean",
                f"round(coalesce(p.d_{c}, g.gd_{c}), 6) AS prop_profile_{c}_median"]
    sel.append("round(coalesce(p.lc, 0), 6) AS prop_profile_log_count")
    for c in PROP_PROFILE_DELTA_COLS:
        sel += [f"round(CAST(t.{c} AS DOUBLE) - coalesce(p.m_{c}, g.gm_{c}), 6) AS {c}_prop_mean_diff",
                f"round(CAST(t.{c} AS DOUBLE) - coalesce(p.d_{c}, g.gd_{c}), 6) AS {c}_prop_median_diff"]
    return with_base(
        f"u AS (SELECT prop_id, {src} FROM train UNION ALL SELECT prop_id, {src} FROM test)",
        f"p AS (SELECT prop_id, {aggs}, ln(1 + count(*)) AS lc FROM u GROUP BY prop_id)",
        f"g AS (SELECT {g} FROM u)",
        select=f"SELECT t.row_id, {', '.join(sel)} FROM test t CROSS JOIN g LEFT JOIN p ON t.prop_id = p.prop_id")


@register("a1_item_profiles", _a1_sql())
def a1_item_profiles(spark, sf):
    _, tr, te = _stored_log(spark, sf, ["prop_id", *PROP_PROFILE_SOURCE_COLS])
    _, te = ft.add_prop_numeric_profiles(tr, te)
    names = ([f"prop_profile_{c}_{s}" for c in PROP_PROFILE_SOURCE_COLS for s in ("mean", "median")]
             + ["prop_profile_log_count"]
             + [f"{c}_prop_{s}_diff" for c in PROP_PROFILE_DELTA_COLS for s in ("mean", "median")])
    return round_doubles(te.select("row_id", *names))


# ---- A2 / J7 buckets -----------------------------------------------------------------

@register("a2_j7_quantile_buckets", with_base(*_edge_ctes(), select=" UNION ALL ".join(
    f"SELECT row_id, '{split}' AS split, " + ", ".join(b for _, b, _ in BUCKET_SOURCE_SPECS) + f" FROM {k}"
    for split, k in (("train", "trk"), ("test", "tek")))))
def a2_j7_quantile_buckets(spark, sf):
    tr, te = rf.add_trip_and_value_features(train(spark, sf)), rf.add_trip_and_value_features(test(spark, sf))
    both = ft.add_fit_buckets(tr, [tr, te])
    tr, te = (round_doubles(d.select("row_id", F.lit(s).alias("split"), *[b for _, b, _ in BUCKET_SOURCE_SPECS]))
              for d, s in zip(both, ("train", "test")))
    return tr.unionByName(te)


# ---- A3 missing-value variants ------------------------------------------------------
def _clean(c):
    x = f"CAST({c} AS DOUBLE)"
    return f"(CASE WHEN {x} <> 0 THEN {x} END)" if c == "prop_log_historical_price" else x


def _a3_sql():
    cols = MISSING_VALUE_FEATURE_COLS
    g = ", ".join(f"coalesce(median({_clean(c)}), 0) AS gmed_{c}, coalesce(min({_clean(c)}), 0) - "
                  f"greatest(1.0, coalesce(stddev_samp({_clean(c)}), 0)) AS sent_{c}" for c in cols)
    s = ", ".join(f"median({_clean(c)}) AS smed_{c}" for c in cols)
    sel = []
    for c in cols:
        cl = _clean("t." + c) if c != "prop_log_historical_price" else \
            f"(CASE WHEN CAST(t.{c} AS DOUBLE) <> 0 THEN CAST(t.{c} AS DOUBLE) END)"
        imp = f"coalesce({cl}, s.smed_{c}, g.gmed_{c})"
        sel += [f"CAST({cl} IS NULL AS BIGINT) AS {c}_missing_or_zero", f"round({imp}, 6) AS {c}_country_imputed",
                f"round(coalesce({cl}, g.sent_{c}), 6) AS {c}_missing_worst_sentinel",
                f"round(coalesce({cl} - {imp}, 0), 6) AS {c}_country_median_diff"]
        if c == "prop_log_historical_price":
            sel += [f"round({cl}, 6) AS {c}_zero_clean",
                    f"CAST(coalesce(CAST(t.{c} AS DOUBLE) = 0, false) AS BIGINT) AS {c}_zero_flag"]
    return with_base(f"g AS (SELECT {g} FROM train)",
                     f"s AS (SELECT prop_country_id, {s} FROM train GROUP BY prop_country_id)",
                     select=f"SELECT t.row_id, {', '.join(sel)} FROM test t CROSS JOIN g LEFT JOIN s ON t.prop_country_id = s.prop_country_id")


@register("a3_missing_value_variants", _a3_sql())
def a3_missing_value_variants(spark, sf):
    out = ft.add_missing_value_features(train(spark, sf), [test(spark, sf)])[0]
    names = []
    for c in MISSING_VALUE_FEATURE_COLS:
        names += [f"{c}_missing_or_zero", f"{c}_country_imputed", f"{c}_missing_worst_sentinel", f"{c}_country_median_diff"]
        if c == "prop_log_historical_price":
            names += [f"{c}_zero_clean", f"{c}_zero_flag"]
    return round_doubles(out.select("row_id", *names))


# ---- A4 segment profiles ----------------------------------------------------------
_A4_SPECS = [("prop_country", "prop_country_id"), ("dest", "srch_destination_id"), ("site", "site_id"),
             ("visitor_country", "visitor_location_country_id"), ("dest_site", "_key_dest_site")]
_A4_SRC = ["price_usd", "price_per_night", "price_per_room_night", "prop_starrating", "prop_review_score",
           "prop_location_score1", "prop_location_score2", "prop_log_historical_price", "promotion_flag"]


def _a4_sql():
    ext = f"{_F3_EXPRS['price_per_night']} AS price_per_night, {_F3_EXPRS['price_per_room_night']} AS price_per_room_night"
    ctes = [f"trx AS (SELECT *, {ext} FROM train)", f"tex AS (SELECT *, {ext} FROM test)",
            "g AS (SELECT " + ", ".join(
                f"avg(CAST({c} AS DOUBLE)) AS gm_{c}, coalesce(NULLIF(stddev_samp(CAST({c} AS DOUBLE)), 0), 1.0) AS gs_{c}"
                for c in _A4_SRC) + " FROM trx)"]
    sel, joins = [], []
    for i, (a, k) in enumerate(_A4_SPECS):
        cs = ", ".join(_cols(k))
        ctes.append(f"s{i} AS (SELECT {cs}, " + ", ".join(
            f"avg(CAST({c} AS DOUBLE)) AS m_{c}, NULLIF(stddev_samp(CAST({c} AS DOUBLE)), 0) AS s_{c}" for c in _A4_SRC)
            + f" FROM trx GROUP BY {cs})")
        joins.append(f"LEFT JOIN s{i} ON {_on('t', f's{i}', k)}")
        for c in _A4_SRC:
            diff = f"(CAST(t.{c} AS DOUBLE) - coalesce(s{i}.m_{c}, g.gm_{c}))"
            std = f"NULLIF(coalesce(s{i}.s_{c}, g.gs_{c}), 0)"
            sel += [f"round({diff}, 6) AS {a}_{c}_segment_mean_diff",
                    f"round(coalesce({diff} / {std}, 0), 6) AS {a}_{c}_segment_zscore"]
    return with_base(*ctes, select=f"SELECT t.row_id, {', '.join(sel)} FROM tex t CROSS JOIN g {' '.join(joins)}")


@register("a4_segment_profiles", _a4_sql())
def a4_segment_profiles(spark, sf):
    parts = [p for _, key in _A4_SPECS for p in _cols(key)]
    _, tr, te = _stored_log(spark, sf, [*parts, *_A4_SRC], rf.add_trip_and_value_features)
    out = ft.add_segment_profiles(_with_keys(tr), [_with_keys(te)], _A4_SPECS, _A4_SRC)[0]
    return round_doubles(out.select("row_id", *[f"{a}_{c}_segment_{s}" for a, _ in _A4_SPECS for c in _A4_SRC
                                                for s in ("mean_diff", "zscore")]))
