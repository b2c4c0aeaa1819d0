"""Profiling (DQ*) and feature (P*, F1) report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxpop.operators import features as FT
from voxpop.operators import quality as Q
from voxpop.plans.catalog import register
from voxpop.plans.sqlparts import (BREAKPOINT_CTE, LOGISTICS_CTE, PROCESSED_CTE, SERVICE_BANDS,
                                   SERVICE_CTE, class_sql, detractor_sql, risk_action_sql,
                                   risk_points_sql, with_base)
from voxpop.schema import BASE_COLUMNS, NUMERIC_COLUMNS, ORDERS_NPS_SCHEMA, RANGE_RULES
from voxpop.sources.tables import load_base

_RANGE_COLS = list(dict.fromkeys(r[0] for r in RANGE_RULES))

# --- DQ1 ---------------------------------------------------------------------------
_shape_rows = ", ".join(f"('{f.name}', {i}, '{f.dataType.simpleString()}')"
                        for i, f in enumerate(ORDERS_NPS_SCHEMA.fields))


@register("dq_profile", with_base(body=f"""
SELECT t.coluna, t.ordinal, t.dtype, c.n_rows, {len(BASE_COLUMNS)} AS n_cols
FROM (VALUES {_shape_rows}) AS t(coluna, ordinal, dtype),
     (SELECT count(*) AS n_rows FROM base) c"""))
def dq_profile(spark, sf):
    return Q.shape(load_base(spark, sf))


# --- DQ2 ---------------------------------------------------------------------------
def _describe_sql(c):
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS coluna, count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, "
            f"min({x}) AS min, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
            f"quantile_cont({x}, 0.75) AS p75, max({x}) AS max FROM base")


@register("dq_describe", with_base(body="\nUNION ALL\n".join(_describe_sql(c) for c in NUMERIC_COLUMNS)),
          "mean std min p25 p50 p75 max")
def dq_describe(spark, sf):
    return Q.describe(load_base(spark, sf), NUMERIC_COLUMNS)


# --- DQ3 ---------------------------------------------------------------------------
_null_terms = [f"CAST(count(*) - count({c}) AS BIGINT)" for c in BASE_COLUMNS]


@register("dq_nulls", with_base(body="\nUNION ALL\n".join(
    [f"SELECT '{c}' AS coluna, {t} AS nulls FROM base" for c, t in zip(BASE_COLUMNS, _null_terms)]
    + [f"SELECT '__total__' AS coluna, {' + '.join(_null_terms)} AS nulls FROM base"])))
def dq_nulls(spark, sf):
    return Q.null_counts(load_base(spark, sf))


# --- DQ4 / DQ5 ---------------------------------------------------------------------
@register("dq_dup_rows", with_base(body=f"""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM base GROUP BY {', '.join(BASE_COLUMNS)}) g"""))
def dq_dup_rows(spark, sf):
    return Q.duplicate_rows(load_base(spark, sf))


_REPEATED = "SELECT * FROM base UNION ALL SELECT * FROM base WHERE order_id % 50 = 0 UNION ALL SELECT * FROM base WHERE order_id % 100 = 0"


@register("dq_dup_rows_repeated", with_base(f"rep AS ({_REPEATED})", body=f"""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM rep GROUP BY {', '.join(BASE_COLUMNS)}) g"""))
def dq_dup_rows_repeated(spark, sf):
    """DQ4 on the base with some of its rows two or three times."""
    b = load_base(spark, sf)
    return Q.duplicate_rows(b.unionByName(b.where("order_id % 50 = 0")).unionByName(b.where("order_id % 100 = 0")))


def _dupkey_sql(k):
    return (f"SELECT '{k}' AS key_column, true AS present, count(*) AS n_rows, count(DISTINCT {k}) AS n_distinct, "
            f"count({k}) - count(DISTINCT {k}) AS duplicates, "
            f"count(DISTINCT {k}) / CAST(count(*) AS DOUBLE) AS unique_ratio FROM base")


@register("dq_dup_keys", with_base(body=_dupkey_sql("order_id") + "\nUNION ALL\n" + _dupkey_sql("customer_id")),
          "unique_ratio")
def dq_dup_keys(spark, sf):
    return Q.duplicate_keys(load_base(spark, sf), ("order_id", "customer_id"))


# --- DQ6 ---------------------------------------------------------------------------
_rules_rows = ", ".join(f"('{c}', CAST({lo} AS DOUBLE), CAST({'NULL' if hi is None else hi} AS DOUBLE), '{d}')"
                        for c, lo, hi, d in RANGE_RULES)
_obs = "\nUNION ALL\n".join(f"SELECT '{c}' AS coluna, min(CAST({c} AS DOUBLE)) AS observed_min, "
                            f"max(CAST({c} AS DOUBLE)) AS observed_max FROM base" for c in _RANGE_COLS)


@register("dq_range", with_base(f"obs AS ({_obs})", body=f"""
SELECT r.coluna, r.rule_min, r.rule_max, r.description, o.observed_min, o.observed_max,
       (o.observed_min >= r.rule_min AND (r.rule_max IS NULL OR o.observed_max <= r.rule_max)) AS ok
FROM (VALUES {_rules_rows}) AS r(coluna, rule_min, rule_max, description)
LEFT JOIN obs o ON o.coluna = r.coluna"""), "rule_min rule_max observed_min observed_max")
def dq_range(spark, sf):
    return Q.range_check(load_base(spark, sf))


# --- DQ7 / DQ8 / DQ9 ---------------------------------------------------------------
@register("dq_continuity", with_base(body="""
SELECT 'nps_score' AS coluna, count(nps_score) AS n,
       CAST(sum(CAST(nps_score <> floor(nps_score) AS BIGINT)) AS BIGINT) AS non_integer,
       avg(CAST(nps_score <> floor(nps_score) AS DOUBLE)) * 100 AS pct_non_integer,
       count(DISTINCT nps_score) AS n_distinct, min(nps_score) AS min, max(nps_score) AS max
FROM base"""), "pct_non_integer min max")
def dq_continuity(spark, sf):
    return Q.continuity_check(load_base(spark, sf), "nps_score")


@register("dq_key_metrics", with_base(body=f"""
SELECT count(*) AS n_rows, {len(BASE_COLUMNS)} AS n_cols, avg(nps_score) AS nps_medio,
       median(nps_score) AS nps_mediano, avg(repeat_purchase_30d) * 100 AS pct_recompra
FROM base"""), "nps_medio nps_mediano pct_recompra")
def dq_key_metrics(spark, sf):
    return Q.key_metrics(load_base(spark, sf))


_dbl = [f.name for f in ORDERS_NPS_SCHEMA.fields if f.dataType.simpleString() == "double"]


@register("dq_preview", with_base(body="SELECT * FROM base ORDER BY order_id LIMIT 5"), _dbl)
def dq_preview(spark, sf):
    return Q.preview(load_base(spark, sf), 5)


# --- features ---------------------------------------------------------------------
_PROC_NEW = ["classificacao_nps", "eh_detrator", "teve_atraso", "teve_reclamacao", "contatou_sac",
             "severidade_problemas", "desconto_pct"]


@register("features_v1", with_base(PROCESSED_CTE, body="SELECT * FROM proc"), _dbl + ["desconto_pct"])
def features_v1(spark, sf):
    return FT.processed(load_base(spark, sf))


_OPS_COLS = ["order_id", "atraso_critico", "reclamacao_alta", "multiplos_contatos", "atraso_x_reclamacao",
             "freight_ratio", "nps_category", "is_detractor"]


@register("features_ops", with_base(BREAKPOINT_CTE, body=f"SELECT {', '.join(_OPS_COLS)} FROM bp"),
          "freight_ratio")
def features_ops(spark, sf):
    from voxpop.functions import columns as C
    df = FT.breakpoint_features(load_base(spark, sf))
    df = df.withColumn("nps_category", C.nps_class("nps_score", "cut")) \
           .withColumn("is_detractor", C.is_detractor("nps_score", "select"))
    return df.select(*_OPS_COLS)


_SVC_COLS = (["order_id"] + [x for n in SERVICE_BANDS for x in (f"{n}_id", n)]
             + ["classe_nps", "is_detractor"])


@register("bands_service", with_base(SERVICE_CTE, body=f"SELECT {', '.join(_SVC_COLS)} FROM svc"))
def bands_service(spark, sf):
    return FT.service_features(load_base(spark, sf)).select(*_SVC_COLS)


_LG_COLS = ["order_id", "delay_band_logistics_id", "delay_band_logistics", "classificacao_nps",
            "freight_ratio", "has_multiple_attempts", "teve_atraso"]


@register("bands_logistics", with_base(LOGISTICS_CTE, body=f"SELECT {', '.join(_LG_COLS)} FROM lg"),
          "freight_ratio")
def bands_logistics(spark, sf):
    return FT.logistics_features(load_base(spark, sf)).select(*_LG_COLS)


@register("risk_points", with_base(body=f"""
SELECT order_id, {risk_points_sql()} AS score_risco, {risk_action_sql('(' + risk_points_sql() + ')')} AS acao
FROM base"""))
def risk_points(spark, sf):
    return FT.service_features(load_base(spark, sf)).select("order_id", "score_risco", "acao")


@register("v2_base", with_base(body="""
SELECT count(*) AS n_v1, count(*) FILTER (WHERE nps_score <> 0) AS n_v2,
       count(*) FILTER (WHERE nps_score = 0) AS n_removidos
FROM base"""))
def v2_base(spark, sf):
    base = load_base(spark, sf)
    return base.agg(F.count(F.lit(1)).alias("n_v1"), F.count_if(F.col("nps_score") != 0).alias("n_v2"),
                    F.count_if(F.col("nps_score") == 0).alias("n_removidos"))


@register("class_rules", with_base(body=f"""
SELECT order_id, nps_score, {class_sql('floor')} AS classe_floor, {class_sql('select')} AS classe_select,
       {class_sql('cut')} AS classe_cut, {detractor_sql('floor')} AS detrator_floor,
       {detractor_sql('select')} AS detrator_select
FROM base"""), "nps_score")
def class_rules(spark, sf):
    from voxpop.functions import columns as C
    return load_base(spark, sf).select(
        "order_id", "nps_score", C.nps_class("nps_score", "floor").alias("classe_floor"),
        C.nps_class("nps_score", "select").alias("classe_select"),
        C.nps_class("nps_score", "cut").alias("classe_cut"),
        C.is_detractor("nps_score", "floor").alias("detrator_floor"),
        C.is_detractor("nps_score", "select").alias("detrator_select"))


@register("currency_report", with_base(LOGISTICS_CTE, body="""
SELECT order_id, 'R$ ' || format('{:,.2f}', order_value) AS valor_pedido FROM base"""))
def currency_report(spark, sf):
    from voxpop.functions import columns as C
    # P19 currency text, then P18 select + rename for the report
    df = load_base(spark, sf).withColumn("_valor", C.currency_brl("order_value"))
    return FT.select_report(df, {"order_id": "order_id", "_valor": "valor_pedido"})

