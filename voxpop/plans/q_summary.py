"""Aggregation / cross-tab / top-k report queries (AG*, X*, J*, SO2, F3-F5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxpop.functions import columns as C
from voxpop.operators import features as FT
from voxpop.operators import summary as S
from voxpop.plans.catalog import register
from voxpop.plans.sqlparts import (BREAKPOINT_CTE, LOGISTICS_CTE, SERVICE_CTE, band_dim_sql, class_sql,
                                   with_base)
from voxpop.schema import LOGISTICS_PROFILE, NPS_CLASSES, RISK_BANDS
from voxpop.sources.tables import load_base

H = "CAST(100 AS DOUBLE)"


def svc(spark, sf):
    return FT.service_features(load_base(spark, sf))


def lg(spark, sf):
    return FT.logistics_features(load_base(spark, sf))


# --- AG1: class distributions under the three rules ---------------------------------

def _dist_sql(rule):
    classes = NPS_CLASSES + (["Sem classificação"] if rule == "select" else [])
    dim = ", ".join(f"({i}, '{k}')" for i, k in enumerate(classes))
    return with_base(f"c AS (SELECT {class_sql(rule)} AS classe FROM base)",
                     f"""t AS (SELECT count(classe) AS total,
       count(*) FILTER (WHERE classe = 'Promotor') * {H} / count(classe)
       - count(*) FILTER (WHERE classe = 'Detrator') * {H} / count(classe) AS nps_oficial FROM c)""",
                     body=f"""
SELECT d.ordem, d.classe, count(c.classe) AS n, count(c.classe) * {H} / t.total AS pct, t.nps_oficial
FROM (VALUES {dim}) AS d(ordem, classe) LEFT JOIN c ON c.classe = d.classe CROSS JOIN t
GROUP BY d.ordem, d.classe, t.total, t.nps_oficial""")


for _rule in ("floor", "select", "cut"):
    register(f"nps_dist_{_rule}", _dist_sql(_rule), "pct nps_oficial")(
        (lambda r: lambda spark, sf: S.nps_distribution(load_base(spark, sf), r))(_rule))


# --- AG2: driver summaries per band --------------------------------------------------

def _band_sql(band, median):
    med = "median(s.nps_score) AS nps_mediano, " if median else ""
    return with_base(SERVICE_CTE, body=f"""
SELECT d.band_id, d.band, count(s.customer_id) AS qtd_clientes, avg(s.nps_score) AS nps_medio, {med}
       avg(s.is_detractor) * 100 AS pct_detrator
FROM {band_dim_sql(band)} d LEFT JOIN svc s ON s.{band}_id = d.band_id
GROUP BY d.band_id, d.band""")


for _name, _band, _med in [("driver_contacts", "contact_range", True),
                           ("driver_complaints", "complaint_range", True),
                           ("driver_resolution", "resolution_range", True),
                           ("driver_delay", "delay_range", True),
                           ("driver_age", "age_range", False),
                           ("driver_tenure", "tenure_range", False)]:
    register(_name, _band_sql(_band, _med), "nps_medio pct_detrator" + (" nps_mediano" if _med else ""))(
        (lambda b, m: lambda spark, sf: S.band_summary(svc(spark, sf), b, m))(_band, _med))


# --- AG3 ----------------------------------------------------------------------------
for _name, _col in [("mean_by_delay", "delivery_delay_days"), ("mean_by_contacts", "customer_service_contacts"),
                    ("mean_by_complaints", "complaints_count")]:
    register(_name, with_base(body=f"""
SELECT {_col}, avg(nps_score) AS nps_medio, count(nps_score) AS n FROM base
WHERE {_col} IS NOT NULL GROUP BY {_col}"""), "nps_medio")(
        (lambda c: lambda spark, sf: S.mean_by_value(load_base(spark, sf), c))(_col))


# --- AG4 / AG5 / AG16 -------------------------------------------------------------------

def _group_sql(key):
    return with_base(SERVICE_CTE, body=f"""
SELECT {key}, count(customer_id) AS qtd_clientes, avg(nps_score) AS nps_medio, avg(is_detractor) * 100 AS pct_detrator
FROM svc WHERE {key} IS NOT NULL GROUP BY {key}""")


@register("region_summary", _group_sql("customer_region"), "nps_medio pct_detrator")
def region_summary(spark, sf):
    return S.group_summary(svc(spark, sf), "customer_region")


@register("region_spread", with_base(SERVICE_CTE, f"""g AS (SELECT customer_region, avg(nps_score) AS nps_medio
    FROM svc WHERE customer_region IS NOT NULL GROUP BY customer_region)""", body="""
SELECT min(nps_medio) AS menor_nps_regiao, max(nps_medio) AS maior_nps_regiao,
       max(nps_medio) - min(nps_medio) AS diferenca_regiao,
       CASE WHEN max(nps_medio) - min(nps_medio) < 0.5 THEN 'variação baixa'
            WHEN max(nps_medio) - min(nps_medio) IS NOT NULL THEN 'variação relevante' END AS leitura
FROM g"""), "menor_nps_regiao maior_nps_regiao diferenca_regiao")
def region_spread(spark, sf):
    return S.region_spread(svc(spark, sf))


@register("repurchase_summary", with_base(SERVICE_CTE, body="""
SELECT repeat_purchase_30d, count(customer_id) AS qtd_clientes, avg(nps_score) AS nps_medio,
       avg(is_detractor) * 100 AS pct_detrator,
       CASE repeat_purchase_30d WHEN 0 THEN 'Não recomprou' WHEN 1 THEN 'Recomprou' END AS label
FROM svc WHERE repeat_purchase_30d IS NOT NULL GROUP BY repeat_purchase_30d"""), "nps_medio pct_detrator")
def repurchase_summary(spark, sf):
    return S.repurchase_summary(svc(spark, sf))


@register("risk_score_summary", _group_sql("score_risco"), "nps_medio pct_detrator")
def risk_score_summary(spark, sf):
    return S.group_summary(svc(spark, sf), "score_risco")


# --- AG6 / X2 ---------------------------------------------------------------------------
_PROFILE_SQL = ", ".join(f"avg({c}) * {k} AS {n}" for n, c, k in S.DETRACTOR_PROFILE)
_PROFILE_NAMES = " ".join(n for n, _, _ in S.DETRACTOR_PROFILE)


@register("detractor_profile", with_base(SERVICE_CTE, body=f"""
SELECT is_detractor, {_PROFILE_SQL},
       CASE is_detractor WHEN 0 THEN 'Não detrator' WHEN 1 THEN 'Detrator' END AS grupo
FROM svc GROUP BY is_detractor"""), _PROFILE_NAMES)
def detractor_profile(spark, sf):
    return S.detractor_profile(svc(spark, sf))


@register("detractor_profile_long", with_base(SERVICE_CTE, f"""w AS (SELECT is_detractor, {_PROFILE_SQL}
    FROM svc GROUP BY is_detractor)""", body="\nUNION ALL\n".join(
    f"SELECT '{n}' AS metrica, max({n}) FILTER (WHERE is_detractor = 0) AS nao_detrator, "
    f"max({n}) FILTER (WHERE is_detractor = 1) AS detrator FROM w" for n, _, _ in S.DETRACTOR_PROFILE)),
    "nao_detrator detrator")
def detractor_profile_long(spark, sf):
    return S.detractor_profile_long(svc(spark, sf))


# --- AG7 ------------------------------------------------------------------------------
@register("zero_vs_rest", with_base(body=f"""
SELECT grupo, count(*) AS n, {', '.join(f'avg({c}) AS {c}' for c in S.ZERO_PROFILE)}
FROM (SELECT *, CASE WHEN nps_score = 0 THEN 'nps_zero' WHEN nps_score > 0 THEN 'resto' END AS grupo FROM base) b
WHERE grupo IS NOT NULL GROUP BY grupo"""), " ".join(S.ZERO_PROFILE))
def zero_vs_rest(spark, sf):
    return S.zero_vs_rest(load_base(spark, sf))


# --- AG8 ------------------------------------------------------------------------------
def _six_sql(cols):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT classificacao_nps, '{c}' AS variable, count({x}) AS count, avg({x}) AS mean, "
                     f"median({x}) AS median, stddev_samp({x}) AS std, min({x}) AS min, max({x}) AS max "
                     f"FROM lg WHERE classificacao_nps IS NOT NULL GROUP BY classificacao_nps")
    return with_base(LOGISTICS_CTE, body="\nUNION ALL\n".join(parts))


@register("logistics_six_stats", _six_sql(LOGISTICS_PROFILE), "mean median std min max")
def logistics_six_stats(spark, sf):
    return S.six_stat_profile(lg(spark, sf), LOGISTICS_PROFILE)


@register("delay_by_class", _six_sql(["delivery_delay_days"]), "mean median std min max")
def delay_by_class(spark, sf):
    return S.six_stat_profile(lg(spark, sf), ["delivery_delay_days"])


# --- AG9 / AG18 / AG10 ------------------------------------------------------------------
def _xtab_sql(keys):
    k = ", ".join(keys)
    notnull = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    cls = ", ".join(f"count(*) FILTER (WHERE classificacao_nps = '{c}') * {H} / count(*) AS \"{c}\""
                    for c in NPS_CLASSES)
    return with_base(LOGISTICS_CTE, body=f"""
SELECT {k}, count(*) AS n, {cls}
FROM lg WHERE {notnull} AND classificacao_nps IS NOT NULL GROUP BY {k}""")


for _name, _keys in [("xtab_delay", ["teve_atraso"]),
                     ("xtab_delay_band", ["delay_band_logistics_id", "delay_band_logistics"]),
                     ("xtab_attempts", ["has_multiple_attempts"]),
                     ("xtab_region", ["customer_region"])]:
    register(_name, _xtab_sql(_keys), NPS_CLASSES)(
        (lambda k: lambda spark, sf: S.crosstab_pct(lg(spark, sf), k))(_keys))


@register("delay_break", with_base(LOGISTICS_CTE, f"""x AS (SELECT delay_band_logistics_id,
    count(*) FILTER (WHERE classificacao_nps = 'Detrator') * {H} / count(*) AS pct_detrator
    FROM lg WHERE delay_band_logistics_id IS NOT NULL AND classificacao_nps IS NOT NULL
    GROUP BY delay_band_logistics_id)""", body=f"""
SELECT x.delay_band_logistics_id, d.band, x.pct_detrator,
       x.pct_detrator - lag(x.pct_detrator) OVER (ORDER BY x.delay_band_logistics_id) AS salto
FROM x JOIN {band_dim_sql('delay_band_logistics')} d ON d.band_id = x.delay_band_logistics_id"""),
    "pct_detrator salto")
def delay_break(spark, sf):
    return S.delay_break(lg(spark, sf))


@register("freq_attempts", with_base(body=f"""
SELECT delivery_attempts, count(*) AS n, count(*) * {H} / sum(count(*)) OVER () AS pct
FROM base WHERE delivery_attempts IS NOT NULL GROUP BY delivery_attempts"""), "pct")
def freq_attempts(spark, sf):
    return S.frequency(load_base(spark, sf), "delivery_attempts")


@register("freq_class_cut", with_base(BREAKPOINT_CTE, body=f"""
SELECT nps_category, count(*) AS n, count(*) * {H} / sum(count(*)) OVER () AS pct
FROM bp WHERE nps_category IS NOT NULL GROUP BY nps_category"""), "pct")
def freq_class_cut(spark, sf):
    df = load_base(spark, sf).withColumn("nps_category", C.nps_class("nps_score", "cut"))
    return S.frequency(df, "nps_category")


# --- AG11 / AG12 / AG13 / AG14 ---------------------------------------------------------
_REV_DOUBLES = ("faturamento_total ticket_medio atraso_medio tentativas_medias recompra_media_30d "
                "mediana_pedido percentual_pedidos_pct participacao_faturamento_pct")


def _rev_sql(key):
    return with_base(LOGISTICS_CTE, f"""g AS (
  SELECT {key}, count(order_value) AS total_pedidos,
         CAST(sum(CAST(round(order_value * 100) AS BIGINT)) AS BIGINT) / {H} AS faturamento_total,
         avg(order_value) AS ticket_medio, avg(delivery_delay_days) AS atraso_medio,
         avg(delivery_attempts) AS tentativas_medias, avg(repeat_purchase_30d) AS recompra_media_30d,
         median(order_value) AS mediana_pedido
  FROM lg WHERE {key} IS NOT NULL GROUP BY {key})""", body=f"""
SELECT *, total_pedidos * {H} / sum(total_pedidos) OVER () AS percentual_pedidos_pct,
       faturamento_total * {H} / sum(faturamento_total) OVER () AS participacao_faturamento_pct
FROM g""")


@register("revenue_by_class", _rev_sql("classificacao_nps"), _REV_DOUBLES)
def revenue_by_class(spark, sf):
    return S.revenue_by(lg(spark, sf), "classificacao_nps")


@register("revenue_by_delay", f"""SELECT *, CASE teve_atraso WHEN 0 THEN 'Sem atraso' WHEN 1 THEN 'Com atraso' END AS grupo
FROM ({_rev_sql("teve_atraso")}) r""", _REV_DOUBLES)
def revenue_by_delay(spark, sf):
    return S.revenue_by(lg(spark, sf), "teve_atraso")


_HV_CTES = [LOGISTICS_CTE, "q AS (SELECT quantile_cont(order_value, 0.75) AS q75 FROM lg)",
            "hv AS (SELECT lg.* FROM lg, q WHERE lg.order_value >= q.q75)"]


@register("high_value_delayed", with_base(*_HV_CTES, body=f"""
SELECT count(*) AS total_alto_valor,
       count(*) FILTER (WHERE teve_atraso = 1) AS alto_valor_com_atraso,
       avg(order_value) FILTER (WHERE teve_atraso = 1) AS valor_medio,
       avg(delivery_delay_days) FILTER (WHERE teve_atraso = 1) AS atraso_medio,
       median(CAST(delivery_delay_days AS DOUBLE)) FILTER (WHERE teve_atraso = 1) AS atraso_mediana,
       avg(delivery_attempts) FILTER (WHERE teve_atraso = 1) AS tentativas_medias,
       median(CAST(delivery_attempts AS DOUBLE)) FILTER (WHERE teve_atraso = 1) AS tentativas_mediana,
       avg(repeat_purchase_30d) FILTER (WHERE teve_atraso = 1) AS recompra_media_30d,
       (SELECT q75 FROM q) AS q75_order_value,
       median(order_value) FILTER (WHERE teve_atraso = 1) AS valor_mediana,
       CAST(sum(CAST(round(order_value * 100) AS BIGINT)) FILTER (WHERE teve_atraso = 1) AS BIGINT) / {H} AS valor_total,
       count(*) FILTER (WHERE teve_atraso = 1) * {H} / count(*) AS pct_alto_valor_com_atraso
FROM hv"""), "valor_medio atraso_medio atraso_mediana tentativas_medias tentativas_mediana recompra_media_30d "
             "q75_order_value valor_mediana valor_total pct_alto_valor_com_atraso")
def high_value_delayed(spark, sf):
    return S.high_value_delayed(lg(spark, sf))


@register("high_value_mix", with_base(*_HV_CTES, body=f"""
SELECT d.ordem, d.classe, count(h.classificacao_nps) AS n,
       count(h.classificacao_nps) * {H} / (SELECT count(classificacao_nps) FROM hv WHERE teve_atraso = 1) AS pct
FROM (VALUES (0, 'Detrator'), (1, 'Neutro'), (2, 'Promotor')) AS d(ordem, classe)
LEFT JOIN (SELECT * FROM hv WHERE teve_atraso = 1) h ON h.classificacao_nps = d.classe
GROUP BY d.ordem, d.classe"""), "pct")
def high_value_mix(spark, sf):
    return S.high_value_mix(lg(spark, sf))


_REG_CLS = ", ".join(f"count(*) FILTER (WHERE classificacao_nps = '{c}') * {H} / nullif(count(classificacao_nps), 0) "
                     f"AS \"{c}\"" for c in NPS_CLASSES)


@register("regional_logistics", with_base(LOGISTICS_CTE, f"""g AS (
  SELECT customer_region, count(order_value) AS total_pedidos, avg(delivery_delay_days) AS atraso_medio,
         median(CAST(delivery_delay_days AS DOUBLE)) AS atraso_mediana, avg(delivery_time_days) AS tempo_entrega_medio,
         avg(freight_value) AS frete_medio, avg(freight_ratio) AS peso_medio_frete,
         avg(delivery_attempts) AS tentativas_medias, avg(order_value) AS ticket_medio,
         avg(repeat_purchase_30d) AS recompra_media_30d,
         CAST(sum(CAST(round(order_value * 100) AS BIGINT)) AS BIGINT) / {H} AS faturamento_total,
         {_REG_CLS}, median(order_value) AS mediana_pedido
  FROM lg WHERE customer_region IS NOT NULL GROUP BY customer_region)""", body=f"""
SELECT *, faturamento_total * {H} / sum(faturamento_total) OVER () AS participacao_faturamento_pct,
       total_pedidos * {H} / sum(total_pedidos) OVER () AS participacao_pedidos_pct
FROM g"""), "atraso_medio atraso_mediana tempo_entrega_medio frete_medio peso_medio_frete tentativas_medias "
            "ticket_medio recompra_media_30d faturamento_total Detrator Neutro Promotor mediana_pedido "
            "participacao_faturamento_pct participacao_pedidos_pct")
def regional_logistics(spark, sf):
    return S.regional_logistics(lg(spark, sf))


# --- AG15 / F3 / F5 / P15 -----------------------------------------------------------------
@register("kpi_panel", with_base(SERVICE_CTE, body="""
SELECT count(*) AS total_clientes, avg(nps_score) AS nps_medio, avg(is_detractor) * 100 AS pct_detratores,
       avg(customer_service_contacts) AS media_contatos, avg(complaints_count) AS media_reclamacoes,
       avg(resolution_time_days) AS tempo_medio_resolucao, avg(delivery_delay_days) AS atraso_medio,
       avg(csat_internal_score) AS csat_medio, avg(repeat_purchase_30d) * 100 AS pct_recompra_30d
FROM svc"""), "nps_medio pct_detratores media_contatos media_reclamacoes tempo_medio_resolucao atraso_medio "
              "csat_medio pct_recompra_30d")
def kpi_panel(spark, sf):
    return S.kpi_panel(svc(spark, sf))


@register("delayed_share", with_base(SERVICE_CTE, body=f"""
SELECT count(*) FILTER (WHERE delivery_delay_days > 0) AS clientes_com_atraso,
       count(*) FILTER (WHERE delivery_delay_days > 0) * {H} / count(*) AS pct_base_atraso,
       avg(is_detractor) FILTER (WHERE delivery_delay_days > 0) * 100 AS pct_detratores_atraso
FROM svc"""), "pct_base_atraso pct_detratores_atraso")
def delayed_share(spark, sf):
    return S.delayed_share(svc(spark, sf))


@register("csat_means", with_base(SERVICE_CTE, body="""
SELECT avg(csat_internal_score) AS csat_medio,
       avg(csat_internal_score) FILTER (WHERE is_detractor = 1) AS csat_detratores,
       avg(csat_internal_score) FILTER (WHERE is_detractor = 0) AS csat_nao_detratores
FROM svc"""), "csat_medio csat_detratores csat_nao_detratores")
def csat_means(spark, sf):
    return S.csat_means(svc(spark, sf))


_FLAGS = ["atraso_critico", "reclamacao_alta", "multiplos_contatos"]


@register("flag_incidence", with_base(BREAKPOINT_CTE, body="\nUNION ALL\n".join(
    f"SELECT '{f}' AS flag, CAST(sum({f}) AS BIGINT) AS n, sum({f}) * {H} / count(*) AS pct FROM bp"
    for f in _FLAGS)), "pct")
def flag_incidence(spark, sf):
    return S.flag_incidence(FT.breakpoint_features(load_base(spark, sf)), _FLAGS)


# --- AG17 / SO2 on a given deterministic score ------------------------------------------
# Given score for the oracle-checked risk operators: a CSAT-derived detraction
# probability (ties included).  The model-scored variants live in q_model.
GIVEN_SCORE_SQL = "(10 - csat_internal_score) * 10"


def given_scored(spark, sf):
    return svc(spark, sf).withColumn("risk_score", (F.lit(10) - F.col("csat_internal_score")) * 10)


_band_case = "CASE " + " ".join(
    f"WHEN {GIVEN_SCORE_SQL} >= {lo} THEN '{b}'" if lo is not None else f"WHEN {GIVEN_SCORE_SQL} IS NOT NULL THEN '{b}'"
    for b, lo in RISK_BANDS) + " END"
_risk_dim = ", ".join(f"({i}, '{b}')" for i, (b, _) in enumerate(RISK_BANDS))


@register("risk_band_summary", with_base(SERVICE_CTE, f"rb AS (SELECT *, {_band_case} AS risk_band FROM svc)", body=f"""
SELECT d.risk_band, d.ordem, count(rb.customer_id) AS clientes,
       coalesce(CAST(sum(rb.is_detractor) AS BIGINT), 0) AS detratores_reais,
       avg(rb.is_detractor) * 100 AS taxa_detratores, avg(rb.nps_score) AS nps_medio,
       avg(rb.delivery_delay_days) AS atraso_medio
FROM (VALUES {_risk_dim}) AS d(ordem, risk_band) LEFT JOIN rb ON rb.risk_band = d.risk_band
GROUP BY d.risk_band, d.ordem"""), "taxa_detratores nps_medio atraso_medio")
def risk_band_summary(spark, sf):
    return S.risk_band_summary(given_scored(spark, sf))


_TOP_COLS = ["customer_id", "order_id", "risk_score", "risk_band", "nps_score", "delivery_delay_days",
             "complaints_count", "customer_service_contacts"]


@register("top_risk", with_base(SERVICE_CTE, f"rs AS (SELECT *, {GIVEN_SCORE_SQL} AS risk_score, {_band_case} AS risk_band FROM svc)",
                                body=f"SELECT {', '.join(_TOP_COLS)} FROM rs ORDER BY risk_score DESC, order_id LIMIT 10"),
          "risk_score nps_score")
def top_risk(spark, sf):
    df = given_scored(spark, sf).withColumn("risk_band", C.risk_band("risk_score"))
    return S.top_by(df, "risk_score", 10, "order_id", _TOP_COLS)
