"""Statistics report queries (ST*)."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import functions as F

from voxpop.operators import stats as ST
from voxpop.plans.catalog import register
from voxpop.plans.q_summary import lg
from voxpop.plans.sqlparts import LOGISTICS_CTE, safe_corr_sql, with_base
from voxpop.schema import CORR_DEMO, CORR_FULL, CORR_LOGISTICS, NPS_CLASSES, SPEARMAN_OPERATIONAL, SPEARMAN_SINGLE
from voxpop.sources.tables import load_base

D2 = "CAST(2 AS DOUBLE)"


def _pearson_sql(variables, src="base", ctes=()):
    body = "\nUNION ALL\n".join(f"SELECT '{v}' AS variable, {safe_corr_sql(v, 'nps_score')} AS r FROM {src}"
                                for v in variables)
    return with_base(*ctes, body=body)


@register("pearson_rank", _pearson_sql(CORR_FULL), "r")
def pearson_rank(spark, sf):
    return ST.pearson_with(load_base(spark, sf), CORR_FULL)


@register("pearson_demo", _pearson_sql(CORR_DEMO), "r")
def pearson_demo(spark, sf):
    return ST.pearson_with(load_base(spark, sf), CORR_DEMO)


@register("pearson_logistics", _pearson_sql(CORR_LOGISTICS, "lg", [LOGISTICS_CTE]), "r")
def pearson_logistics(spark, sf):
    return ST.pearson_with(lg(spark, sf), CORR_LOGISTICS)


_MATRIX = ["nps_score"] + CORR_FULL
_mx = []
for _a, _b in itertools.permutations(_MATRIX, 2):
    _mx.append(f"SELECT '{_a}' AS x, '{_b}' AS y, {safe_corr_sql(_a, _b)} AS r FROM base")
for _a in _MATRIX:
    _mx.append(f"SELECT '{_a}' AS x, '{_a}' AS y, CASE WHEN stddev_pop({_a}) > 0 THEN CAST(1 AS DOUBLE) END AS r FROM base")


@register("pearson_matrix", with_base(body="\nUNION ALL\n".join(_mx)), "r")
def pearson_matrix(spark, sf):
    return ST.pearson_matrix(load_base(spark, sf), _MATRIX)


# the study's nine logistics columns, written out
_LOG9 = ("nps_score", "delivery_delay_days", "delivery_time_days", "freight_value", "freight_ratio", "order_value", "items_quantity",
         "delivery_attempts", "repeat_purchase_30d")


@register("pearson_matrix_logistics", with_base(LOGISTICS_CTE, body="\nUNION ALL\n".join(
    f"SELECT '{a}' AS x, '{b}' AS y, " + (safe_corr_sql(a, b) if a != b else f"CASE WHEN stddev_pop({a}) > 0 THEN CAST(1 AS DOUBLE) END")
    + " AS r FROM lg" for a, b in itertools.product(_LOG9, repeat=2))), "r")
def pearson_matrix_logistics(spark, sf):
    return ST.pearson_matrix(lg(spark, sf), ["nps_score", *CORR_LOGISTICS])


_P_UNION = "\nUNION ALL\n".join(f"SELECT '{v}' AS variable, {safe_corr_sql(v, 'nps_score')} AS r FROM base"
                                for v in CORR_FULL)
register("pearson_top3", with_base(f"pr AS ({_P_UNION})", body="""
(SELECT variable, r, 'positivo' AS lado FROM pr WHERE r IS NOT NULL ORDER BY r DESC, variable LIMIT 3)
UNION ALL
(SELECT variable, r, 'negativo' AS lado FROM pr WHERE r IS NOT NULL ORDER BY r ASC, variable LIMIT 3)"""), "r")(
    lambda spark, sf: ST.top_bottom(ST.pearson_with(load_base(spark, sf), CORR_FULL), 3))


# --- Spearman ----------------------------------------------------------------------------

def _spearman_sql(v, y="nps_score"):
    return (f"SELECT '{v}' AS variable, {safe_corr_sql('rx', 'ry')} AS rho, count(*) AS n FROM ("
            f"SELECT rank() OVER (ORDER BY {v}) + (count(*) OVER (PARTITION BY {v}) - 1) / {D2} AS rx, "
            f"rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / {D2} AS ry "
            f"FROM base WHERE {v} IS NOT NULL AND {y} IS NOT NULL) t")


# the oracle's variables are written out: a wrong list in the schema turns the row red
_OPERATIONAL_SQL = "\nUNION ALL\n".join(_spearman_sql(v) for v in (
    "delivery_delay_days", "complaints_count", "customer_service_contacts", "resolution_time_days", "delivery_attempts",
    "freight_value"))
_SINGLE_SQL = "\nUNION ALL\n".join(_spearman_sql(v) for v in (
    "customer_service_contacts", "complaints_count", "resolution_time_days", "csat_internal_score", "customer_age",
    "customer_tenure_months"))


@register("spearman_rank", with_base(body=f"SELECT *, abs(rho) AS impacto_abs FROM (\n{_OPERATIONAL_SQL}\n) s"),
          "rho impacto_abs")
def spearman_rank(spark, sf):
    return ST.spearman_table(load_base(spark, sf), SPEARMAN_OPERATIONAL)


@register("spearman_single", with_base(body=f"SELECT *, abs(rho) AS impacto_abs FROM (\n{_SINGLE_SQL}\n) s"),
          "rho impacto_abs")
def spearman_single(spark, sf):
    return ST.spearman_table(load_base(spark, sf), SPEARMAN_SINGLE)


def _simpson(f: str, upto: str, steps: int = 20000) -> str:
    """Integral of ``f`` (of x) from 0 to ``upto``, by Simpson's rule."""
    x = f"({upto}) * i / {steps}"
    return (f"(SELECT ({upto}) / {steps} / 3 * sum(({re.sub(r"\bx\b", x, f)}) * CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) "
            f"FROM range({steps + 1}) AS g(i))")


# Student's t by t = sqrt(df) tan(a): its density is proportional to cos(a)^(df - 1)
_T_DENSITY = "exp((n - 3) * ln(cos(x)))"
_T_SQL = f"""SELECT variable, rho, n, impacto_abs, t_stat, p AS p_value, CASE WHEN p < 0.05 THEN 'rejeitamos a hipótese nula'
    WHEN p IS NOT NULL THEN 'não rejeitamos a hipótese nula' END AS leitura
FROM (SELECT *, greatest(0, 1 - {_simpson(_T_DENSITY, 'a')} / {_simpson(_T_DENSITY, 'top')}) AS p
      FROM (SELECT *, least(atan(abs(t_stat) / sqrt(n - 2)), top) AS a
            FROM (SELECT *, rho * sqrt((n - 2) / nullif(1 - rho * rho, 0)) AS t_stat, least(pi() / 2, 40 / sqrt(n - 2)) AS top, abs(rho) AS impacto_abs
                  FROM (\n{_OPERATIONAL_SQL}\n) r) s) t) u"""


@register("spearman_pvalues", with_base(body=_T_SQL), "rho impacto_abs t_stat p_value")
def spearman_pvalues(spark, sf):
    return ST.with_t_pvalue(ST.spearman_table(load_base(spark, sf), SPEARMAN_OPERATIONAL))


# --- Kruskal-Wallis ----------------------------------------------------------------------

def _kruskal_sql(src_cte, src, g, v, pclosed):
    return with_base(*src_cte, f"""kd AS (SELECT {g} AS g, {v} AS v FROM {src} WHERE {g} IS NOT NULL AND {v} IS NOT NULL)""",
                     f"""kr AS (SELECT g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / {D2} AS rk FROM kd)""",
                     """kg AS (SELECT g, sum(rk) AS R, count(*) AS ng FROM kr GROUP BY g)""",
                     """kt AS (SELECT sum(CAST(t AS DOUBLE) * t * t - t) AS tt, CAST(sum(t) AS BIGINT) AS N
                             FROM (SELECT count(*) AS t FROM kd GROUP BY v) x)""",
                     """kh AS (SELECT (12 / (CAST(N AS DOUBLE) * (N + 1)) * sum(R * R / ng) - 3 * (CAST(N AS DOUBLE) + 1))
                                   / nullif(1 - tt / (CAST(N AS DOUBLE) * N * N - N), 0) AS h_stat,
                                   count(*) - 1 AS df, count(*) AS k, N AS n
                             FROM kg, kt GROUP BY N, tt)""",
                     body=f"""
SELECT h_stat, df, k, n, {pclosed} AS p_value,
       CASE WHEN {pclosed} < 0.05 THEN 'rejeitamos a hipótese nula'
            WHEN {pclosed} IS NOT NULL THEN 'não rejeitamos a hipótese nula' END AS leitura
FROM kh""")


# chi-square tail in closed form for even df: df=4 (5 regions), df=2 (3 classes)
@register("kruskal_region", _kruskal_sql([], "base", "customer_region", "nps_score",
                                         "exp(-h_stat / 2) * (1 + h_stat / 2)"), "h_stat p_value")
def kruskal_region(spark, sf):
    return ST.kruskal(load_base(spark, sf), "nps_score", "customer_region")


@register("kruskal_delay", _kruskal_sql([LOGISTICS_CTE], "lg", "classificacao_nps", "delivery_delay_days",
                                        "exp(-h_stat / 2)"), "h_stat p_value")
def kruskal_delay(spark, sf):
    return ST.kruskal(lg(spark, sf), "delivery_delay_days", "classificacao_nps")


# --- Mann-Whitney ------------------------------------------------------------------------
_cls_dim = ", ".join(f"({i}, '{c}')" for i, c in enumerate(NPS_CLASSES))
_MWU_SQL = with_base(
    LOGISTICS_CTE,
    f"""md AS (SELECT classificacao_nps AS g, CAST(delivery_delay_days AS DOUBLE) AS v FROM lg
        WHERE classificacao_nps IN ('Detrator', 'Neutro', 'Promotor') AND delivery_delay_days IS NOT NULL)""",
    f"""mp AS (SELECT a.g AS g1, b.g AS g2 FROM (VALUES {_cls_dim}) AS a(i, g) JOIN (VALUES {_cls_dim}) AS b(i, g) ON a.i < b.i)""",
    """mpd AS (SELECT mp.g1, mp.g2, md.g, md.v FROM mp JOIN md ON md.g = mp.g1 OR md.g = mp.g2)""",
    f"""mr AS (SELECT *, rank() OVER (PARTITION BY g1, g2 ORDER BY v)
                     + (count(*) OVER (PARTITION BY g1, g2, v) - 1) / {D2} AS rk FROM mpd)""",
    """mt AS (SELECT g1, g2, sum(CAST(t AS DOUBLE) * t * t - t) AS tt
             FROM (SELECT g1, g2, v, count(*) AS t FROM mpd GROUP BY g1, g2, v) x GROUP BY g1, g2)""",
    """ms AS (SELECT g1, g2, sum(rk) FILTER (WHERE g = g1) AS R1,
                    count(*) FILTER (WHERE g = g1) AS n1, count(*) FILTER (WHERE g = g2) AS n2,
                    avg(v) FILTER (WHERE g = g1) AS media_1, avg(v) FILTER (WHERE g = g2) AS media_2,
                    median(v) FILTER (WHERE g = g1) AS mediana_1, median(v) FILTER (WHERE g = g2) AS mediana_2
             FROM mr GROUP BY g1, g2)""",
    """mu AS (SELECT ms.*, mt.tt, R1 - CAST(n1 AS DOUBLE) * (n1 + 1) / 2 AS u_stat,
                    CAST(n1 AS DOUBLE) AS a, CAST(n2 AS DOUBLE) AS b FROM ms JOIN mt USING (g1, g2))""",
    body="""
SELECT g1 || ' vs ' || g2 AS comparacao, g1, g2, n1, n2, media_1, media_2, mediana_1, mediana_2,
       mediana_1 - mediana_2 AS diferenca_mediana, u_stat,
       (greatest(u_stat, a * b - u_stat) - a * b / 2 - 0.5)
         / nullif(sqrt(a * b / 12 * ((a + b + 1) - tt / ((a + b) * (a + b - 1)))), 0) AS z
FROM mu""")


@register("mwu_delay_stats", _MWU_SQL, "media_1 media_2 mediana_1 mediana_2 diferenca_mediana u_stat z")
def mwu_delay_stats(spark, sf):
    return ST.mann_whitney_pairs(lg(spark, sf), "delivery_delay_days", "classificacao_nps", with_p=False)


_MWU_P_SQL = f"""SELECT * EXCLUDE (p), p AS p_value, least(3 * p, 1) AS p_ajustado, CASE WHEN 3 * p < 0.05 THEN 'Sim' ELSE 'Não' END AS significativo,
    CASE WHEN 3 * p >= 0.05 THEN 'Não há diferença estatisticamente significativa entre os grupos.'
         WHEN diferenca_mediana > 0 THEN g1 || ' apresenta mediana de atraso maior que ' || g2 || '.'
         WHEN diferenca_mediana < 0 THEN g2 || ' apresenta mediana de atraso maior que ' || g1 || '.'
         ELSE 'Há diferença estatística, mas as medianas são iguais; verificar distribuição e dispersão.' END AS interpretacao
FROM (SELECT *, greatest(0, 1 - 2 / sqrt(2 * pi()) * {_simpson('exp(-(x) * (x) / 2)', 'least(abs(z), 40)')}) AS p FROM ({_MWU_SQL}) s) t"""


@register("mwu_delay", _MWU_P_SQL, "media_1 media_2 mediana_1 mediana_2 diferenca_mediana u_stat z p_value p_ajustado")
def mwu_delay(spark, sf):
    return ST.mann_whitney_pairs(lg(spark, sf), "delivery_delay_days", "classificacao_nps")


# --- trend -------------------------------------------------------------------------------
_TREND = """SELECT regr_slope(nps_score, csat_internal_score) AS slope,
       regr_intercept(nps_score, csat_internal_score) AS intercept,
       regr_r2(nps_score, csat_internal_score) AS r2,
       CAST(regr_count(nps_score, csat_internal_score) AS BIGINT) AS n,
       CAST(min(csat_internal_score) AS DOUBLE) AS x_min, CAST(max(csat_internal_score) AS DOUBLE) AS x_max
FROM base"""


@register("trend_csat", with_base(body=_TREND), "slope intercept r2 x_min x_max")
def trend_csat(spark, sf):
    return ST.trend(load_base(spark, sf))


@register("trend_points", with_base(f"tr AS ({_TREND})", body="""
SELECT CAST(g.i AS INTEGER) AS i,
       CASE WHEN g.i = 99 THEN x_max ELSE x_min + g.i * ((x_max - x_min) / 99) END AS x,
       intercept + slope * (CASE WHEN g.i = 99 THEN x_max ELSE x_min + g.i * ((x_max - x_min) / 99) END) AS y_hat
FROM range(100) AS g(i) CROSS JOIN tr"""), "x y_hat")
def trend_points(spark, sf):
    return ST.trend_points(load_base(spark, sf))


# --- V1 / V2 comparison ------------------------------------------------------------------
def _corr_change_rows():
    keep = "nps_score > 0"
    parts = []
    for v in CORR_FULL:
        v2 = safe_corr_sql(f"CASE WHEN {keep} THEN {v} END", f"CASE WHEN {keep} THEN nps_score END")
        parts.append(f"SELECT '{v}' AS variable, {safe_corr_sql(v, 'nps_score')} AS v1, {v2} AS v2 FROM base")
    return "\nUNION ALL\n".join(parts)


CORR_CHANGE_SQL = with_base(f"cc AS ({_corr_change_rows()})", body="""
SELECT variable, v1, v2, v2 - v1 AS delta, abs(v2 - v1) AS delta_abs,
       CASE WHEN (v1 > 0 AND v2 < 0) OR (v1 < 0 AND v2 > 0) THEN 'inverteu sinal'
            WHEN abs(v2) < abs(v1) THEN 'enfraqueceu' ELSE 'fortaleceu' END AS mudanca
FROM cc""")


@register("corr_change", CORR_CHANGE_SQL, "v1 v2 delta delta_abs")
def corr_change(spark, sf):
    return ST.corr_change(load_base(spark, sf), CORR_FULL)


@register("corr_change_top6", f"SELECT * FROM ({CORR_CHANGE_SQL}) c ORDER BY delta_abs DESC, variable LIMIT 6",
          "v1 v2 delta delta_abs")
def corr_change_top6(spark, sf):
    return ST.corr_change(load_base(spark, sf), CORR_FULL).orderBy(F.desc("delta_abs"), "variable").limit(6)


def _vo_sql():
    from voxpop.plans.sqlparts import class_sql
    cls = class_sql("floor")
    H = "CAST(100 AS DOUBLE)"

    def agg(cond, tag):
        w = f" FILTER (WHERE {cond})" if cond else ""
        parts = [f"CAST(count(*){w} AS DOUBLE) AS linhas_{tag}", f"avg(nps_score){w} AS nps_medio_{tag}"]
        for k in NPS_CLASSES:
            parts.append(f"count(*) FILTER (WHERE cls = '{k}'{' AND ' + cond if cond else ''}) * {H} "
                         f"/ count(cls){w} AS {k}_{tag}")
        return ", ".join(parts)
    names = [("linhas", "Linhas na base"), ("nps_medio", "NPS médio"), ("nps_oficial", "NPS oficial"),
             ("Detrator", "% Detratores"), ("Neutro", "% Neutros"), ("Promotor", "% Promotores")]
    rows = "\nUNION ALL\n".join(f"SELECT {i} AS ordem, '{lab}' AS metrica, {k}_v1 AS v1, {k}_v2 AS v2, "
                                f"{k}_v2 - {k}_v1 AS delta FROM vo2" for i, (k, lab) in enumerate(names))
    return with_base(f"vo AS (SELECT {agg(None, 'v1')}, {agg('nps_score > 0', 'v2')} FROM (SELECT *, {cls} AS cls FROM base) b)",
                     "vo2 AS (SELECT *, Promotor_v1 - Detrator_v1 AS nps_oficial_v1, Promotor_v2 - Detrator_v2 AS nps_oficial_v2 FROM vo)",
                     body=rows)


OVERVIEW_SQL = _vo_sql()


@register("version_overview", OVERVIEW_SQL, "v1 v2 delta")
def version_overview(spark, sf):
    return ST.version_overview(load_base(spark, sf))


# --- histogram / box / QQ / residuals ------------------------------------------------------
@register("nps_histogram", with_base(
    "hs AS (SELECT min(nps_score) AS lo, max(nps_score) AS hi, avg(nps_score) AS media, median(nps_score) AS mediana FROM base)",
    """hb AS (SELECT coalesce(CAST(least(floor((nps_score - lo) / nullif((hi - lo) / 30, 0)), 29) AS INTEGER), 0) AS bin,
                 count(*) AS n FROM base, hs WHERE nps_score IS NOT NULL GROUP BY 1)""",
    body="""
SELECT CAST(g.i AS INTEGER) AS bin, lo + g.i * ((hi - lo) / 30) AS inicio,
       CASE WHEN g.i = 29 THEN hi ELSE lo + (g.i + 1) * ((hi - lo) / 30) END AS fim,
       coalesce(hb.n, 0) AS n, media, mediana
FROM range(30) AS g(i) CROSS JOIN hs LEFT JOIN hb ON hb.bin = g.i"""), "inicio fim media mediana")
def nps_histogram(spark, sf):
    return ST.histogram(load_base(spark, sf), "nps_score", 30)


def _box_sql(v):
    return with_base(LOGISTICS_CTE,
                     f"bd AS (SELECT classificacao_nps AS g, CAST({v} AS DOUBLE) AS x FROM lg WHERE classificacao_nps IS NOT NULL AND {v} IS NOT NULL)",
                     """bq AS (SELECT g, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3
                              FROM bd GROUP BY g)""",
                     body="""
SELECT bd.g AS classificacao_nps, any_value(q1) AS q1, any_value(med) AS mediana, any_value(q3) AS q3,
       min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)) AS whisker_baixo,
       max(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)) AS whisker_alto,
       count(*) FILTER (WHERE NOT (x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1))) AS outliers,
       count(*) AS n
FROM bd JOIN bq ON bq.g = bd.g GROUP BY bd.g""")


@register("box_delay", _box_sql("delivery_delay_days"), "q1 mediana q3 whisker_baixo whisker_alto")
def box_delay(spark, sf):
    return ST.box_table(lg(spark, sf), "delivery_delay_days")


@register("box_order_value", _box_sql("order_value"), "q1 mediana q3 whisker_baixo whisker_alto")
def box_order_value(spark, sf):
    return ST.box_table(lg(spark, sf), "order_value")


# the normal distribution on a grid of 0.001 (Simpson in each cell), inverted inside a cell by its Taylor series
_PHI = "exp(-({0}) * ({0}) / 2) / sqrt(2 * pi())"

def _qq_sql(ranks: str, body: str) -> str:
    """Normal scores (``t``) of the ranks that the CTE ``sj`` names."""
    return with_base(
        "sv AS (SELECT nps_score AS v, row_number() OVER (ORDER BY nps_score) AS i, count(*) OVER () AS n FROM base WHERE nps_score IS NOT NULL)",
        f"sj AS ({ranks})",
        """sm AS (SELECT sj.j, sv.i, sv.v, CASE WHEN sv.i = n THEN power(0.5, 1 / CAST(n AS DOUBLE)) WHEN sv.i = 1 THEN 1 - power(0.5, 1 / CAST(n AS DOUBLE))
                  ELSE (sv.i - CAST(0.3175 AS DOUBLE)) / (n + CAST(0.365 AS DOUBLE)) END AS m FROM sj JOIN sv ON sv.i = sj.i)""",
        f"""cell AS (SELECT k, x, ({_PHI.format('x')} + 4 * {_PHI.format('x + 0.0005')} + {_PHI.format('x + 0.001')}) / 6000 AS w
                FROM (SELECT k, CAST(k AS DOUBLE) / 1000 AS x FROM range(-9000, 9000) AS g(k)) q)""",
        "grid AS (SELECT x, coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM cell)",
        f"su AS (SELECT sm.*, grid.x, (sm.m - grid.c) / ({_PHI.format('grid.x')}) AS u FROM sm ASOF JOIN grid ON sm.m >= grid.c)",
        "st AS (SELECT *, x + u + x * u * u / 2 + (2 * x * x + 1) * u * u * u / 6 AS t FROM su)", body=body)


_QQ_SQL = _qq_sql("SELECT j, j * ((SELECT max(n) FROM sv) - 1) // 999 + 1 AS i FROM range(1000) AS g(j)",
                  "SELECT i AS ordem, t AS teorico, CAST(v AS DOUBLE) AS observado FROM st")
_QQ_LINE_SQL = _qq_sql("SELECT i AS j, i FROM sv", """SELECT regr_slope(CAST(v AS DOUBLE), t) AS slope, regr_intercept(CAST(v AS DOUBLE), t) AS intercept,
    corr(CAST(v AS DOUBLE), t) AS r, count(*) AS n FROM st""")


@register("qq_line", _QQ_LINE_SQL, "slope intercept r")
def qq_line(spark, sf):
    """ST12: the fitted line of the Q-Q plot over all rows."""
    return ST.qq_line(load_base(spark, sf), "nps_score")


@register("qq_points", _QQ_SQL, "teorico observado")
def qq_points(spark, sf):
    return ST.qq_points(load_base(spark, sf), "nps_score", 1000)


# residual diagnostics on a given prediction column (CSAT as the NPS forecast)
@register("residual_bands", with_base(body="""
SELECT d.band_id, d.band, avg(abs(b.nps_score - b.csat_internal_score)) AS erro_medio_abs, count(b.nps_score) AS n
FROM (VALUES (0, '0-3'), (1, '4-6'), (2, '7-8'), (3, '9-10')) AS d(band_id, band)
LEFT JOIN (SELECT *, CASE WHEN nps_score > 0 AND nps_score <= 3 THEN 0 WHEN nps_score > 3 AND nps_score <= 6 THEN 1
                          WHEN nps_score > 6 AND nps_score <= 8 THEN 2 WHEN nps_score > 8 AND nps_score <= 10 THEN 3 END AS bid
           FROM base) b ON b.bid = d.band_id
GROUP BY d.band_id, d.band"""), "erro_medio_abs")
def residual_bands(spark, sf):
    return ST.residual_bands(load_base(spark, sf).withColumn("prediction", F.col("csat_internal_score")))


@register("residual_histogram", with_base(
    "re AS (SELECT CAST(nps_score AS DOUBLE) - CAST(csat_internal_score AS DOUBLE) AS e FROM base)",
    "es AS (SELECT min(e) AS lo, max(e) AS hi, avg(e) AS media, median(e) AS mediana FROM re)",
    "eb AS (SELECT coalesce(CAST(least(floor((e - lo) / nullif((hi - lo) / 30, 0)), 29) AS INTEGER), 0) AS bin, count(*) AS n FROM re, es WHERE e IS NOT NULL GROUP BY 1)",
    body="""
SELECT CAST(g.i AS INTEGER) AS bin, lo + g.i * ((hi - lo) / 30) AS inicio, CASE WHEN g.i = 29 THEN hi ELSE lo + (g.i + 1) * ((hi - lo) / 30) END AS fim,
       coalesce(eb.n, 0) AS n, media, mediana
FROM range(30) AS g(i) CROSS JOIN es LEFT JOIN eb ON eb.bin = g.i"""), "inicio fim media mediana")
def residual_histogram(spark, sf):
    return ST.residual_histogram(load_base(spark, sf).withColumn("prediction", F.col("csat_internal_score")))


@register("residual_summary", with_base(body="""
SELECT avg(abs(nps_score - csat_internal_score)) AS mae, stddev_samp(nps_score - csat_internal_score) AS residuo_std,
       avg(nps_score - csat_internal_score) AS residuo_medio, count(*) AS n FROM base"""),
          "mae residuo_std residuo_medio")
def residual_summary(spark, sf):
    return ST.residual_summary(load_base(spark, sf).withColumn("prediction", F.col("csat_internal_score")))

