"""Aggregations, cross-tabs, reshapes and top-k (AG1-AG18, J1-J6, X1-X3, SO1-SO4, F2-F5).

Plan rules used throughout:

* group keys are low-cardinality (classes, bands, regions, flags), so every
  ``groupBy`` is a partial (map-side) aggregation followed by a tiny shuffle;
* classes and bands are FIXED lists: cross-tabs are conditional aggregates in
  one pass (no data-driven pivot scan), and empty bands are restored by a
  left join from the fixed label dimension (a few rows, broadcast);
* shares of total are windows over the already aggregated rows only;
* money is summed as integer cents (exact, order-independent);
* medians are the distributed exact quantile (no per-group value map).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxpop.functions import columns as C
from voxpop.functions.ranks import exact_quantiles, stacked
from voxpop.operators.features import band_dimension
from voxpop.schema import NPS_CLASSES, PROMOTOR, DETRATOR, SEM_CLASSE, RISK_BANDS


def money_sum(col: str):
    """Exact sum of a two-decimal money column (integer cents)."""
    return F.sum(F.round(F.col(col) * 100).cast("bigint")) / F.lit(100.0)


def _share(col: str, by=()):
    return F.col(col) * 100.0 / F.sum(col).over(Window.partitionBy(*by))


# --- AG1 -----------------------------------------------------------------------

def nps_distribution(df: DataFrame, rule: str = "floor", score: str = "nps_score") -> DataFrame:
    """Count and % per class and the official NPS (%Promotor - %Detrator) —
    one global aggregation, exploded to one row per class (all classes kept)."""
    cls = C.nps_class(score, rule)
    classes = NPS_CLASSES + ([SEM_CLASSE] if rule == "select" else [])
    row = df.agg(*[F.count_if(cls == k).alias(f"n{i}") for i, k in enumerate(classes)])
    total = sum((F.col(f"n{i}") for i in range(len(classes))), F.lit(0))
    pct = {k: F.try_divide(F.col(f"n{i}") * 100.0, total) for i, k in enumerate(classes)}
    row = row.withColumn("nps_oficial", pct[PROMOTOR] - pct[DETRATOR])
    structs = [F.struct(F.lit(i).alias("ordem"), F.lit(k).alias("classe"), F.col(f"n{i}").alias("n"),
                        pct[k].alias("pct"), F.col("nps_oficial")) for i, k in enumerate(classes)]
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# --- AG2 / AG16 / AG17 / J3 ------------------------------------------------------

def band_summary(df: DataFrame, band: str, with_median: bool = True,
                 detractor: str = "is_detractor") -> DataFrame:
    """Driver summary per right-closed band, every band present (empty band:
    count 0, means NULL)."""
    _, bid, _ = C.named_band(band)
    aggs = [F.count("customer_id").alias("qtd_clientes"), F.avg("nps_score").alias("nps_medio")]
    aggs.append((F.avg(detractor) * 100).alias("pct_detrator"))
    banded = df.withColumn("band_id", bid).filter(F.col("band_id").isNotNull())
    agg = banded.groupBy("band_id").agg(*aggs)
    if with_median:
        agg = agg.join(exact_quantiles(banded, "nps_score", [0.5], ["band_id"]).withColumnRenamed("q50", "nps_mediano"), "band_id", "left")
    out = F.broadcast(band_dimension(df.sparkSession, band)).join(agg, "band_id", "left")
    return out.withColumn("qtd_clientes", F.coalesce("qtd_clientes", F.lit(0)))


def group_summary(df: DataFrame, key: str, detractor: str = "is_detractor") -> DataFrame:
    """qtd_clientes / nps_medio / pct_detrator by an existing key (AG4, AG5, AG16)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count("customer_id").alias("qtd_clientes"), F.avg("nps_score").alias("nps_medio"),
                 (F.avg(detractor) * 100).alias("pct_detrator")))


def mean_by_value(df: DataFrame, key: str, target: str = "nps_score") -> DataFrame:
    """AG3: mean and count of the target by exact key value."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.avg(target).alias("nps_medio"), F.count(target).alias("n")))


def region_spread(df: DataFrame, detractor: str = "is_detractor") -> DataFrame:
    """AG4 second step: min / max / spread of regional mean NPS + verdict."""
    per = group_summary(df, "customer_region", detractor)
    return (per.agg(F.min("nps_medio").alias("menor_nps_regiao"), F.max("nps_medio").alias("maior_nps_regiao"))
            .withColumn("diferenca_regiao", F.col("maior_nps_regiao") - F.col("menor_nps_regiao"))
            .withColumn("leitura", C.spread_verdict("diferenca_regiao")))


def repurchase_summary(df: DataFrame) -> DataFrame:
    """AG5 with P17 labels."""
    labels = F.create_map(F.lit(0), F.lit("Não recomprou"), F.lit(1), F.lit("Recomprou"))
    return (group_summary(df, "repeat_purchase_30d")
            .withColumn("label", labels[F.col("repeat_purchase_30d")]))


DETRACTOR_PROFILE = [("media_contatos", "customer_service_contacts", 1),
                     ("media_reclamacoes", "complaints_count", 1),
                     ("tempo_resolucao_medio", "resolution_time_days", 1),
                     ("csat_medio", "csat_internal_score", 1),
                     ("recompra_30d", "repeat_purchase_30d", 100)]


def detractor_profile(df: DataFrame, flag: str = "is_detractor") -> DataFrame:
    """AG6: five means by detractor flag, labelled groups."""
    labels = F.create_map(F.lit(0), F.lit("Não detrator"), F.lit(1), F.lit("Detrator"))
    out = df.groupBy(flag).agg(*[(F.avg(c) * k).alias(name) for name, c, k in DETRACTOR_PROFILE])
    return out.withColumn("grupo", labels[F.col(flag)])


def detractor_profile_long(df: DataFrame, flag: str = "is_detractor") -> DataFrame:
    """The same table transposed to metric x group (declared pivot values)."""
    wide = detractor_profile(df, flag)
    long = wide.unpivot([flag], [n for n, _, _ in DETRACTOR_PROFILE], "metrica", "valor")
    return (long.groupBy("metrica").pivot(flag, [0, 1]).agg(F.first("valor"))
            .withColumnRenamed("0", "nao_detrator").withColumnRenamed("1", "detrator"))


ZERO_PROFILE = ["delivery_delay_days", "complaints_count", "customer_service_contacts",
                "csat_internal_score", "repeat_purchase_30d"]


def zero_vs_rest(df: DataFrame) -> DataFrame:
    """AG7 / F2: means of five columns for NPS = 0 vs NPS > 0, plus sizes —
    one pass with a conditional group column, no second scan."""
    grp = F.when(F.col("nps_score") == 0, "nps_zero").when(F.col("nps_score") > 0, "resto")
    return (df.withColumn("grupo", grp).filter(F.col("grupo").isNotNull()).groupBy("grupo")
            .agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in ZERO_PROFILE]))


# --- AG8 --------------------------------------------------------------------------

def six_stat_profile(df: DataFrame, cols, by: str = "classificacao_nps") -> DataFrame:
    """count/mean/median/std/min/max of each column by class, long form.

    Rows are stacked into (class, variable, value) right after the scan: the
    moments are five aggregates grouped by (class, variable), the exact medians
    come from range counts of the same stack."""
    stack = stacked(df.filter(F.col(by).isNotNull()), cols, [by])
    keys = [by, "variable"]
    v = F.col("v")
    moments = stack.groupBy(*keys).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    med = exact_quantiles(stack, "v", [0.5], keys)
    return (moments.join(med.withColumnRenamed("q50", "median"), keys, "left")
            .select(by, "variable", "count", "mean", "median", "std", "min", "max"))


# --- AG9 / X1 / AG18 ------------------------------------------------------------

def crosstab_pct(df: DataFrame, key, cls: str = "classificacao_nps",
                 classes=tuple(NPS_CLASSES)) -> DataFrame:
    """Row-normalised cross-tab key x class in %, fixed class columns."""
    keys = [key] if isinstance(key, str) else list(key)
    cond = F.col(cls).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    base = df.filter(cond)
    n = F.count(F.lit(1))
    return base.groupBy(*keys).agg(
        n.alias("n"), *[(F.count_if(F.col(cls) == k) * 100.0 / n).alias(k) for k in classes])


def delay_break(df: DataFrame) -> DataFrame:
    """AG18: detractor % along the ordered logistics delay bands; ``salto``
    is the jump from the previous populated band."""
    xt = crosstab_pct(df, "delay_band_logistics_id")
    dim = band_dimension(df.sparkSession, "delay_band_logistics").withColumnRenamed("band_id", "delay_band_logistics_id")
    out = F.broadcast(dim).join(xt, "delay_band_logistics_id")
    w = Window.orderBy("delay_band_logistics_id")
    return (out.select("delay_band_logistics_id", "band", F.col(DETRATOR).alias("pct_detrator"))
            .withColumn("salto", F.col("pct_detrator") - F.lag("pct_detrator").over(w)))


# --- AG10 -----------------------------------------------------------------------

def frequency(df: DataFrame, key: str) -> DataFrame:
    out = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("pct", _share("n"))


# --- AG11 / AG12 / AG13 / AG14 ---------------------------------------------------

def _revenue_aggs():
    return [F.count("order_value").alias("total_pedidos"), money_sum("order_value").alias("faturamento_total"),
            F.avg("order_value").alias("ticket_medio"),
            F.avg("delivery_delay_days").alias("atraso_medio"),
            F.avg("delivery_attempts").alias("tentativas_medias"),
            F.avg("repeat_purchase_30d").alias("recompra_media_30d")]


def revenue_by(df: DataFrame, key: str, exact_median: bool = True) -> DataFrame:
    """AG11/AG12: orders, revenue, ticket mean & median, delay, attempts,
    repurchase and shares of orders and revenue."""
    base = df.filter(F.col(key).isNotNull())
    agg = base.groupBy(key).agg(*_revenue_aggs())
    med = exact_quantiles(base, "order_value", [0.5], by=[key]) if exact_median else \
        base.groupBy(key).agg(F.percentile_approx("order_value", 0.5, 10000).cast("double").alias("q50"))
    out = agg.join(med.withColumnRenamed("q50", "mediana_pedido"), key, "left")
    if key == "teve_atraso":
        out = out.withColumn("grupo", F.create_map(F.lit(0), F.lit("Sem atraso"), F.lit(1), F.lit("Com atraso"))[F.col(key)])
    return (out.withColumn("percentual_pedidos_pct", _share("total_pedidos"))
            .withColumn("participacao_faturamento_pct", _share("faturamento_total")))


def _medians(q: DataFrame, names: dict[str, str], by=()) -> DataFrame:
    """(by..., variable, q50) -> one row per group with a column per variable."""
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("variable") == c, F.col("q50"))).alias(a) for c, a in names.items()])


def high_value_delayed(df: DataFrame) -> DataFrame:
    """AG13 / F4: orders at or above the 75th percentile of value that were
    delayed — summary and share of high-value orders.  The percentile is a
    scalar subquery (computed once, used as a value in the filter)."""
    q75 = exact_quantiles(df, "order_value", [0.75]).select("q75").scalar()
    hv = df.filter(F.col("order_value") >= q75)
    delayed = F.col("teve_atraso") == 1
    summary = hv.agg(
        F.count(F.lit(1)).alias("total_alto_valor"),
        F.count_if(delayed).alias("alto_valor_com_atraso"),
        F.sum(F.when(delayed, F.round(F.col("order_value") * 100).cast("bigint"))).alias("_cents"),
        F.avg(F.when(delayed, F.col("order_value"))).alias("valor_medio"),
        F.avg(F.when(delayed, F.col("delivery_delay_days"))).alias("atraso_medio"),
        F.avg(F.when(delayed, F.col("delivery_attempts"))).alias("tentativas_medias"),
        F.avg(F.when(delayed, F.col("repeat_purchase_30d"))).alias("recompra_media_30d"))
    names = {"order_value": "valor_mediana", "delivery_delay_days": "atraso_mediana", "delivery_attempts": "tentativas_mediana"}
    med = _medians(exact_quantiles(stacked(hv.filter(delayed), list(names)), "v", [0.5], ["variable"]), names)
    med = med.select(F.struct(*names.values())).scalar()
    return (summary.withColumn("q75_order_value", q75).withColumns({c: med[c] for c in names.values()})
            .withColumn("valor_total", F.col("_cents") / F.lit(100.0)).drop("_cents")
            .withColumn("pct_alto_valor_com_atraso",
                        F.try_divide(F.col("alto_valor_com_atraso") * 100.0, F.col("total_alto_valor"))))


def high_value_mix(df: DataFrame) -> DataFrame:
    """AG13: class mix of the delayed high-value orders (all classes listed)."""
    q75 = exact_quantiles(df, "order_value", [0.75]).select("q75").scalar()
    hvd = df.filter((F.col("order_value") >= q75) & (F.col("teve_atraso") == 1))
    dist = nps_distribution(hvd, "floor")
    return dist.select("ordem", "classe", "n", "pct")


REGIONAL_AGGS = [
    ("atraso_medio", lambda: F.avg("delivery_delay_days")),
    ("tempo_entrega_medio", lambda: F.avg("delivery_time_days")),
    ("frete_medio", lambda: F.avg("freight_value")),
    ("peso_medio_frete", lambda: F.avg("freight_ratio")),
    ("tentativas_medias", lambda: F.avg("delivery_attempts")),
    ("ticket_medio", lambda: F.avg("order_value")),
    ("recompra_media_30d", lambda: F.avg("repeat_purchase_30d")),
]


def regional_logistics(df: DataFrame) -> DataFrame:
    """AG14 + J1: per region the logistics/revenue measures, shares, and the
    class mix (conditional counts in the same pass, no second scan/join of
    the fact table)."""
    base = df.filter(F.col("customer_region").isNotNull())
    n = F.count("order_value")
    nc = F.count("classificacao_nps")
    agg = base.groupBy("customer_region").agg(
        n.alias("total_pedidos"), *[f().alias(name) for name, f in REGIONAL_AGGS],
        money_sum("order_value").alias("faturamento_total"),
        *[F.try_divide(F.count_if(F.col("classificacao_nps") == k) * 100.0, nc).alias(k) for k in NPS_CLASSES])
    names = {"order_value": "mediana_pedido", "delivery_delay_days": "atraso_mediana"}
    by = ["customer_region"]
    med = _medians(exact_quantiles(stacked(base, list(names), by), "v", [0.5], [*by, "variable"]), names, by)
    out = agg.join(med, by, "left")
    return (out.withColumn("participacao_faturamento_pct", _share("faturamento_total"))
            .withColumn("participacao_pedidos_pct", _share("total_pedidos")))


# --- AG15 / F3 / F5 ---------------------------------------------------------------

def kpi_panel(df: DataFrame, flag: str = "is_detractor") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_clientes"), F.avg("nps_score").alias("nps_medio"),
        (F.avg(flag) * 100).alias("pct_detratores"),
        F.avg("customer_service_contacts").alias("media_contatos"),
        F.avg("complaints_count").alias("media_reclamacoes"),
        F.avg("resolution_time_days").alias("tempo_medio_resolucao"),
        F.avg("delivery_delay_days").alias("atraso_medio"),
        F.avg("csat_internal_score").alias("csat_medio"),
        (F.avg("repeat_purchase_30d") * 100).alias("pct_recompra_30d"))


def delayed_share(df: DataFrame, flag: str = "is_detractor") -> DataFrame:
    delayed = F.col("delivery_delay_days") > 0
    return df.agg(
        F.count_if(delayed).alias("clientes_com_atraso"),
        F.try_divide(F.count_if(delayed) * 100.0, F.count(F.lit(1))).alias("pct_base_atraso"),
        (F.avg(F.when(delayed, F.col(flag))) * 100).alias("pct_detratores_atraso"))


def csat_means(df: DataFrame, flag: str = "is_detractor") -> DataFrame:
    return df.agg(
        F.avg("csat_internal_score").alias("csat_medio"),
        F.avg(F.when(F.col(flag) == 1, F.col("csat_internal_score"))).alias("csat_detratores"),
        F.avg(F.when(F.col(flag) == 0, F.col("csat_internal_score"))).alias("csat_nao_detratores"))


def flag_incidence(df: DataFrame, flags=("atraso_critico", "reclamacao_alta", "multiplos_contatos")) -> DataFrame:
    """Count and % of each break-point flag (one pass, unpivoted)."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(f).alias(f) for f in flags])
    structs = [F.struct(F.lit(f).alias("flag"), F.col(f).cast("bigint").alias("n"),
                        F.try_divide(F.col(f) * 100.0, F.col("_n")).alias("pct")) for f in flags]
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# --- risk bands on a score (AG17, SO2, SO8) -------------------------------------------

def risk_band_summary(scored: DataFrame, score: str = "risk_score", flag: str = "is_detractor") -> DataFrame:
    """Clients, real detractors, rate, mean NPS and delay per risk band; all
    four bands present."""
    spark = scored.sparkSession
    banded = scored.withColumn("risk_band", C.risk_band(score))
    agg = banded.filter(F.col("risk_band").isNotNull()).groupBy("risk_band").agg(
        F.count("customer_id").alias("clientes"), F.sum(flag).cast("bigint").alias("detratores_reais"),
        (F.avg(flag) * 100).alias("taxa_detratores"), F.avg("nps_score").alias("nps_medio"),
        F.avg("delivery_delay_days").alias("atraso_medio"))
    dim = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(RISK_BANDS)], "ordem int, risk_band string")
    return (F.broadcast(dim).join(agg, "risk_band", "left")
            .withColumn("clientes", F.coalesce("clientes", F.lit(0)))
            .withColumn("detratores_reais", F.coalesce("detratores_reais", F.lit(0).cast("bigint"))))


def top_by(df: DataFrame, score: str, n: int = 10, key: str = "order_id", cols=None) -> DataFrame:
    """SO2: n highest scores, ties broken by the key (TakeOrderedAndProject)."""
    out = df.orderBy(F.desc(score), F.asc(key)).limit(n)
    return out.select(*cols) if cols else out


def risk_queue(scored: DataFrame, score: str = "probability", threshold: float = 0.5) -> DataFrame:
    """SO8: rows above a tuned threshold, highest risk first."""
    return scored.filter(F.col(score) > threshold).orderBy(F.desc(score), "order_id")
