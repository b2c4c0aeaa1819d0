"""Independent SQL (DuckDB dialect) for the oracle checks.

The same base mapping as ``sources.tables.derive_orders_nps`` written as
plain SQL with the textbook ``lead()`` window, plus SQL fragments for the
class rules and bands.  Every oracle query is ``WITH <base ctes>, ... SELECT``.
"""

from __future__ import annotations

from voxpop.schema import BANDS, RISK_ACTIONS, RISK_POINT_RULES

BASE_CTES = """
li AS (
  SELECT l.l_orderkey,
         CAST(sum(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS qty,
         CAST(sum(CAST(floor(l.l_extendedprice * l.l_discount * 100) AS BIGINT)) AS BIGINT) AS disc_cents,
         CAST(sum(CAST(floor(l.l_extendedprice * l.l_tax * 100) AS BIGINT)) AS BIGINT) AS tax_cents,
         max(CAST(l.l_quantity AS BIGINT)) AS max_qty,
         CAST(sum(CASE WHEN l.l_shipdate > o.o_orderdate THEN 1 ELSE 0 END) AS BIGINT) AS late,
         CAST(sum(CASE WHEN l.l_discount >= 0.07 THEN 1 ELSE 0 END) AS BIGINT) AS disc_lines,
         CAST(sum(l.l_linenumber) AS BIGINT) AS lines,
         CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returns
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY l.l_orderkey
),
ol AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderdate,
         coalesce(li.qty, 0) AS qty, coalesce(li.disc_cents, 0) AS disc_cents,
         coalesce(li.tax_cents, 0) AS tax_cents,
         coalesce(1 + li.max_qty % 20, 0) AS dtime,
         CAST(coalesce(li.late, 0) AS INTEGER) AS delay,
         CAST(coalesce(li.disc_lines, 0) AS INTEGER) AS contacts,
         coalesce(li.lines % 15, 0) AS resolution,
         CAST(coalesce(li.returns, 0) AS INTEGER) AS complaints,
         CASE WHEN lead(o.o_orderdate) OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey)
                   <= o.o_orderdate + INTERVAL 30 DAY THEN 1 ELSE 0 END AS rep
  FROM orders o LEFT JOIN li ON li.l_orderkey = o.o_orderkey
),
geo AS (
  SELECT c.c_custkey, r.r_name
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
base AS (
  SELECT CAST(ol.o_custkey AS BIGINT) AS customer_id,
         CAST(18 + ol.o_custkey % 58 AS INTEGER) AS customer_age,
         geo.r_name AS customer_region,
         CAST((year(ol.o_orderdate) - 1995) * 12 + month(ol.o_orderdate) AS INTEGER) AS customer_tenure_months,
         CAST(ol.o_orderkey AS BIGINT) AS order_id,
         CAST(ol.o_totalprice AS DOUBLE) AS order_value,
         CAST(ol.qty AS INTEGER) AS items_quantity,
         ol.disc_cents / CAST(100 AS DOUBLE) AS discount_value,
         CAST(1 + ol.o_orderkey % 12 AS INTEGER) AS payment_installments,
         CAST(ol.dtime AS INTEGER) AS delivery_time_days,
         ol.delay AS delivery_delay_days,
         ol.tax_cents / CAST(100 AS DOUBLE) AS freight_value,
         CAST(1 + ol.o_orderkey % 3 AS INTEGER) AS delivery_attempts,
         ol.contacts AS customer_service_contacts,
         CAST(ol.resolution AS INTEGER) AS resolution_time_days,
         greatest(0, least(100, 105 - 12 * ol.delay - 9 * ol.complaints - 6 * ol.contacts
                  + (ol.o_orderkey * 7919) % 31 - 15)) / CAST(10 AS DOUBLE) AS nps_score,
         CAST(ol.rep AS INTEGER) AS repeat_purchase_30d,
         ol.complaints AS complaints_count,
         greatest(0, least(100, 100 - 6 * ol.delay - 5 * ol.complaints
                  + (ol.o_orderkey * 7817) % 41 - 20)) / CAST(10 AS DOUBLE) AS csat_internal_score
  FROM ol LEFT JOIN geo ON ol.o_custkey = geo.c_custkey
)"""


def with_base(*ctes: str, body: str) -> str:
    parts = [BASE_CTES.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def class_sql(rule: str = "floor", s: str = "nps_score") -> str:
    if rule == "floor":
        return (f"CASE WHEN floor({s}) >= 9 THEN 'Promotor' WHEN floor({s}) >= 7 THEN 'Neutro' "
                f"WHEN {s} IS NOT NULL THEN 'Detrator' END")
    if rule == "select":
        return (f"CASE WHEN {s} <= 6 THEN 'Detrator' WHEN {s} > 6 AND {s} < 9 THEN 'Neutro' "
                f"WHEN {s} >= 9 THEN 'Promotor' ELSE 'Sem classificação' END")
    if rule == "cut":
        return (f"CASE WHEN {s} > -1 AND {s} <= 6 THEN 'Detrator' WHEN {s} > 6 AND {s} <= 8 THEN 'Neutro' "
                f"WHEN {s} > 8 AND {s} <= 10 THEN 'Promotor' END")
    raise ValueError(rule)


def detractor_sql(rule: str = "floor", s: str = "nps_score") -> str:
    if rule == "select":
        return f"coalesce(CAST({s} <= 6 AS INTEGER), 0)"
    return f"coalesce(CAST(({class_sql(rule, s)}) = 'Detrator' AS INTEGER), 0)"


def band_id_sql(name: str, x: str | None = None) -> str:
    col, edges, _ = BANDS[name]
    x = x or col
    lowest = name == "delay_band_logistics"
    whens = []
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = f"{x} >= {lo}" if (i == 0 and lowest) else f"{x} > {lo}"
        if hi is not None:
            cond += f" AND {x} <= {hi}"
        whens.append(f"WHEN {cond} THEN {i}")
    return "CASE " + " ".join(whens) + " END"


def band_label_sql(name: str, x: str | None = None) -> str:
    col, edges, labels = BANDS[name]
    bid = band_id_sql(name, x)
    arms = " ".join(f"WHEN {i} THEN '{lb}'" for i, lb in enumerate(labels))
    return f"CASE {bid} {arms} END"


def band_dim_sql(name: str) -> str:
    labels = BANDS[name][2]
    rows = ", ".join(f"({i}, '{lb}')" for i, lb in enumerate(labels))
    return f"(SELECT * FROM (VALUES {rows}) AS t(band_id, band))"


def risk_points_sql() -> str:
    return " + ".join(f"CAST({c} >= {t} AS INTEGER)" for c, t in RISK_POINT_RULES)


def risk_action_sql(p: str = "score_risco") -> str:
    return "CASE " + " ".join(f"WHEN {p} = {i} THEN '{lb}'" for i, lb in enumerate(RISK_ACTIONS)) + " END"


def safe_corr_sql(x: str, y: str) -> str:
    xx = f"CASE WHEN {y} IS NOT NULL THEN {x} END"
    yy = f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    return f"covar_pop({xx}, {yy}) / nullif(stddev_pop({xx}) * stddev_pop({yy}), 0)"


PROCESSED_CTE = f"""
proc AS (
  SELECT *,
         {class_sql('floor')} AS classificacao_nps,
         coalesce(CAST(({class_sql('floor')}) = 'Detrator' AS INTEGER), 0) AS eh_detrator,
         CAST(delivery_delay_days > 0 AS INTEGER) AS teve_atraso,
         CAST(complaints_count > 0 AS INTEGER) AS teve_reclamacao,
         CAST(customer_service_contacts > 0 AS INTEGER) AS contatou_sac,
         CAST(delivery_delay_days > 0 AS INTEGER) + CAST(complaints_count > 0 AS INTEGER)
           + CAST(customer_service_contacts > 0 AS INTEGER) AS severidade_problemas,
         coalesce(discount_value / nullif(order_value, 0), 0) AS desconto_pct
  FROM base
)"""

SERVICE_BANDS = ["contact_range", "complaint_range", "resolution_range", "delay_range",
                 "age_range", "tenure_range"]

SERVICE_CTE = "svc AS (\n  SELECT *,\n" + ",\n".join(
    [f"    {band_id_sql(n)} AS {n}_id, {band_label_sql(n)} AS {n}" for n in SERVICE_BANDS]
    + [f"    {class_sql('select')} AS classe_nps",
       f"    {detractor_sql('select')} AS is_detractor",
       f"    {risk_points_sql()} AS score_risco"]) + "\n  FROM base\n)"

LOGISTICS_CTE = f"""
lg AS (
  SELECT *,
         {band_id_sql('delay_band_logistics')} AS delay_band_logistics_id,
         {band_label_sql('delay_band_logistics')} AS delay_band_logistics,
         {class_sql('floor')} AS classificacao_nps,
         CASE WHEN order_value > 0 THEN freight_value / order_value END AS freight_ratio,
         CAST(delivery_attempts > 1 AS INTEGER) AS has_multiple_attempts,
         CAST(delivery_delay_days > 0 AS INTEGER) AS teve_atraso
  FROM base
)"""

BREAKPOINT_CTE = f"""
bp AS (
  SELECT *,
         CAST(delivery_delay_days >= 3 AS INTEGER) AS atraso_critico,
         CAST(complaints_count >= 5 AS INTEGER) AS reclamacao_alta,
         CAST(customer_service_contacts >= 3 AS INTEGER) AS multiplos_contatos,
         delivery_delay_days * complaints_count AS atraso_x_reclamacao,
         freight_value / nullif(order_value, 0) AS freight_ratio,
         {class_sql('cut')} AS nps_category,
         {detractor_sql('select')} AS is_detractor
  FROM base
)"""
