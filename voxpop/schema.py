"""Declared schema, class rules, band specifications and named column lists.

Everything in the FIXED VALUES block must equal the analysed study's values
for results to match (labels, edges, thresholds, column lists).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Base table (one row per order)
# ---------------------------------------------------------------------------
ORDERS_NPS_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_age", T.IntegerType()),
    T.StructField("customer_region", T.StringType()),
    T.StructField("customer_tenure_months", T.IntegerType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("order_value", T.DoubleType()),
    T.StructField("items_quantity", T.IntegerType()),
    T.StructField("discount_value", T.DoubleType()),
    T.StructField("payment_installments", T.IntegerType()),
    T.StructField("delivery_time_days", T.IntegerType()),
    T.StructField("delivery_delay_days", T.IntegerType()),
    T.StructField("freight_value", T.DoubleType()),
    T.StructField("delivery_attempts", T.IntegerType()),
    T.StructField("customer_service_contacts", T.IntegerType()),
    T.StructField("resolution_time_days", T.IntegerType()),
    T.StructField("nps_score", T.DoubleType()),
    T.StructField("repeat_purchase_30d", T.IntegerType()),
    T.StructField("complaints_count", T.IntegerType()),
    T.StructField("csat_internal_score", T.DoubleType()),
])

BASE_COLUMNS = [f.name for f in ORDERS_NPS_SCHEMA.fields]
NUMERIC_COLUMNS = [f.name for f in ORDERS_NPS_SCHEMA.fields
                   if not isinstance(f.dataType, T.StringType)]

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the study's labels, edges and lists)
# ---------------------------------------------------------------------------
DETRATOR = "Detrator"
NEUTRO = "Neutro"
PROMOTOR = "Promotor"
SEM_CLASSE = "Sem classificação"
NPS_CLASSES = [DETRATOR, NEUTRO, PROMOTOR]

# Right-closed bandings (a, b]; values outside the first/last edge get NULL.
# name: (source column, edges, labels)
BANDS = {
    "contact_range": ("customer_service_contacts", [-1, 0, 2, 999],
                      ["Nenhum", "1-2 contatos", "3+ contatos"]),
    "complaint_range": ("complaints_count", [-1, 0, 2, 5, 999],
                        ["Nenhuma", "1-2", "3-5", "6+"]),
    "resolution_range": ("resolution_time_days", [-1, 2, 5, 10, 999],
                         ["Até 2 dias", "3-5 dias", "6-10 dias", "11+ dias"]),
    "delay_range": ("delivery_delay_days", [-1, 0, 2, 5, 999],
                    ["Sem atraso", "1-2 dias", "3-5 dias", "6+ dias"]),
    "age_range": ("customer_age", [0, 25, 35, 50, 100],
                  ["18-25", "26-35", "36-50", "51+"]),
    "tenure_range": ("customer_tenure_months", [-1, 12, 36, 72, 999],
                     ["< 1 ano", "1-3 anos", "3-6 anos", "6+ anos"]),
    # logistics delay band: the last band is open above 10 days
    "delay_band_logistics": ("delivery_delay_days", [-1, 0, 1, 3, 5, 10, None],
                             ["Sem atraso", "Até 1 dia", "2 a 3 dias", "4 a 5 dias",
                              "6 a 10 dias", "Acima de 10 dias"]),
    "residual_band": ("nps_score", [0, 3, 6, 8, 10], ["0-3", "4-6", "7-8", "9-10"]),
}

# Rule-based risk score (three flags) and its action labels
RISK_POINT_RULES = [("delivery_delay_days", 3), ("complaints_count", 3),
                    ("customer_service_contacts", 2)]
RISK_ACTIONS = ["baixo risco", "acompanhar", "priorizar", "ação urgente"]

# Model-probability risk bands (score = probability * 100), lower bound inclusive
RISK_BANDS = [("Crítico", 80), ("Alto", 60), ("Médio", 40), ("Baixo", None)]

# Range rules: (column, min, max or None, description)
RANGE_RULES = [
    ("customer_age", 0, 120, "idade plausível"),
    ("customer_tenure_months", 0, None, "tenure não pode ser negativo"),
    ("order_value", 0, None, "valor não pode ser negativo"),
    ("delivery_delay_days", 0, None, "atraso não pode ser negativo"),
    ("nps_score", 0, 10, "NPS deve estar entre 0 e 10"),
    ("repeat_purchase_30d", 0, 1, "flag binária"),
    ("csat_internal_score", 0, 10, "CSAT geralmente é 0-10"),
]

# Correlation variable lists
CORR_FULL = ["customer_age", "customer_tenure_months", "order_value", "items_quantity",
             "discount_value", "payment_installments", "delivery_time_days",
             "delivery_delay_days", "freight_value", "delivery_attempts",
             "customer_service_contacts", "resolution_time_days", "complaints_count",
             "repeat_purchase_30d", "csat_internal_score"]
CORR_DEMO = ["delivery_delay_days", "complaints_count", "customer_service_contacts",
             "resolution_time_days", "delivery_attempts", "freight_value",
             "customer_age", "customer_tenure_months", "order_value"]
CORR_LOGISTICS = ["delivery_delay_days", "delivery_time_days", "freight_value",
                  "freight_ratio", "order_value", "items_quantity", "delivery_attempts",
                  "repeat_purchase_30d"]

# Spearman ranking of the operational variables
SPEARMAN_OPERATIONAL = ["delivery_delay_days", "complaints_count", "customer_service_contacts",
                        "resolution_time_days", "delivery_attempts", "freight_value"]
# Variables whose Spearman correlation is reported one by one
SPEARMAN_SINGLE = ["customer_service_contacts", "complaints_count", "resolution_time_days",
                   "csat_internal_score", "customer_age", "customer_tenure_months"]

# Seven logistics columns profiled by class
LOGISTICS_PROFILE = ["delivery_delay_days", "delivery_time_days", "freight_value",
                     "freight_ratio", "order_value", "items_quantity", "delivery_attempts"]

# Named feature sets for the models
FEATURES_FULL_V1 = ["customer_age", "customer_tenure_months", "order_value", "items_quantity",
                    "discount_value", "payment_installments", "delivery_time_days",
                    "delivery_delay_days", "freight_value", "delivery_attempts",
                    "customer_service_contacts", "resolution_time_days", "complaints_count",
                    "repeat_purchase_30d", "csat_internal_score", "severidade_problemas",
                    "desconto_pct"]
FEATURES_OPS = ["delivery_time_days", "delivery_delay_days", "freight_value",
                "delivery_attempts", "order_value", "items_quantity", "discount_value",
                "payment_installments", "customer_service_contacts", "resolution_time_days",
                "complaints_count", "customer_age", "customer_tenure_months",
                "atraso_critico", "reclamacao_alta", "multiplos_contatos",
                "atraso_x_reclamacao"]
FEATURES_DEMO = ["customer_age", "customer_tenure_months", "order_value", "items_quantity",
                 "discount_value", "payment_installments", "delivery_time_days",
                 "delivery_delay_days", "freight_value", "delivery_attempts",
                 "customer_service_contacts", "resolution_time_days", "complaints_count",
                 "atraso_critico", "reclamacao_alta", "multiplos_contatos",
                 "atraso_x_reclamacao", "freight_ratio"]
# (numeric features, categorical features); region dummies join "ops" sets
FEATURE_SETS = {
    "full_v1": (FEATURES_FULL_V1, ["customer_region"]),
    "ops": (FEATURES_OPS, ["customer_region"]),
    "ops_csat": (FEATURES_OPS + ["csat_internal_score"], ["customer_region"]),
    "demo": (FEATURES_DEMO, []),
}

# Sets whose categories become drop-first dummies, scaled with the rest (the others: one-hot, unscaled)
DROP_FIRST_SETS = ["ops", "ops_csat"]
# Sets whose hold-out is stratified by the detractor flag for regressions too
STRATIFIED_SETS = ["ops", "ops_csat"]

# Threshold sweep 0.10 .. 0.85 step 0.05, as integer hundredths
THRESHOLDS_PCT = list(range(10, 90, 5))
