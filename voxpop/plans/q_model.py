"""Model report queries (ML*, SO5-SO8).

Deterministic operators (splits, folds, weights, scaling, dummies, metrics,
ROC/AUC, threshold sweep) are checked by SQL on a GIVEN score: a detraction
probability derived from CSAT, ``(10 - csat) / 10``, against the <=6
detractor label.  Model fits are rows-only checks with the study's tree counts
(the library defaults).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from voxpop.functions import columns as C
from voxpop.ml import evaluate as EV
from voxpop.ml import explain as XP
from voxpop.ml import fit as FIT
from voxpop.ml import normal as NM
from voxpop.ml import split as SP
from voxpop.ml import trees as TR
from voxpop.operators import features as FT
from voxpop.operators import summary as S
from voxpop.plans.catalog import register
from voxpop.plans.sqlmodels import REGIONS, Design, classification_sql, regression_sql, with_models
from voxpop.plans.sqlparts import detractor_sql, with_base
from voxpop.schema import FEATURES_OPS, THRESHOLDS_PCT
from voxpop.session import checkpoint_root
from voxpop.sources.tables import load_base

HASH8 = "('0x' || substr(md5(CAST(order_id AS VARCHAR) || '42'), 1, 8))::BIGINT"
HASH15 = "('0x' || substr(md5(CAST(order_id AS VARCHAR) || '42'), 1, 15))::BIGINT"
TEST_FRAC = repr(1 - 0.8)
LABEL_SQL = detractor_sql("select")
SCORE_SQL = "(10 - csat_internal_score) / 10"


def frame(spark, sf, feature_set="ops", version="v1"):
    return FT.model_frame(load_base(spark, sf), feature_set, "select", version)


def given(spark, sf):
    """Rows with label (<=6 detractor), the given score and its 0.5 decision."""
    b = load_base(spark, sf)
    return b.select("order_id", "customer_id", "nps_score", "csat_internal_score", "delivery_delay_days",
                    C.is_detractor("nps_score", "select").alias("label"),
                    ((F.lit(10) - F.col("csat_internal_score")) / 10).alias("score")) \
        .withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


GIVEN_CTE = (f"gv AS (SELECT order_id, nps_score, csat_internal_score, {LABEL_SQL} AS label, {SCORE_SQL} AS score, "
             f"CAST({SCORE_SQL} >= 0.5 AS INTEGER) AS prediction FROM base)")

# --- ML1 / ML2 / ML19 / ML14 -------------------------------------------------------------


@register("split_random", with_base(body=f"""
SELECT order_id, CASE WHEN {HASH8} / CAST(4294967296 AS DOUBLE) < 0.8 THEN 'train' ELSE 'test' END AS split
FROM base"""))
def split_random(spark, sf):
    return SP.random_split(load_base(spark, sf)).select("order_id", "split")


_STRAT = with_base(
    f"sh AS (SELECT order_id, {LABEL_SQL} AS label, {HASH15} AS hv FROM base)",
    "sr AS (SELECT *, rank() OVER (PARTITION BY label ORDER BY hv) - 1 AS cum_before, "
    "count(*) OVER (PARTITION BY label) AS total FROM sh)",
    body=f"""SELECT order_id, label, CASE WHEN cum_before < total - ceil(total * CAST({TEST_FRAC} AS DOUBLE))
    THEN 'train' ELSE 'test' END AS split FROM sr""")


@register("split_stratified", _STRAT)
def split_stratified(spark, sf):
    return SP.stratified_split(frame(spark, sf), "label").select("order_id", "label", "split")


@register("split_class_rates", f"SELECT split, count(*) AS n, avg(label) * 100 AS taxa_positiva FROM ({_STRAT}) s GROUP BY split",
          "taxa_positiva")
def split_class_rates(spark, sf):
    return SP.class_rates(SP.stratified_split(frame(spark, sf), "label"), "label")


@register("folds_stratified", with_base(
    f"sh AS (SELECT order_id, {LABEL_SQL} AS label, {HASH15} AS hv FROM base)",
    body="SELECT order_id, label, CAST((rank() OVER (PARTITION BY label ORDER BY hv) - 1) % 5 AS INTEGER) AS fold FROM sh"))
def folds_stratified(spark, sf):
    return SP.stratified_folds(frame(spark, sf), "label", 5).select("order_id", "label", "fold")


@register("class_weights", with_base(
    f"cw AS (SELECT {LABEL_SQL} AS label, count(*) AS n_c FROM base GROUP BY 1)",
    body="SELECT label, n_c, sum(n_c) OVER () / (count(*) OVER () * CAST(n_c AS DOUBLE)) AS weight FROM cw"),
    "weight")
def class_weights(spark, sf):
    return SP.class_weights(frame(spark, sf), "label")


@register("class_positive_scale", with_base(body=f"""
SELECT count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg,
       CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) / nullif(count(*) FILTER (WHERE label = 1), 0) AS scale_pos
FROM (SELECT {LABEL_SQL} AS label FROM base) l"""), "scale_pos")
def class_positive_scale(spark, sf):
    return SP.positive_scale(frame(spark, sf), "label")


# --- ML3 / ML5 ------------------------------------------------------------------------------
_OPS_NUM_SQL = {
    "atraso_critico": "CAST(delivery_delay_days >= 3 AS INTEGER)",
    "reclamacao_alta": "CAST(complaints_count >= 5 AS INTEGER)",
    "multiplos_contatos": "CAST(customer_service_contacts >= 3 AS INTEGER)",
    "atraso_x_reclamacao": "delivery_delay_days * complaints_count",
}


@register("standardised", with_base(
    f"tr AS (SELECT * FROM base WHERE {HASH8} / CAST(4294967296 AS DOUBLE) < 0.8)",
    body="\nUNION ALL\n".join(
        f"SELECT {i} AS pos, '{c}' AS feature, avg(CAST({_OPS_NUM_SQL.get(c, c)} AS DOUBLE)) AS mean, "
        f"stddev_samp(CAST({_OPS_NUM_SQL.get(c, c)} AS DOUBLE)) AS std FROM tr" for i, c in enumerate(FEATURES_OPS))),
    "mean std")
def standardised(spark, sf):
    train = SP.random_split(frame(spark, sf)).filter("split = 'train'")
    m = Pipeline(stages=[VectorAssembler(inputCols=FEATURES_OPS, outputCol="_v"),
                         StandardScaler(inputCol="_v", outputCol="_s", withMean=True, withStd=True)]).fit(train)
    sc = m.stages[-1]
    rows = [(i, c, float(sc.mean[i]), float(sc.std[i])) for i, c in enumerate(FEATURES_OPS)]
    return spark.createDataFrame(rows, "pos int, feature string, mean double, std double")


_REGIONS_ALPHA = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _dummy_name(v):
    return "customer_region_" + v.replace(" ", "_")


@register("dummies_region", with_base(body="SELECT order_id, " + ", ".join(
    f"CASE WHEN customer_region = '{r}' THEN 1 ELSE 0 END AS {_dummy_name(r)}" for r in _REGIONS_ALPHA[1:])
    + " FROM base"))
def dummies_region(spark, sf):
    """ML5: drop-first (alphabetical) dummies via alphabetDesc index + dropLast."""
    b = load_base(spark, sf)
    m = Pipeline(stages=[StringIndexer(inputCol="customer_region", outputCol="_i", stringOrderType="alphabetDesc"),
                         OneHotEncoder(inputCol="_i", outputCol="_o", dropLast=True)]).fit(b)
    labels = m.stages[0].labels
    out = m.transform(b).withColumn("_a", vector_to_array("_o"))
    cols = [F.col("_a")[i].cast("int").alias(_dummy_name(lb)) for i, lb in enumerate(labels[:-1])]
    return out.select("order_id", *cols)


# --- ML15 / ML17 / ML18 / ML16 on the given score ---------------------------------------------

@register("reg_metrics", with_base("m AS (SELECT avg(nps_score) AS my FROM base)", body="""
SELECT avg(abs(nps_score - csat_internal_score)) AS mae, sqrt(avg((nps_score - csat_internal_score) ^ 2)) AS rmse,
       1 - sum((nps_score - csat_internal_score) ^ 2) / nullif(sum((nps_score - my) ^ 2), 0) AS r2, count(*) AS n
FROM base, m"""), "mae rmse r2")
def reg_metrics(spark, sf):
    b = load_base(spark, sf).withColumn("prediction", F.col("csat_internal_score"))
    return EV.regression_metrics(b, "nps_score", "prediction")


_CM = """count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) AS n,
       count(*) FILTER (WHERE label = prediction) AS hits"""


@register("clf_metrics", with_base(GIVEN_CTE, f"c AS (SELECT {_CM} FROM gv)",
                                   "p AS (SELECT hits / CAST(n AS DOUBLE) AS accuracy, "
                                   "coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS precision, "
                                   "coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0) AS recall, n FROM c)",
                                   body="SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM p"),
          "accuracy precision recall f1")
def clf_metrics(spark, sf):
    return EV.classification_metrics(given(spark, sf))


def _report_sql():
    parts = []
    for c in (0, 1):
        parts.append(f"""SELECT {c} AS classe,
  coalesce(count(*) FILTER (WHERE label = {c} AND prediction = {c}) / CAST(nullif(count(*) FILTER (WHERE prediction = {c}), 0) AS DOUBLE), 0) AS precision,
  coalesce(count(*) FILTER (WHERE label = {c} AND prediction = {c}) / CAST(nullif(count(*) FILTER (WHERE label = {c}), 0) AS DOUBLE), 0) AS recall,
  count(*) FILTER (WHERE label = {c}) AS support FROM gv""")
    return with_base(GIVEN_CTE, "cr AS (" + "\nUNION ALL\n".join(parts) + ")",
                     body="SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM cr")


@register("class_report", _report_sql(), "precision recall f1")
def class_report(spark, sf):
    return EV.class_report(given(spark, sf))


@register("confusion", with_base(GIVEN_CTE, body="""
SELECT c.label, c.prediction, count(gv.order_id) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS c(label, prediction)
LEFT JOIN gv ON gv.label = c.label AND gv.prediction = c.prediction GROUP BY c.label, c.prediction"""))
def confusion(spark, sf):
    return EV.confusion(given(spark, sf))


@register("roc_points", with_base(GIVEN_CTE, """sf AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
    count(*) FILTER (WHERE label <> 1) AS neg FROM gv WHERE score IS NOT NULL GROUP BY score)""", body="""
SELECT CAST(score AS DOUBLE) AS threshold,
       sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(pos) OVER () AS tpr,
       sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(neg) OVER () AS fpr
FROM sf
UNION ALL SELECT NULL, 0, 0"""), "threshold tpr fpr")
def roc_points(spark, sf):
    return EV.roc_points(given(spark, sf))


@register("auc_rank", with_base(GIVEN_CTE, """ar AS (SELECT label,
    rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS rk FROM gv WHERE score IS NOT NULL)""",
    body="""SELECT (sum(rk) FILTER (WHERE label = 1) - CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * (count(*) FILTER (WHERE label = 1) + 1) / 2)
       / nullif(CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label <> 1), 0) AS auc,
       count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label <> 1) AS n_neg FROM ar"""), "auc")
def auc_rank(spark, sf):
    return EV.auc_rank(given(spark, sf))


_TH = ", ".join(f"({t})" for t in THRESHOLDS_PCT)
_SWEEP = with_base(GIVEN_CTE, f"th AS (SELECT t_pct, t_pct / CAST(100 AS DOUBLE) AS threshold FROM (VALUES {_TH}) AS v(t_pct))",
                   """sw AS (SELECT th.t_pct, th.threshold, count(*) FILTER (WHERE gv.label = 1) AS tp,
                          count(*) FILTER (WHERE gv.label <> 1) AS fp
                          FROM th LEFT JOIN gv ON gv.score >= th.threshold GROUP BY th.t_pct, th.threshold)""",
                   "pp AS (SELECT count(*) FILTER (WHERE label = 1) AS P FROM gv WHERE score IS NOT NULL)",
                   """sr AS (SELECT t_pct, threshold, tp, fp, coalesce(tp / CAST(nullif(P, 0) AS DOUBLE), 0) AS recall,
                          coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS precision FROM sw, pp)""",
                   body="SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM sr")


@register("threshold_sweep", _SWEEP, "threshold recall precision f1")
def threshold_sweep(spark, sf):
    return EV.threshold_sweep(given(spark, sf))


@register("best_threshold", f"SELECT * FROM ({_SWEEP}) s ORDER BY f1 DESC, t_pct ASC LIMIT 1",
          "threshold recall precision f1")
def best_threshold(spark, sf):
    return EV.best_threshold(EV.threshold_sweep(given(spark, sf)))


@register("threshold_comparison", with_base(
    GIVEN_CTE, f"th AS (SELECT t_pct, t_pct / CAST(100 AS DOUBLE) AS threshold FROM (VALUES {_TH}) AS v(t_pct))",
    """cells AS (SELECT t_pct, threshold, count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp, count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
       count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn, count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn FROM th, gv GROUP BY 1, 2)""",
    """rates AS (SELECT *, coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0) AS recall, coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS precision,
       coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0) AS f1 FROM cells)""",
    "two AS ((SELECT 'padrão' AS corte, * FROM rates WHERE t_pct = 50) UNION ALL (SELECT 'otimizado' AS corte, * FROM rates ORDER BY f1 DESC, t_pct LIMIT 1))",
    body="SELECT *, f1 - (SELECT f1 FROM rates WHERE t_pct = 50) AS ganho_f1 FROM two"), "threshold recall precision f1 ganho_f1")
def threshold_comparison(spark, sf):
    """ML16: default against best threshold on the given score, with both confusion matrices."""
    return EV.compare_thresholds(given(spark, sf))


# --- model fits: linear and logistic against an independent fit in SQL, ensembles rows-only ------

def _full(p, split, version="v1", **kw):
    return Design(p, "full", split, "stddev_samp", version, dummies_scaled=False, **kw)


def _ops(p, std="stddev_samp"):
    return Design(p, "ops", "stratified", std)


# least squares with five one-hot regions and an intercept: the same fitted values as with four
_LINEAR, _RIDGE = _full("a", "random"), _ops("a")
_LOGISTIC, _BALANCED = _full("a", "stratified", regions=REGIONS), _ops("a")


@register("ml_linear", with_models(*_LINEAR.ctes, *_LINEAR.least_squares("f"), body=regression_sql(_LINEAR, "f", "linear")), "value")
def ml_linear(spark, sf):
    return FIT.holdout_metrics(frame(spark, sf, "full_v1"), "full_v1", "reg", ["linear"])


@register("ml_ridge", with_models(*_RIDGE.ctes, *_RIDGE.least_squares("f", 1), body=regression_sql(_RIDGE, "f", "ridge")), "value")
def ml_ridge(spark, sf):
    return FIT.holdout_metrics(frame(spark, sf, "ops"), "ops", "reg", ["ridge"])


@register("ml_logistic", with_models(*_LOGISTIC.ctes, *_LOGISTIC.logistic("f", False), body=classification_sql(_LOGISTIC, "f", "logistic")), "value")
def ml_logistic(spark, sf):
    return FIT.holdout_metrics(frame(spark, sf, "full_v1"), "full_v1", "clf", ["logistic"])


@register("ml_logistic_balanced", with_models(*_BALANCED.ctes, *_BALANCED.logistic("f", True), body=classification_sql(_BALANCED, "f", "logistic")), "value")
def ml_logistic_balanced(spark, sf):
    return FIT.holdout_metrics(frame(spark, sf, "ops"), "ops", "clf", ["logistic"], weighted=True)


_SCALED = _ops("a", "stddev_pop")
_NAMES = "[" + ", ".join(f"'{n}'" for n in ["intercept", *FEATURES_OPS, *[f"customer_region_{r}" for r in REGIONS[1:]]]) + "]"


@register("ml_coefficients", with_models(*_SCALED.ctes, *_SCALED.least_squares("ridge", 1), *_SCALED.logistic("logistic", True), body=" UNION ALL ".join(
    f"SELECT '{m}' AS model, unnest(range(0, {_SCALED.n + 1})) AS pos, unnest({_NAMES}) AS feature, unnest(sol) AS coefficient FROM {m}" for m in ("ridge", "logistic"))), "coefficient")
def ml_coefficients(spark, sf):
    """Coefficients by feature name of the ridge and the balanced logistic fit to
    the training part, from Gram tables and Newton steps."""
    train = SP.stratified_split(frame(spark, sf, "ops"), "label").filter("split = 'train'").withColumn("fold", F.lit(0))
    columns = FIT.design_columns(train, "ops")
    rows, _ = NM.standardised(train, columns, F.lit(True))
    rows = rows.persist()
    fits = {"ridge": NM.solve_ridge(NM.gram(rows, "nps_score", "fold")[0], 1.0), "logistic": NM.logistic(rows, "label", balanced=True)[None]}
    rows.unpersist()
    named = ["intercept", *columns]
    return spark.createDataFrame([(m, i, n, float(v)) for m, b in fits.items() for i, (n, v) in enumerate(zip(named, b))],
                                 "model string, pos int, feature string, coefficient double")


@register("ml_attribution_reg")
def ml_attribution_reg(spark, sf):
    """ML21 for the boosted regressor."""
    df = frame(spark, sf, "ops")
    model = FIT.fit(SP.stratified_split(df, "label").filter("split = 'train'"), "ops", "nps_score", "gbt_reg")
    attr = XP.row_attributions(model, FIT.score(model, df), margin="prediction")
    return XP.global_importance(attr, FIT.slot_names(model)).withColumnRenamed("max_gap", "max_additivity_gap")


_CERTIFICATE = _ops("a")


@register("ml_tree_certificate", with_models(*_CERTIFICATE.ctes, body="SELECT 'gbt_clf' AS model, count(*) AS n_rows, 200 AS n_trees, 0 AS n_wrong, CAST(0 AS DOUBLE) AS gap FROM a_d WHERE NOT train"), "gap")
def ml_tree_certificate(spark, sf):
    """The boosted classifier's hold-out scores derived again from its node table."""
    split = SP.with_weights(SP.stratified_split(frame(spark, sf, "ops"), "label"), "label").persist()
    model = FIT.fit(split.filter("split = 'train'"), "ops", "label", "gbt_clf", weight_col="weight")
    row = TR.certificate(model.stages[-1], FIT.score(model, split.filter("split = 'test'")), name="gbt_clf").collect()
    split.unpersist()
    return spark.createDataFrame(row, "model string, n_rows long, n_trees long, n_wrong long, gap double")


@register("ml_forest_reg")
def ml_forest_reg(spark, sf):
    return FIT.holdout_metrics(frame(spark, sf, "full_v1"), "full_v1", "reg", ["forest_reg"])


@register("ml_gbt_reg")
def ml_gbt_reg(spark, sf):
    return FIT.holdout_metrics(frame(spark, sf, "ops"), "ops", "reg", ["gbt_reg"])


@register("ml_forest_clf")
def ml_forest_clf(spark, sf):
    return FIT.holdout_metrics(frame(spark, sf, "full_v1"), "full_v1", "clf", ["forest_clf"])


@register("ml_gbt_clf")
def ml_gbt_clf(spark, sf):
    return FIT.holdout_metrics(frame(spark, sf, "ops"), "ops", "clf", ["gbt_clf"], weighted=True)


@register("ml_best_model")
def ml_best_model(spark, sf):
    m = FIT.holdout_metrics(frame(spark, sf, "full_v1"), "full_v1", "reg", ["linear", "forest_reg"])
    return EV.best_model(m, "r2", ["linear", "forest_reg"], higher=True)


@register("ml_best_classifier")
def ml_best_classifier(spark, sf):
    """SO5: the classifier with the best F1 on the hold-out."""
    models = ["logistic", "forest_clf"]
    m = FIT.holdout_metrics(frame(spark, sf, "full_v1"), "full_v1", "clf", models)
    return EV.best_model(m, "f1", models, higher=True)


def _cv_sql():
    r, c = _ops("a", "stddev_pop"), _ops("a", "stddev_pop")
    score = lambda d, fit, fold: f"SELECT z.y, z.label, z.{fold} AS fold, {d.linear('c.sol')} AS s FROM {d.p}z z JOIN {fit} c ON c.m = z.{fold} WHERE z.train"
    ctes = [*r.ctes, *r.least_squares("rf", 1, "fold"), *c.logistic("lf", True, "cfold"),
            f"rs AS (SELECT fold, 1 - sum((y - s) * (y - s)) / (var_pop(y) * count(*)) AS v FROM ({score(r, 'rf', 'fold')}) q GROUP BY fold)",
            f"ls AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY s) + (count(*) OVER (PARTITION BY fold, s) - 1) / CAST(2 AS DOUBLE) AS rk FROM ({score(c, 'lf', 'cfold')}) q)",
            """lm AS (SELECT fold, 2 * CAST(count(*) FILTER (WHERE s > 0 AND label = 1) AS DOUBLE) / (count(*) FILTER (WHERE s > 0) + count(*) FILTER (WHERE label = 1)) AS f1,
            (sum(rk) FILTER (WHERE label = 1) - CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * (count(*) FILTER (WHERE label = 1) + 1) / 2)
            / (CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label = 0)) AS auc FROM ls GROUP BY fold)"""]
    part = lambda metric, v, table, model: f"SELECT '{metric}' AS metric, avg({v}) AS mean, stddev_pop({v}) AS std, count(*) AS folds, '{model}' AS model FROM {table}"
    return with_models(*ctes, body=" UNION ALL ".join([part("r2", "v", "rs", "ridge"), part("f1", "f1", "lm", "logistic"), part("auc", "auc", "lm", "logistic")]))


@register("ml_cv", _cv_sql(), "mean std")
def ml_cv(spark, sf):
    """ML19 on the training part: ridge (R²) and balanced logistic (F1, AUC)."""
    train = SP.stratified_split(frame(spark, sf, "ops"), "label").filter("split = 'train'").drop("split")
    return FIT.cross_validate(train, "ops", "reg", "ridge").unionByName(FIT.cross_validate(train, "ops", "clf", "logistic"))


@register("ml_importance")
def ml_importance(spark, sf):
    df = frame(spark, sf, "full_v1")
    train = SP.random_split(df).filter("split = 'train'")
    model = FIT.fit(train, "full_v1", "nps_score", "forest_reg")
    return FIT.importances(model, df)


@register("ml_attribution")
def ml_attribution(spark, sf):
    """Global mean |phi| top 10 of a boosted classifier, with the worst
    additivity gap |base + sum(phi) - margin| over all scored rows."""
    df = frame(spark, sf, "ops")
    split = SP.stratified_split(df, "label")
    model = FIT.fit(split.filter("split = 'train'"), "ops", "label", "gbt_clf")
    scored = FIT.score(model, df).withColumn("_margin", vector_to_array("rawPrediction")[1])
    attr = XP.row_attributions(model, scored, margin="_margin")
    return XP.global_importance(attr, FIT.slot_names(model)).withColumnRenamed("max_gap", "max_additivity_gap")


def _scenarios_sql():
    ctes, parts = [], []
    for v in ("v1", "v2"):
        reg, clf = _full(f"r{v}", "random", v), _full(f"c{v}", "stratified", v, regions=REGIONS)
        ctes += [*reg.ctes, *reg.least_squares(f"fr{v}"), *clf.ctes, *clf.logistic(f"fc{v}", False)]
        parts += [f"SELECT *, '{v}' AS version FROM ({regression_sql(reg, f'fr{v}', 'linear')}) s{v}", f"SELECT *, '{v}' AS version FROM ({classification_sql(clf, f'fc{v}', 'logistic')}) t{v}"]
    low = "metric IN ('mae', 'rmse')"
    return with_models(*ctes, f"parts AS ({' UNION ALL '.join(parts)})",
                       "wide AS (SELECT model, metric, max(value) FILTER (WHERE version = 'v1') AS v1, max(value) FILTER (WHERE version = 'v2') AS v2 FROM parts GROUP BY model, metric)",
                       body=f"SELECT *, v2 - v1 AS delta, CASE WHEN v2 = v1 THEN 'igual' WHEN ({low}) = (v2 < v1) THEN 'melhor' ELSE 'pior' END AS resultado FROM wide")


@register("ml_scenarios", _scenarios_sql(), "v1 v2 delta")
def ml_scenarios(spark, sf):
    """ML22: V1 (all rows) vs V2 (NPS=0 removed) for the regression and
    classification models, with delta and better/worse verdict."""
    parts = []
    for v in ("v1", "v2"):
        df = frame(spark, sf, "full_v1", v)
        parts.append(FIT.holdout_metrics(df, "full_v1", "reg", ["linear"], version_tag=v))
        parts.append(FIT.holdout_metrics(df, "full_v1", "clf", ["logistic"], version_tag=v))
    m = parts[0]
    for p in parts[1:]:
        m = m.unionByName(p)
    return FIT.compare_versions(m)


@register("ml_csat_scenario")
def ml_csat_scenario(spark, sf):
    """ML22: the same boosted regressor without / with CSAT.  The two fits do not
    depend on each other and run at once: one computes while the other waits for
    the end of a pass."""
    frames = [frame(spark, sf, s) for s in ("ops", "ops_csat")]
    run = inheritable_thread_target(spark)(lambda df, s, v: FIT.holdout_metrics(df, s, "reg", ["gbt_reg"], version_tag=v))
    with ThreadPoolExecutor(2) as pool:
        a, b = pool.map(run, frames, ("ops", "ops_csat"), ("v1", "v2"))
    return FIT.compare_versions(a.unionByName(b)).withColumnRenamed("v1", "sem_csat").withColumnRenamed("v2", "com_csat")


def _csat_sql():
    without, given_csat = _ops("a", "stddev_pop"), Design("b", "ops_csat", "stratified", "stddev_pop")
    both = " UNION ALL ".join(f"SELECT *, '{v}' AS version FROM ({classification_sql(d, f'f{v}', 'logistic')}) {v}" for v, d in (("sem", without), ("com", given_csat)))
    return with_models(*without.ctes, *without.logistic("fsem", True), *given_csat.ctes, *given_csat.logistic("fcom", True), f"parts AS ({both})",
                       "wide AS (SELECT model, metric, max(value) FILTER (WHERE version = 'sem') AS sem_csat, max(value) FILTER (WHERE version = 'com') AS com_csat FROM parts GROUP BY model, metric)",
                       body="SELECT *, com_csat - sem_csat AS delta, CASE WHEN com_csat = sem_csat THEN 'igual' WHEN com_csat > sem_csat THEN 'melhor' ELSE 'pior' END AS resultado FROM wide")


@register("ml_csat_scenario_clf", _csat_sql(), "sem_csat com_csat delta")
def ml_csat_scenario_clf(spark, sf):
    """ML22: the same balanced logistic classifier without / with CSAT, by Newton
    steps to the optimum (the differences are as small as a solver's tolerance)."""
    found = []
    for s, v in (("ops", "v1"), ("ops_csat", "v2")):
        split = SP.stratified_split(frame(spark, sf, s), "label").persist()
        inside = F.col("split") == "train"
        rows, _ = NM.standardised(split, FIT.design_columns(split.filter(inside), s), inside)
        scored = NM.probability(rows.filter(~inside), NM.logistic(rows.filter(inside), "label", balanced=True))
        scored = scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))
        auc = EV.auc_rank(scored).select(F.lit("auc").alias("metric"), F.col("auc").alias("value"), F.lit("logistic").alias("model"))
        m = EV.classification_metrics(scored, model="logistic", long=True).unionByName(auc)
        found += [(*r, v) for r in m.select("metric", "value", "model").collect()]
        split.unpersist()
    return FIT.compare_versions(spark.createDataFrame(found, "metric string, value double, model string, version string")).withColumnRenamed("v1", "sem_csat").withColumnRenamed("v2", "com_csat")


def _risk_scored(spark, sf, scope="all"):
    """ML24: balanced forest on the demo features scores every row (or only
    the hold-out), risk = P(detractor) * 100.

    The scores are written once under the shared checkpoint folder: the grown
    trees are large, and every stage over the scored frame would send them anew."""
    df = FT.model_frame(load_base(spark, sf), "demo", "select").withColumns(
        {"_d": F.col("delivery_delay_days"), "_c": F.col("complaints_count"), "_s": F.col("customer_service_contacts")})
    split = SP.with_weights(SP.stratified_split(df, "label", 0.75), "label").persist()
    model = FIT.fit(split.filter("split = 'train'"), "demo", "label", "forest_clf", depth=30,
                    weight_col="weight", scale=False)
    target = split if scope == "all" else split.filter("split = 'test'")
    scored = FIT.score(model, target).select(*split.columns, "score")
    path = f"{checkpoint_root(spark)}/voxpop_scored/{uuid.uuid4().hex}"
    scored.write.parquet(path)
    split.unpersist()
    return spark.read.schema(scored.schema).parquet(path).withColumn("risk_score", F.col("score") * 100) \
        .withColumn("is_detractor", F.col("label"))


@register("ml_risk_bands")
def ml_risk_bands(spark, sf):
    return S.risk_band_summary(_risk_scored(spark, sf), "risk_score", "is_detractor")


@register("ml_top_risk")
def ml_top_risk(spark, sf):
    s = _risk_scored(spark, sf).withColumn("risk_band", C.risk_band("risk_score"))
    return S.top_by(s, "risk_score", 10, "order_id",
                    ["customer_id", "order_id", "risk_score", "risk_band", "nps_score", "_d", "_c", "_s"])


@register("ml_risk_queue")
def ml_risk_queue(spark, sf):
    """SO8: rows above the best-F1 threshold of the hold-out sweep."""
    scored = _risk_scored(spark, sf)
    best = EV.best_threshold(EV.threshold_sweep(scored.filter("split = 'test'"), "label", "score")).first()
    th = float(best["threshold"]) if best else 0.5
    return S.risk_queue(scored, "score", th).select("order_id", "customer_id", "score", "risk_score",
                                                     F.lit(th).alias("limiar"))


# --- P20 verdict labels ---------------------------------------------------------------------

@register("verdicts", with_base(GIVEN_CTE,
    "d AS (SELECT count(*) FILTER (WHERE floor(nps_score) >= 9) * CAST(100 AS DOUBLE) / count(nps_score) "
    "- count(*) FILTER (WHERE floor(nps_score) < 7) * CAST(100 AS DOUBLE) / count(nps_score) AS nps_oficial FROM base)",
    "m AS (SELECT avg(abs(nps_score - csat_internal_score)) AS mae FROM base)",
    """a AS (SELECT (sum(rk) FILTER (WHERE label = 1) - CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE)
                   * (count(*) FILTER (WHERE label = 1) + 1) / 2)
                  / nullif(CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label <> 1), 0) AS auc
           FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS rk
                 FROM gv WHERE score IS NOT NULL) r)""",
    body="""SELECT d.nps_oficial, CASE WHEN d.nps_oficial > 50 THEN 'Excelente (>50)' WHEN d.nps_oficial > 0 THEN 'Bom (>0)'
       ELSE 'Crítico (<=0)' END AS leitura_nps, m.mae,
       CASE WHEN m.mae < 1.5 THEN 'aceitável' WHEN m.mae < 2.5 THEN 'razoável' ELSE 'alto' END AS leitura_mae, a.auc,
       CASE WHEN a.auc > 0.9 THEN 'excelente' WHEN a.auc > 0.8 THEN 'bom' ELSE 'razoável' END AS leitura_auc
FROM d, m, a"""), "nps_oficial mae auc")
def verdicts(spark, sf):
    """P20: official-NPS, MAE and AUC verdicts (MAE/AUC of the given score)."""
    # the official NPS is the same on every class row; it and the AUC are scalars
    nps = S.nps_distribution(load_base(spark, sf), "floor").agg(F.max("nps_oficial")).scalar()
    auc = EV.auc_rank(given(spark, sf)).select("auc").scalar()
    b = load_base(spark, sf).withColumn("prediction", F.col("csat_internal_score"))
    mae = b.agg(F.avg(F.abs(F.col("nps_score") - F.col("prediction"))).alias("mae"))
    return (mae.select(nps.alias("nps_oficial"), "mae", auc.alias("auc"))
            .withColumn("leitura_nps", C.nps_verdict("nps_oficial"))
            .withColumn("leitura_mae", C.mae_verdict("mae"))
            .withColumn("leitura_auc", C.auc_verdict("auc")))
