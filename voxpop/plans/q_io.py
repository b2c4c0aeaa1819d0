"""IO report queries: tables written to the shared folder and read back (IO1-IO5)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from voxpop.ml import fit as FIT
from voxpop.operators import features as FT
from voxpop.operators import stats as ST
from voxpop.plans.catalog import register
from voxpop.plans.q_stats import CORR_CHANGE_SQL, OVERVIEW_SQL
from voxpop.plans.sqlmodels import REGIONS, Design, classification_sql, regression_sql, with_models
from voxpop.plans.sqlparts import PROCESSED_CTE, with_base
from voxpop.schema import CORR_FULL, ORDERS_NPS_SCHEMA
from voxpop.session import checkpoint_root
from voxpop.sources import tables as IO

_DOUBLES = [f.name for f in ORDERS_NPS_SCHEMA.fields if f.dataType.simpleString() == "double"]


def _folder(spark) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/voxpop-io-{uuid.uuid4().hex}"


def _orders_csv(spark, sf) -> str:
    """The base as CSV, columns in another order."""
    path, base = _folder(spark), IO.load_base(spark, sf)
    IO.write_table(base.select(*reversed(base.columns)), path, "csv")
    return path


@register("io_orders_roundtrip", with_base(body="SELECT * FROM base"), _DOUBLES)
def io_orders_roundtrip(spark, sf):
    return IO.read_orders(spark, _orders_csv(spark, sf))


@register("io_orders_unparsed", with_base(body="SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {f.name} IS NULL) AS {f.name}" for f in ORDERS_NPS_SCHEMA.fields if f.name != "customer_region") + " FROM base"))
def io_orders_unparsed(spark, sf):
    return IO.unparsed_orders(spark, _orders_csv(spark, sf)).drop("customer_region")


@register("io_processed_fallback", with_base(PROCESSED_CTE, body="SELECT * FROM proc WHERE nps_score > 0"), _DOUBLES + ["desconto_pct"])
def io_processed_fallback(spark, sf):
    """No processed table: the V1 base is read, filtered to V2 and its features derived."""
    return IO.read_processed(spark, _folder(spark), _orders_csv(spark, sf), "csv", "v2")


_FAULTS = {"few": "order_id % 97 = 0", "many": "order_id % 89 = 0", "text": "order_id % 83 = 0"}


def _faulty_csv(spark, sf) -> tuple[str, list[str]]:
    """The base as CSV lines, some of them short, long or with a word for a number, and the columns."""
    base, path = IO.load_base(spark, sf), _folder(spark)
    first = ["order_id", *[c for c in base.columns if c != "order_id"]]
    values = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in first}
    values["customer_age"] = F.when(F.expr(_FAULTS["text"]), F.lit("old")).otherwise(values["customer_age"])
    line = F.concat_ws(",", *values.values())
    line = F.when(F.expr(_FAULTS["few"]), F.regexp_replace(line, ",[^,]*$", "")).when(F.expr(_FAULTS["many"]), F.concat(line, F.lit(",1"))).otherwise(line)
    base.select(line.alias("value")).write.text(path)
    return path, first


@register("io_orders_quarantine", with_base(body=f"""SELECT order_id, CASE WHEN {_FAULTS['few']} OR {_FAULTS['many']} THEN NULL ELSE 'customer_age' END AS column_name,
    CASE WHEN {_FAULTS['few']} OR {_FAULTS['many']} THEN NULL ELSE 'old' END AS text FROM base WHERE {' OR '.join(_FAULTS.values())}"""))
def io_orders_quarantine(spark, sf):
    """Quarantined records of a file with planted faults, by their order id."""
    _, faults = IO.read_orders_checked(spark, *_faulty_csv(spark, sf))
    return faults.select(F.regexp_extract("record", "^[0-9]+", 0).cast("bigint").alias("order_id"), F.col("column").alias("column_name"),
                         F.when(F.col("column").isNotNull(), F.col("text")).alias("text"))


@register("io_orders_clean", with_base(body=f"SELECT * FROM base WHERE NOT ({' OR '.join(_FAULTS.values())})"), _DOUBLES)
def io_orders_clean(spark, sf):
    """The clean rows beside the quarantine."""
    return IO.read_orders_checked(spark, *_faulty_csv(spark, sf))[0]


REGRESSION = {"mae": "MAE", "rmse": "RMSE", "r2": "R²"}
CLASSIFICATION = {"accuracy": "Accuracy", "precision": "Precision", "recall": "Recall", "f1": "F1", "auc": "AUC"}


def version_metrics(spark, sf, task, models):
    """Hold-out metrics of the models on both versions of the base."""
    parts = [FIT.holdout_metrics(FT.model_frame(IO.load_base(spark, sf), "full_v1", "select", v), "full_v1", task, models, version_tag=v) for v in ("v1", "v2")]
    return parts[0].unionByName(parts[1])


def comparison_tables(spark, sf, regressors=("linear", "ridge"), classifiers=("logistic",)) -> dict:
    """The four report tables; the models are those that the report's SQL can fit too."""
    base = IO.load_base(spark, sf)
    return {"visao_geral": ST.version_overview(base).select("metrica", "v1", "v2", "delta"), "correlacoes": ST.corr_change(base, CORR_FULL),
            "regressao": IO.metric_table(version_metrics(spark, sf, "reg", list(regressors)), REGRESSION, "r2", list(regressors)),
            "classificacao": IO.metric_table(version_metrics(spark, sf, "clf", list(classifiers)), CLASSIFICATION, "f1", list(classifiers))}


def _published(spark, sf, *names) -> dict[str, str]:
    folder, made = _folder(spark), comparison_tables(spark, sf) if set(names) & {"regressao", "classificacao"} else None
    if made is None:
        base = IO.load_base(spark, sf)
        made = {"visao_geral": ST.version_overview(base).select("metrica", "v1", "v2", "delta"), "correlacoes": ST.corr_change(base, CORR_FULL)}
    IO.write_comparison(made, folder)
    return IO.published(spark, folder)


@register("io_comparison_overview", f"""SELECT metrica, FALSE AS is_text, CAST(NULL AS VARCHAR) AS v1_text, CAST(NULL AS VARCHAR) AS v2_text,
    CAST(NULL AS VARCHAR) AS delta_text, v1 AS v1_num, v2 AS v2_num, delta AS delta_num FROM ({OVERVIEW_SQL}) o""", "v1_num v2_num delta_num")
def io_comparison_overview(spark, sf):
    return IO.read_metric_table(spark, _published(spark, sf, "visao_geral")["visao_geral"])


@register("io_comparison_correlations", CORR_CHANGE_SQL, "v1 v2 delta delta_abs")
def io_comparison_correlations(spark, sf):
    types = "variable string, v1 double, v2 double, delta double, delta_abs double, mudanca string"
    return spark.read.option("header", True).schema(types).csv(_published(spark, sf, "correlacoes")["correlacoes"])


def _report_sql(task) -> str:
    ctes, parts = [], []
    for v in ("v1", "v2"):
        if task == "reg":
            lin, rid = (Design(f"{m}{v}", "full", "random", "stddev_samp", v, dummies_scaled=False, regions=r) for m, r in (("l", None), ("r", REGIONS)))
            ctes += [*lin.ctes, *lin.least_squares(f"fl{v}"), *rid.ctes, *rid.least_squares(f"fr{v}", 1)]
            found = [regression_sql(lin, f"fl{v}", "linear"), regression_sql(rid, f"fr{v}", "ridge")]
        else:
            log = Design(f"c{v}", "full", "stratified", "stddev_samp", v, dummies_scaled=False, regions=REGIONS)
            ctes += [*log.ctes, *log.logistic(f"fc{v}", False)]
            found = [classification_sql(log, f"fc{v}", "logistic")]
        parts += [f"SELECT *, '{v}' AS version, {i} AS place FROM ({f}) {v}{i}" for i, f in enumerate(found)]
    shown, by = (REGRESSION, "r2") if task == "reg" else (CLASSIFICATION, "f1")
    name = "CASE metric " + " ".join(f"WHEN '{m}' THEN '{s}'" for m, s in shown.items()) + " END"
    return with_models(*ctes, f"parts AS ({' UNION ALL '.join(parts)})",
                       f"best AS (SELECT version, arg_max(model, (value, -place)) AS model FROM parts WHERE metric = '{by}' GROUP BY version)",
                       "won AS (SELECT p.* FROM parts p JOIN best b ON b.version = p.version AND b.model = p.model)",
                       body=f"""SELECT {name} AS metrica, FALSE AS is_text, max(value) FILTER (WHERE version = 'v1') AS v1_num, max(value) FILTER (WHERE version = 'v2') AS v2_num,
    CAST(NULL AS VARCHAR) AS v1_text, CAST(NULL AS VARCHAR) AS v2_text FROM won GROUP BY metric
UNION ALL SELECT 'modelo_' || version, TRUE, NULL, NULL, CASE WHEN version = 'v1' THEN model END, CASE WHEN version = 'v2' THEN model END FROM best""")


@register("io_comparison_regression", _report_sql("reg"), "v1_num v2_num")
def io_comparison_regression(spark, sf):
    return IO.read_metric_table(spark, _published(spark, sf, "regressao")["regressao"])


@register("io_comparison_classification", _report_sql("clf"), "v1_num v2_num")
def io_comparison_classification(spark, sf):
    return IO.read_metric_table(spark, _published(spark, sf, "classificacao")["classificacao"])
