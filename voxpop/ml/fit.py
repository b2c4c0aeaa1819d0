"""Preprocessing + estimator pipelines (ML3-ML13), scoring, CV, importances,
scenario comparison (ML19, ML20, ML22, ML24).

Parameters translate the study's estimators to Spark ML (tree counts and
depths are parameters; the study's values are the defaults).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from voxpop.ml import evaluate as EV
from voxpop.ml import normal as NM
from voxpop.schema import DROP_FIRST_SETS, FEATURE_SETS, STRATIFIED_SETS

REGRESSORS = ["linear", "ridge", "forest_reg", "gbt_reg"]
CLASSIFIERS = ["logistic", "forest_clf", "gbt_clf"]


MAX_CATEGORIES = 1000
NODE_IDS_BYTES = 8 << 30  # node ids that a forest keeps; Spark holds several generations of them, on disk where memory is short


def category_labels(df: DataFrame, cat, most: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted non-null values of each categorical column; refuses a column with
    more than ``most`` of them (each becomes a column of the design)."""
    out = {c: sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(most + 1).collect()) for c in cat}
    wide = [c for c, values in out.items() if len(values) > most]
    if wide:
        raise ValueError(f"more than {most} categories in: {', '.join(wide)}")
    return out


def dummies(labels: dict[str, list[str]]) -> tuple[SQLTransformer | None, list[str]]:
    """Drop-first 0/1 columns as a pipeline stage; a NULL or unseen category is
    all zeros."""
    quoted = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    cols = [(f"{c}_{v}", f"CASE WHEN `{c}` = {quoted(v)} THEN 1.0D ELSE 0.0D END") for c, vs in labels.items() for v in vs[1:]]
    if not cols:
        return None, []
    listed = ", ".join(f"{expr} AS `{name}`" for name, expr in cols)
    return SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__"), [name for name, _ in cols]


def refuse_missing(df: DataFrame, num) -> None:
    """Fail with the columns and counts when a numeric feature is NULL or NaN."""
    found = df.agg(*[F.count(F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), 1)).alias(c) for c in num]).first()
    bad = {c: found[c] for c in num if found[c]}
    if bad:
        raise ValueError("missing values in features: " + ", ".join(f"{c} ({n} rows)" for c, n in bad.items()))


def preprocess(num, cat, scale: bool = True, labels: dict[str, list[str]] | None = None) -> list:
    """ML3/ML4/ML5: numeric assembler, categories as one-hot, scaling, final
    assembler.  With ``labels`` (sorted categories) the categories become
    drop-first dummies and are scaled too, as all columns of that frame are in
    the study; otherwise frequency-indexed one-hot columns, unscaled, with an
    unknown or NULL category all zeros."""
    stages, inputs = [], []

    def block(cols, name):
        stages.append(VectorAssembler(inputCols=list(cols), outputCol=name, handleInvalid="error"))
        if scale:
            stages.append(StandardScaler(inputCol=name, outputCol=f"{name}_s", withMean=True, withStd=True))
        inputs.append(f"{name}_s" if scale else name)

    block(num, "_num")
    if cat and labels is not None:
        stage, cols = dummies(labels)
        if stage is not None:
            stages.append(stage)
            block(cols, "_cat")
    elif cat:
        idx = [f"{c}_idx" for c in cat]
        ohe = [f"{c}_ohe" for c in cat]
        stages.append(StringIndexer(inputCols=list(cat), outputCols=idx, handleInvalid="keep", stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
        inputs += ohe
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages


def estimator(name: str, label: str, trees: int = 200, depth: int | None = None, seed: int = 42,
              weight_col: str | None = None, reg_param: float = 0.0, node_ids: bool = True):
    w = {"weightCol": weight_col} if weight_col else {}
    if name == "linear":
        return LinearRegression(labelCol=label, solver="normal", **w)
    if name == "ridge":
        return LinearRegression(labelCol=label, solver="normal", elasticNetParam=0.0, regParam=reg_param,
                                standardization=False, **w)
    # cacheNodeIds: each row keeps its node in every tree; without it a level's tasks all receive the trees grown so far
    if name == "forest_reg":
        return RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=depth or 10,
                                     featureSubsetStrategy="all", seed=seed, cacheNodeIds=node_ids, **w)
    if name == "gbt_reg":
        return GBTRegressor(labelCol=label, maxIter=trees, maxDepth=depth or 6, stepSize=0.05,
                            subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed, **w)
    if name == "logistic":
        return LogisticRegression(labelCol=label, maxIter=1000, tol=1e-10, regParam=reg_param, elasticNetParam=0.0,
                                  standardization=False, **w)
    if name == "forest_clf":
        return RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth or 10,
                                      featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=node_ids, **w)
    if name == "gbt_clf":
        return GBTClassifier(labelCol=label, maxIter=trees, maxDepth=depth or 6, stepSize=0.05,
                             subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed, **w)
    raise ValueError(name)


def _reg_param(train: DataFrame, name: str, label: str, weight_col: str | None, alpha: float = 1.0,
               C: float = 1.0) -> float:
    """Penalty translation (one small aggregate):
    ridge alpha -> alpha / n * stddev_pop(y);  logistic C -> 1 / (C * sum(w))."""
    if name == "ridge":
        r = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
        return alpha / r["n"] * (r["s"] or 0.0)
    if name == "logistic":
        sw = train.agg(F.sum(F.col(weight_col)) if weight_col else F.count(F.lit(1))).first()[0]
        return 1.0 / (C * float(sw))
    return 0.0


def _node_ids(train: DataFrame, name: str, trees: int) -> bool:
    """Whether a forest keeps each row's node in every tree (4 bytes each); the
    trees are the same without, and rows are then led down from the root in each pass."""
    return name.startswith("forest") and 4 * trees * train.count() <= NODE_IDS_BYTES


def prepare(train: DataFrame, feature_set: str, scale: bool = True, num=None, cat=None, drop_first: bool | None = None) -> PipelineModel:
    """Preprocessing fitted on the training rows only.  ``drop_first``: categories
    as scaled drop-first dummies (default: as the feature set has it)."""
    fnum, fcat = FEATURE_SETS[feature_set]
    num, cat = num or fnum, fcat if cat is None else cat
    refuse_missing(train, num)
    drop_first = feature_set in DROP_FIRST_SETS if drop_first is None else drop_first
    labels = category_labels(train, cat) if drop_first else None
    return Pipeline(stages=preprocess(num, cat, scale, labels)).fit(train)


def fit(train: DataFrame, feature_set: str, label: str, name: str, trees: int = 200,
        depth: int | None = None, weight_col: str | None = None, scale: bool = True,
        alpha: float = 1.0, C: float = 1.0, num=None, cat=None, drop_first: bool | None = None,
        prepared: PipelineModel | None = None) -> PipelineModel:
    """Fit preprocessing + estimator on the training rows only.  ``prepared``: the
    result of ``prepare`` for these rows, to fit several estimators after it."""
    prepared = prepared or prepare(train, feature_set, scale, num, cat, drop_first)
    est = estimator(name, label, trees, depth, weight_col=weight_col,
                    reg_param=_reg_param(train, name, label, weight_col, alpha, C), node_ids=_node_ids(train, name, trees))
    return PipelineModel([*prepared.stages, est.fit(prepared.transform(train))])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``prediction`` and, for classifiers, ``score`` = P(positive)."""
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn("score", vector_to_array("probability")[1])
    return out


def holdout_metrics(df: DataFrame, feature_set: str, task: str, models, trees: int = 200,
                    weighted: bool = False, version_tag: str | None = None, stratified: bool | None = None) -> DataFrame:
    """Fit each model on the train split, all at once, and report test metrics, long
    form ``(model, metric, value)``; classification also reports AUC.  ``stratified``
    sets the split of a regression (default: as the feature set has it)."""
    from voxpop.ml.split import random_split, stratified_split, with_weights
    label = "nps_score" if task == "reg" else "label"
    if task == "clf" and EV.single_class(df, "label"):
        spark = df.sparkSession
        return spark.createDataFrame([], "metric string, value double, model string")
    stratified = feature_set in STRATIFIED_SETS if stratified is None else stratified
    split = stratified_split(df, "label") if task == "clf" or stratified else random_split(df)
    if weighted and task == "clf":
        split = with_weights(split, "label")
    num, cat = FEATURE_SETS[feature_set]
    split = split.select(*dict.fromkeys([label, "split", *num, *cat, *(["weight"] if "weight" in split.columns else [])])).cache()
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    prepared = prepare(train, feature_set)

    def one(m):
        model = fit(train, feature_set, label, m, trees=trees, weight_col="weight" if weighted else None, prepared=prepared)
        s = score(model, test)
        s = s.select(label, "prediction", *[c for c in ("score",) if c in s.columns]).persist()  # the metrics read it several times
        if task == "reg":
            return s, EV.regression_metrics(s, label, "prediction", m, long=True)
        return s, EV.classification_metrics(s, label, "prediction", m, long=True).unionByName(
            EV.auc_rank(s, label, "score").select(F.lit("auc").alias("metric"), F.col("auc").alias("value"),
                                                  F.lit(m).alias("model")))

    # the fits do not depend on each other: one computes while another waits for the end of a pass
    with ThreadPoolExecutor(len(models)) as pool:
        held, parts = zip(*pool.map(inheritable_thread_target(df.sparkSession)(one), models))
    out = reduce(DataFrame.unionByName, parts)
    if version_tag:
        out = out.withColumn("version", F.lit(version_tag))
    # materialise the small metric table before dropping the cached split
    res = df.sparkSession.createDataFrame(out.collect(), out.schema)
    for s in [split, *held]:
        s.unpersist()
    return res


def design_columns(df: DataFrame, feature_set: str) -> dict[str, Column]:
    """Named numeric columns of a feature set, its categories as drop-first dummies."""
    num, cat = FEATURE_SETS[feature_set]
    labels = category_labels(df, cat)
    return {c: F.col(c) for c in num} | {f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for c, vs in labels.items() for v in vs[1:]}


def cross_validate(train: DataFrame, feature_set: str, task: str, model: str, k: int = 5, trees: int = 200, depth: int | None = None) -> DataFrame:
    """ML19: k-fold cross-validation of one model on the training rows ->
    ``metric``, ``mean``, ``std`` (population), ``folds``, ``model``.

    Regression (R²): hash folds; classification (F1, AUC): stratified folds and
    balanced classes.  Linear, ridge and logistic are fitted for all folds
    together from Gram tables (one scan, or one a Newton step) on features scaled
    over the whole training part; the others fold by fold."""
    from voxpop.ml.split import key_hash, stratified_folds, with_weights
    y = "nps_score" if task == "reg" else "label"
    folded = train.withColumn("fold", (key_hash("order_id", 42, 8) % k).cast("int")) if task == "reg" else stratified_folds(train, "label", k)
    num, cat = FEATURE_SETS[feature_set]
    folded = folded.select(*dict.fromkeys(["nps_score", "label", "fold", *num, *cat])).persist()
    spark = train.sparkSession
    if model in ("linear", "ridge", "logistic"):
        rows, _ = NM.standardised(folded, design_columns(folded, feature_set), F.lit(True))
        rows = rows.select("_z", y, "fold")
        if task == "reg":
            fits = NM.ridge_by_fold(rows, y, "fold", 1.0 if model == "ridge" else 0.0)
            per_fold = spark.createDataFrame([(f, "r2", v) for f, (_, v) in fits.items()], "fold int, metric string, value double")
        else:
            betas = NM.logistic(rows, y, "fold", range(k), balanced=True)
            scored = NM.probability(rows, betas, "fold").select("label", "fold", "score").persist()
            found = [(r["fold"], m, r[m]) for r in NM.fold_scores(scored).collect() for m in ("f1", "auc")]
            scored.unpersist()
            per_fold = spark.createDataFrame(found, "fold int, metric string, value double")
    else:
        found = []
        for f in range(k):
            inside, test = folded.filter(F.col("fold") != f), folded.filter(F.col("fold") == f)
            if task == "clf":
                inside = with_weights(inside, "label")
            s = score(fit(inside, feature_set, y, model, trees=trees, depth=depth, weight_col="weight" if task == "clf" else None), test)
            if task == "reg":
                found.append((f, "r2", EV.regression_metrics(s, y).first()["r2"]))
            else:
                found += [(f, m, r[m]) for r in NM.fold_scores(s).collect() for m in ("f1", "auc")]
        per_fold = spark.createDataFrame(found, "fold int, metric string, value double")
    folded.unpersist()
    return (per_fold.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("folds"))
            .withColumn("model", F.lit(model)))


def slot_names(model: PipelineModel) -> list[str]:
    """Real names of the slots of ``features``: through assemblers, scalers (which
    drop the names) and encoders, whose slots are ``column_value``."""
    names: dict[str, list[str]] = {}
    for stage in model.stages[:-1]:
        kind = type(stage).__name__
        if kind == "VectorAssembler":
            names[stage.getOutputCol()] = [n for c in stage.getInputCols() for n in names.get(c, [c])]
        elif kind == "StandardScalerModel":
            names[stage.getOutputCol()] = names[stage.getInputCol()]
        elif kind == "StringIndexerModel":
            for c, out, labels in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray):
                names[out] = [f"{c}_{v}" for v in labels]
        elif kind == "OneHotEncoderModel":
            names |= {out: names[c] for c, out in zip(stage.getInputCols(), stage.getOutputCols())}
    return names["features"]


def coefficients(model: PipelineModel) -> DataFrame:
    """``pos``, ``feature``, ``coefficient`` of a fitted linear or logistic pipeline, the intercept first."""
    est = model.stages[-1]
    rows = [(0, "intercept", float(est.intercept))]
    rows += [(i + 1, n, float(v)) for i, (n, v) in enumerate(zip(slot_names(model), est.coefficients.toArray()))]
    return SparkSession.active().createDataFrame(rows, "pos int, feature string, coefficient double")


def importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """ML20: impurity importances with feature names, ordered."""
    rows = list(zip(slot_names(model), model.stages[-1].featureImportances.toArray().tolist()))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def compare_versions(metrics: DataFrame, lower_better=("mae", "rmse")) -> DataFrame:
    """ML22: metrics of two scenarios side by side with delta and verdict
    (lower is better for MAE/RMSE, higher otherwise)."""
    wide = (metrics.groupBy("model", "metric").pivot("version", ["v1", "v2"]).agg(F.first("value")))
    delta = F.col("v2") - F.col("v1")
    low = F.col("metric").isin(list(lower_better))
    verdict = (F.when(delta == 0, "igual")
               .when((low & (delta < 0)) | (~low & (delta > 0)), "melhor").otherwise("pior"))
    return wide.withColumn("delta", delta).withColumn("resultado", verdict)
