"""Evaluation on a scored table (ML15-ML18, SO5, SO6, ML23).

All metrics are plain aggregates over the scored rows, so one pass yields
every metric; ROC, AUC and the threshold sweep work on the per-score
frequency table (bounded by distinct scores), never on sorted rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxpop.functions.ranks import cumulative
from voxpop.schema import THRESHOLDS_PCT


def _long(row: DataFrame, names, model: str | None = None) -> DataFrame:
    structs = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    out = row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
    return out.withColumn("model", F.lit(model)) if model else out


def regression_metrics(scored: DataFrame, y: str = "nps_score", pred: str = "prediction",
                       model: str | None = None, long: bool = False) -> DataFrame:
    """MAE, RMSE, R² in one pass: R² = 1 - SS_res / SS_tot with
    SS_tot = n * var_pop(y) (Spark's variance merges partial moments, so it
    stays numerically stable without a separate pass for the mean)."""
    e = F.col(y) - F.col(pred)
    ss_tot = F.var_pop(F.col(y)) * F.count(F.col(y))
    row = scored.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                     (1 - F.sum(e * e) / F.nullif(ss_tot, F.lit(0.0))).alias("r2"),
                     F.count(F.lit(1)).alias("n"))
    return _long(row, ["mae", "rmse", "r2"], model) if long else row


def classification_metrics(scored: DataFrame, y: str = "label", pred: str = "prediction",
                           model: str | None = None, long: bool = False) -> DataFrame:
    """Accuracy, precision, recall, F1 of the positive class; a zero
    denominator gives 0 (sklearn's zero_division)."""
    yy, pp = F.col(y) == 1, F.col(pred) == 1
    tp, fp, fn = F.count_if(yy & pp), F.count_if(~yy & pp), F.count_if(yy & ~pp)
    row = scored.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), F.count(F.lit(1)).alias("n"),
                     F.count_if(F.col(y) == F.col(pred)).alias("hits"))
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    prec = z(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    rec = z(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    row = row.select((F.col("hits") / F.col("n")).alias("accuracy"), prec.alias("precision"),
                     rec.alias("recall"), F.col("n"))
    row = row.withColumn("f1", z(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    return _long(row, ["accuracy", "precision", "recall", "f1"], model) if long else row


def class_report(scored: DataFrame, y: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision / recall / F1 / support, one pass."""
    hit = lambda c: (F.col(y) == c, F.col(pred) == c)
    row = scored.agg(*[n for c in (0, 1) for yy, pp in [hit(c)]
                       for n in (F.count_if(yy & pp).alias(f"tp{c}"), F.count_if(pp).alias(f"pp{c}"), F.count_if(yy).alias(f"yy{c}"))])
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    cells = [F.struct(F.lit(c).alias("classe"), z(F.col(f"tp{c}").cast("double"), F.col(f"pp{c}")).alias("precision"),
                      z(F.col(f"tp{c}").cast("double"), F.col(f"yy{c}")).alias("recall"), F.col(f"yy{c}").alias("support")) for c in (0, 1)]
    return (row.select(F.inline(F.array(*cells)))
            .withColumn("f1", z(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))


def confusion(scored: DataFrame, y: str = "label", pred: str = "prediction") -> DataFrame:
    """ML17: the four cells, always present."""
    spark = scored.sparkSession
    cells = spark.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)], f"{y} int, {pred} int")
    counts = scored.groupBy(y, pred).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(cells).join(counts, [y, pred], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def score_frequencies(scored: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    return (scored.filter(F.col(score).isNotNull()).groupBy(score)
            .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")))


def roc_points(scored: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    """ML18: (fpr, tpr) at every distinct score, descending, plus (0, 0).
    The running positive / negative counts from the top score down come from
    the distributed cumulative counts over the negated score, never from one window over all scores."""
    f = (score_frequencies(scored, y, score)
         .withColumn("n", F.col("pos") + F.col("neg")).withColumn("_desc", -F.col(score).cast("double")))
    r = cumulative(f, "_desc", also=["pos", "neg"])
    pts = r.select(F.col(score).cast("double").alias("threshold"),
                   ((F.col("cum_before_pos") + F.col("pos")) / F.col("total_pos")).alias("tpr"),
                   ((F.col("cum_before_neg") + F.col("neg")) / F.col("total_neg")).alias("fpr"))
    origin = scored.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, tpr double, fpr double")
    return pts.unionByName(origin)


def auc_rank(scored: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    """AUC = (sum of positive ranks - n+(n+ + 1)/2) / (n+ n-), average ranks
    for tied scores (= Mann-Whitney U / (n+ n-))."""
    f = score_frequencies(scored, y, score).withColumn("n", F.col("pos") + F.col("neg"))
    r = cumulative(f, score)
    row = r.agg(F.sum(F.col("pos") * F.col("avg_rank")).alias("R"), F.sum("pos").alias("n_pos"),
                F.sum("neg").alias("n_neg"))
    npos, nneg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    return row.select(((F.col("R") - npos * (npos + 1) / 2) / F.nullif(npos * nneg, F.lit(0.0))).alias("auc"),
                      "n_pos", "n_neg")


def threshold_sweep(scored: DataFrame, y: str = "label", score: str = "score",
                    thresholds_pct=THRESHOLDS_PCT) -> DataFrame:
    """ML16: recall / precision / F1 at thresholds i/100 (predict positive
    when score >= t).  Histogram + suffix sums: each row gets the number of
    thresholds it reaches (a fixed comparison chain), positives and negatives
    are counted per such bucket in one aggregation, and the counts at a
    threshold are the sums over the buckets from it upward (a window over at
    most len(thresholds) + 1 rows)."""
    spark = scored.sparkSession
    ts = sorted(int(t) for t in thresholds_pct)
    reached = sum((F.col(score) >= F.lit(t) / F.lit(100.0)).cast("int") for t in ts)
    hist = (scored.filter(F.col(score).isNotNull()).groupBy(reached.alias("k"))
            .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")))
    # threshold number k (1-based, ascending) is reached by buckets >= k
    th = spark.createDataFrame([(k + 1, t) for k, t in enumerate(ts)], "k int, t_pct int") \
        .withColumn("threshold", F.col("t_pct") / F.lit(100.0))
    up = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = (F.broadcast(th).join(hist, "k", "full")
            .withColumn("tp", F.sum(F.coalesce("pos", F.lit(0))).over(up))
            .withColumn("fp", F.sum(F.coalesce("neg", F.lit(0))).over(up))
            .withColumn("_pos", F.sum("pos").over(Window.partitionBy()))
            .filter(F.col("t_pct").isNotNull()))
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = full.select("t_pct", "threshold", "tp", "fp",
                      z(F.col("tp").cast("double"), F.col("_pos")).alias("recall"),
                      z(F.col("tp").cast("double"), F.col("tp") + F.col("fp")).alias("precision"))
    return out.withColumn("f1", z(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """SO6: first (lowest) threshold with the maximum F1."""
    w = Window.orderBy(F.desc("f1"), F.asc("t_pct"))
    return sweep.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")


def compare_thresholds(scored: DataFrame, y: str = "label", score: str = "score", default_pct: int = 50,
                       thresholds_pct=THRESHOLDS_PCT) -> DataFrame:
    """ML16: the default threshold against the one with the best F1, a row each:
    recall, precision, F1, the four cells of the confusion matrix and the gain in
    F1 over the default.  The default is only compared, not a candidate, unless
    listed.  Rows without a score count nowhere."""
    listed = [int(t) for t in thresholds_pct]
    sweep = threshold_sweep(scored, y, score, sorted({*listed, int(default_pct)}))
    default = sweep.filter(F.col("t_pct") == int(default_pct)).withColumn("corte", F.lit("padrão"))
    best = best_threshold(sweep.filter(F.col("t_pct").isin(listed))).withColumn("corte", F.lit("otimizado"))
    of = scored.filter(F.col(score).isNotNull()).agg(F.struct(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))).scalar()
    base = F.max(F.when(F.col("corte") == "padrão", F.col("f1"))).over(Window.partitionBy())
    return default.unionByName(best).select(
        "corte", "t_pct", "threshold", "recall", "precision", "f1", F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("fp", F.lit(0)).alias("fp"), (of["pos"] - F.coalesce("tp", F.lit(0))).alias("fn"),
        (of["neg"] - F.coalesce("fp", F.lit(0))).alias("tn"), (F.col("f1") - base).alias("ganho_f1"))


def best_model(metrics: DataFrame, metric: str, order: list[str], higher: bool = True) -> DataFrame:
    """SO5: best model by a metric; ties go to the earlier declared model."""
    spark = metrics.sparkSession
    dim = spark.createDataFrame(list(enumerate(order)), "ordem int, model string")
    m = metrics.filter(F.col("metric") == metric).join(F.broadcast(dim), "model")
    key = F.desc("value") if higher else F.asc("value")
    w = Window.orderBy(key, F.asc("ordem"))
    return m.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")


def single_class(df: DataFrame, y: str = "label") -> bool:
    """ML23: True when the label has fewer than two classes (skip the fit)."""
    return df.select(y).distinct().limit(2).count() < 2
