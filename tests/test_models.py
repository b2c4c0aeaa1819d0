"""Model operators: fits run, splits are exact and stable, attributions add up."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from voxpop.ml import evaluate as EV
from voxpop.ml import explain as XP
from voxpop.ml import fit as FIT
from voxpop.ml import split as SP
from voxpop.operators.features import model_frame
from voxpop.sources.tables import load_base

SF = "/root/testdata/sf0.001"


def test_stratified_split_exact_counts(spark):
    df = model_frame(load_base(spark, SF), "ops")
    s = SP.stratified_split(df, "label", 0.8)
    got = {(r["label"], r["split"]): r["n"] for r in s.groupBy("label", "split").count().withColumnRenamed("count", "n").collect()}
    for c in (0, 1):
        n = got[(c, "train")] + got[(c, "test")]
        assert got[(c, "test")] == -(-n * 2 // 10) or abs(got[(c, "test")] - n * 0.2) < 1
    folds = SP.stratified_folds(df, "label", 5).groupBy("label", "fold").count().collect()
    for c in (0, 1):
        sizes = [r["count"] for r in folds if r["label"] == c]
        assert max(sizes) - min(sizes) <= 1


def test_attributions_are_additive(spark):
    df = model_frame(load_base(spark, SF), "ops")
    model = FIT.fit(df, "ops", "label", "gbt_clf", trees=5)
    scored = FIT.score(model, df).withColumn("_m", vector_to_array("rawPrediction")[1])
    attr = XP.row_attributions(model, scored)
    gap = attr.join(scored.select("order_id", "_m"), "order_id") \
        .agg(F.max(F.abs(F.col("raw") - F.col("_m")))).first()[0]
    assert gap < 1e-6


def test_attributions_are_the_same_for_any_group_of_trees(spark):
    import numpy as np
    df = model_frame(load_base(spark, SF), "ops")
    for name, label in (("gbt_reg", "nps_score"), ("forest_reg", "nps_score")):
        model = FIT.fit(df, "ops", label, name, trees=5, depth=4)
        scored = FIT.score(model, df).select("order_id", "features", "prediction")
        one, many = ({r["order_id"]: r for r in XP.row_attributions(model, scored, margin="prediction", group_nodes=n).collect()} for n in (10**6, 40))
        assert set(one) == set(many) and len(one) == df.count()
        for i, r in one.items():
            assert np.allclose(r["phi"], many[i]["phi"], atol=1e-12) and r["gap"] < 1e-9 and many[i]["gap"] < 1e-9


def test_holdout_metrics_shape(spark):
    df = model_frame(load_base(spark, SF), "full_v1")
    m = FIT.holdout_metrics(df, "full_v1", "clf", ["logistic"])
    assert {r["metric"] for r in m.collect()} == {"accuracy", "precision", "recall", "f1", "auc"}


def test_regression_holdout_on_model_scores(spark):
    # metrics aggregate over model output (a non-deterministic plan for Spark)
    df = model_frame(load_base(spark, SF), "full_v1")
    m = {r["metric"]: r["value"] for r in FIT.holdout_metrics(df, "full_v1", "reg", ["linear"]).collect()}
    assert set(m) == {"mae", "rmse", "r2"} and 0 <= m["mae"] <= m["rmse"] and m["r2"] <= 1


def test_null_region_is_all_zeros_and_null_number_is_named(spark):
    import pytest
    df = model_frame(load_base(spark, SF), "ops")
    holed = df.withColumn("customer_region", F.when(F.col("order_id") % 7 == 0, None).otherwise(F.col("customer_region")))
    model = FIT.fit(holed, "ops", "label", "logistic")
    scored = FIT.score(model, holed)
    assert scored.count() == df.count()
    zeros = scored.filter("customer_region IS NULL").select(*[F.sum(c).alias(c) for c in scored.columns if c.startswith("customer_region_")]).first()
    assert len(zeros) == 4 and not any(zeros)
    broken = df.withColumn("freight_value", F.when(F.col("order_id") % 11 == 0, None).otherwise(F.col("freight_value")))
    with pytest.raises(ValueError, match="freight_value"):
        FIT.fit(broken, "ops", "nps_score", "linear")


def test_registered_ensembles_fit_the_studys_tree_count(spark, monkeypatch):
    import pytest
    from voxpop.plans import catalog
    catalog.load_all()

    class Seen(Exception):
        pass

    real = FIT.estimator

    def estimator(name, *args, **kw):
        est = real(name, *args, **kw)
        if name.startswith(("forest", "gbt")):
            raise Seen(est.getNumTrees() if name.startswith("forest") else est.getMaxIter())
        return est

    monkeypatch.setattr(FIT, "estimator", estimator)
    for q in ("forest_reg", "gbt_reg", "forest_clf", "gbt_clf", "best_model", "best_classifier", "importance", "attribution", "attribution_reg", "tree_certificate",
              "csat_scenario", "risk_bands", "top_risk", "risk_queue"):
        with pytest.raises(Seen) as seen:
            catalog.QUERIES[f"ml_{q}"](spark, SF)
        assert seen.value.args == (200,), q


def _given(spark):
    rng = np.random.default_rng(9)
    score = rng.integers(0, 101, 400) / 100
    label = (rng.uniform(size=400) < score).astype(int)
    rows = [(int(a), float(b)) for a, b in zip(label, score)] + [(1, None), (0, None)]
    return rows, spark.createDataFrame(rows, "label int, score double")


@pytest.mark.parametrize("default", [50, 33])
def test_default_and_best_threshold_equal_brute_force(spark, default):
    rows, df = _given(spark)
    known = [(a, b) for a, b in rows if b is not None]

    def at(t):
        cells = [sum(1 for a, b in known if a == y and (b >= t / 100) == p) for y, p in ((1, True), (0, True), (1, False), (0, False))]
        tp, fp, fn, _ = cells
        return [*cells, 2 * tp / (2 * tp + fp + fn)]
    best = max(range(10, 90, 5), key=lambda t: (at(t)[-1], -t))
    got = {r["corte"]: r for r in EV.compare_thresholds(df, default_pct=default).collect()}
    for name, t in (("padrão", default), ("otimizado", best)):
        r = got[name]
        assert r["t_pct"] == t and [r["tp"], r["fp"], r["fn"], r["tn"]] == at(t)[:4]
        assert r["f1"] == pytest.approx(at(t)[-1]) and r["ganho_f1"] == pytest.approx(at(t)[-1] - at(default)[-1])


def test_threshold_comparison_without_a_score(spark):
    out = EV.compare_thresholds(spark.createDataFrame([], "label int, score double")).collect()
    assert {r["corte"] for r in out} == {"padrão", "otimizado"}
    assert all((r["tp"], r["fp"], r["fn"], r["tn"], r["f1"]) == (0, 0, 0, 0, 0.0) for r in out)


def test_positive_scale(spark):
    row = SP.positive_scale(spark.createDataFrame([(1,), (0,), (0,), (None,)], "label int")).first()
    assert (row["n_pos"], row["n_neg"], row["scale_pos"]) == (1, 2, 2.0)
    assert SP.positive_scale(spark.createDataFrame([(0,)], "label int")).first()["scale_pos"] is None
    assert SP.positive_scale(spark.createDataFrame([], "label int")).first()["scale_pos"] is None


@pytest.mark.parametrize("with_categories", [False, True])
def test_attributions_equal_a_walk_and_credit_each_leaf_once(with_categories):
    rng = np.random.default_rng(5)
    rows = []
    for t in range(3):
        for i in range(31):
            leaf, cats = i >= 15, with_categories and i % 4 == 1
            rows.append({"tree": t, "node": i, "left": -1 if leaf else 2 * i + 1, "right": -1 if leaf else 2 * i + 2, "feature": -1 if leaf else 3 if cats else int(rng.integers(0, 3)),
                         "split": None if leaf or cats else float(rng.normal()), "categories": [0.0, 2.0] if cats and not leaf else None, "value": float(rng.normal()), "weight": 0.5})
    x = np.hstack([rng.normal(size=(50, 3)), rng.integers(0, 4, (50, 1))])
    x[7, :3] = np.nan
    at = {(r["tree"], r["node"]): r for r in rows}
    want, base = np.zeros((50, 4)), sum(0.5 * at[t, 0]["value"] for t in range(3))
    for k, row in enumerate(x):
        for t in range(3):
            r = at[t, 0]
            while r["left"] >= 0:
                lower = row[r["feature"]] in r["categories"] if r["categories"] else row[r["feature"]] <= r["split"]
                below = at[t, r["left"] if lower else r["right"]]
                want[k, r["feature"]] += 0.5 * (below["value"] - r["value"])
                r = below
    trees, weights = XP._arrays(rows)
    got = XP._attribute(x, trees, weights, 4)
    assert got[0] == pytest.approx(base) and got[1] == pytest.approx(want, abs=1e-12)
    assert all(len(XP._leaves(x, arr)) == 50 and (XP._leaves(x, arr) >= 15).all() for arr in trees)
