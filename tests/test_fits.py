"""Gram and Newton fits against numpy, fold scores against a loop, node tables
against the model they come from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxpop.ml import fit as FIT
from voxpop.ml import normal as NM
from voxpop.ml import split as SP
from voxpop.ml import trees as TR
from voxpop.operators.features import model_frame
from voxpop.sources.tables import load_base

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1, 50, 0.01] + [0, 1000, 5]
    y = x @ [1.0, -0.02, 30.0] + rng.normal(size=400)
    label = (y > np.median(y) + rng.normal(size=400)).astype(int)
    data = [(i, *map(float, a), 7.0, float(b), int(c), i % 4) for i, (a, b, c) in enumerate(zip(x, y, label))]
    df = spark.createDataFrame(data, "order_id long, a double, b double, c double, k double, y double, label int, fold int")
    z, _ = NM.standardised(df.repartition(5), {n: F.col(n) for n in "abck"}, F.lit(True))
    s = (x - x.mean(0)) / x.std(0)
    return z, np.hstack([np.ones((400, 1)), s, np.zeros((400, 1))]), y, label, np.arange(400) % 4


def test_ridge_of_every_fold_equals_numpy(rows):
    df, x, y, _, fold = rows
    got = NM.ridge_by_fold(df, "y", "fold", alpha=2.0)
    for f in range(4):
        a, b = x[fold != f], y[fold != f]
        beta = np.linalg.lstsq(a.T @ a + np.diag([0, 2, 2, 2, 2]), a.T @ b, rcond=None)[0]
        e = y[fold == f] - x[fold == f] @ beta
        assert got[f][0] == pytest.approx(beta, abs=1e-9)
        assert got[f][1] == pytest.approx(1 - (e @ e) / (400 // 4 * y[fold == f].var()), abs=1e-9)


@pytest.mark.parametrize("balanced", [False, True])
def test_newton_reaches_the_optimum_of_every_fold(rows, balanced):
    df, x, _, label, fold = rows
    got = NM.logistic(df, "label", "fold", [None, 0, 3], balanced=balanced)
    for f, beta in got.items():
        a, b = (x, label) if f is None else (x[fold != f], label[fold != f])
        w = np.where(b == 1, len(b) / (2 * b.sum()), len(b) / (2 * (1 - b).sum())) if balanced else np.ones(len(b))
        gradient = a.T @ (w * (1 / (1 + np.exp(-a @ beta)) - b)) + np.array([0, 1, 1, 1, 1]) * beta
        assert np.abs(gradient).max() < 1e-8


def test_fold_scores_and_probabilities_equal_a_loop(rows):
    df, x, _, label, fold = rows
    betas = NM.logistic(df, "label", "fold", range(4))
    got = {r["fold"]: r for r in NM.fold_scores(NM.probability(df, betas, "fold")).collect()}
    for f in range(4):
        s, t = 1 / (1 + np.exp(-x[fold == f] @ betas[f])), label[fold == f]
        pairs = (s[t == 1][:, None] > s[t == 0]).mean() + (s[t == 1][:, None] == s[t == 0]).mean() / 2
        assert got[f]["auc"] == pytest.approx(pairs, abs=1e-12)
        assert got[f]["f1"] == pytest.approx(2 * ((s > 0.5) & (t == 1)).sum() / ((s > 0.5).sum() + t.sum()), abs=1e-12)


def test_missing_values_and_separable_classes(spark):
    df = spark.createDataFrame([(1.0, 0, 0), (2.0, 0, 0), (3.0, 1, 0), (4.0, 1, 0)], "a double, label int, fold int")
    z, _ = NM.standardised(df, {"a": F.col("a")}, F.lit(True))
    assert np.isfinite(NM.logistic(z, "label")[None]).all()
    holed, _ = NM.standardised(df.unionByName(spark.createDataFrame([(None, 1, 0)], df.schema)), {"a": F.col("a")}, F.lit(True))
    with pytest.raises(ValueError, match="1 rows"):
        NM.gram(holed, "label", "fold")


def test_estimator_pipeline_agrees_with_newton_and_names_its_slots(spark):
    train = SP.with_weights(model_frame(load_base(spark, SF), "ops"), "label").withColumn("fold", F.lit(0))
    columns = FIT.design_columns(train, "ops")
    z, moments = NM.standardised(train, columns, F.lit(True))
    n = train.count()
    shrink = np.sqrt((n - 1) / n)  # the pipeline scales by the sample deviation
    model = FIT.fit(train, "ops", "nps_score", "ridge", alpha=1e-9)
    got = {r["feature"]: r["coefficient"] for r in FIT.coefficients(model).collect()}
    beta = NM.solve_ridge(NM.gram(z, "nps_score", "fold")[0], 1e-9)
    assert list(got) == ["intercept", *columns] and len(moments) == 21
    assert np.array(list(got.values())[1:]) * shrink == pytest.approx(beta[1:], abs=1e-6)
    full = FIT.fit(model_frame(load_base(spark, SF), "full_v1"), "full_v1", "nps_score", "linear")
    assert FIT.slot_names(full)[16] == "desconto_pct" and {s[:16] for s in FIT.slot_names(full)[17:]} == {"customer_region_"}


def test_cross_validation_of_all_six_pairs(spark):
    train = SP.stratified_split(model_frame(load_base(spark, SF), "ops"), "label").filter("split = 'train'").drop("split")
    for task, models, metrics in (("reg", ["ridge", "forest_reg", "gbt_reg"], {"r2"}), ("clf", ["logistic", "forest_clf", "gbt_clf"], {"f1", "auc"})):
        for m in models:
            out = {r["metric"]: r for r in FIT.cross_validate(train, "ops", task, m, k=3, trees=3, depth=3).collect()}
            assert set(out) == metrics and all(0.5 < r["mean"] <= 1 and 0 <= r["std"] < 0.2 and r["folds"] == 3 and r["model"] == m for r in out.values())


@pytest.mark.parametrize("name", ["forest_reg", "gbt_reg", "forest_clf", "gbt_clf"])
def test_node_tables_give_the_models_output_and_show_a_changed_leaf(spark, name):
    df = model_frame(load_base(spark, SF), "ops").persist()
    label = "label" if name.endswith("clf") else "nps_score"
    model = FIT.fit(df, "ops", label, name, trees=4, depth=5)
    scored = FIT.score(model, df)
    nodes = TR.node_table(spark, model.stages[-1]).persist()
    row = TR.compare(nodes, scored, name=name).first()
    assert (row["n_rows"], row["n_trees"], row["n_wrong"]) == (df.count(), 4, 0) and row["gap"] < 1e-9
    leaf = nodes.where("left < 0 and tree = 2").orderBy("node").first()
    hit = (F.col("tree") == 2) & (F.col("node") == leaf["node"])
    changed = nodes.withColumn("value", F.when(hit, F.col("value") + 0.25).otherwise(F.col("value")))
    assert TR.compare(changed, scored).first()["n_wrong"] > 0
    moved = nodes.withColumn("split", F.when((F.col("tree") == 1) & (F.col("node") == 0), F.col("split") - 1e6).otherwise(F.col("split")))
    assert TR.compare(moved, scored).first()["n_wrong"] > 0


def test_categories_are_refused_above_a_number(spark):
    df = spark.range(20).withColumn("c", F.col("id").cast("string"))
    assert len(FIT.category_labels(df, ["c"])["c"]) == 20
    with pytest.raises(ValueError, match="more than 10"):
        FIT.category_labels(df, ["c"], most=10)


def test_products_are_one_table_a_fold_and_task():
    import pyarrow as pa
    z, y, fold = np.arange(8.0).reshape(4, 2), np.array([1.0, 0, 2, 5]), np.array([0, 1, 0, 1], dtype=np.int32)
    batch = lambda s: pa.RecordBatch.from_arrays([pa.array(z[s].tolist()), pa.array(y[s]), pa.array(fold[s])], ["_z", "y", "fold"])
    out = list(NM._products([batch(slice(0, 3)), batch(slice(3, 4)), batch(slice(0, 0))]))
    v = np.hstack([np.ones((4, 1)), z, y[:, None]])
    assert [set(b.column("fold").to_pylist()) for b in out] == [{0}, {1}]
    for f, b in enumerate(out):
        assert np.array(b.column("v").to_pylist()).reshape(4, 4) == pytest.approx(v[fold == f].T @ v[fold == f])


def test_holdout_prepares_once_for_all_models(spark, monkeypatch):
    seen, real = [], FIT.refuse_missing
    monkeypatch.setattr(FIT, "refuse_missing", lambda df, num: (seen.append(df.columns), real(df, num)))
    df = model_frame(load_base(spark, SF), "full_v1")
    both = {(r["model"], r["metric"]): r["value"] for r in FIT.holdout_metrics(df, "full_v1", "reg", ["linear", "ridge"]).collect()}
    assert len(seen) == 1 and "order_id" not in seen[0] and "customer_id" not in seen[0]
    for m in ("linear", "ridge"):
        alone = {r["metric"]: r["value"] for r in FIT.holdout_metrics(df, "full_v1", "reg", [m]).collect()}
        assert all(both[m, k] == pytest.approx(v, abs=1e-12) for k, v in alone.items()) and len(alone) == 3


@pytest.mark.parametrize("task, models", [("clf", ["logistic", "forest_clf"]), ("reg", ["linear", "forest_reg"])])
def test_holdout_fits_its_models_at_once(spark, monkeypatch, task, models):
    import threading

    df, fit = model_frame(load_base(spark, SF), "full_v1"), FIT.fit
    alone = [tuple(r) for m in models for r in FIT.holdout_metrics(df, "full_v1", task, [m], trees=3).collect()]
    both = threading.Barrier(2, timeout=60)

    def meet(*a, **kw):
        both.wait()  # the second fit begins before the first ends
        return fit(*a, **kw)

    monkeypatch.setattr(FIT, "fit", meet)
    rows = FIT.holdout_metrics(df, "full_v1", task, models, trees=3)
    got = [tuple(r) for r in rows.collect()]
    at = [rows.columns.index(c) for c in ("model", "metric", "value")]
    named = lambda found: {(r[at[0]], r[at[1]]): r[at[2]] for r in found}
    assert [r[at[0]] for r in got] == [r[at[0]] for r in alone] and named(got) == pytest.approx(named(alone), abs=1e-9)


@pytest.mark.parametrize("name", ["forest_clf", "forest_reg"])
def test_forests_keep_node_ids_and_grow_the_same_trees(spark, name):
    df = model_frame(load_base(spark, SF), "demo").select("order_id", "nps_score", "label", *FIT.FEATURE_SETS["demo"][0]).persist()
    rows = FIT.prepare(df, "demo", scale=False).transform(df)
    est = FIT.estimator(name, "label" if name == "forest_clf" else "nps_score", trees=6, depth=14)
    assert est.getCacheNodeIds()
    # a megabyte holds few nodes, so a level takes several passes
    grown = [[t.toDebugString.split("\n", 1)[1] for t in est.copy({est.cacheNodeIds: cached, est.maxMemoryInMB: 1}).fit(rows).trees] for cached in (True, False)]
    assert grown[0] == grown[1] and len(grown[0]) == 6
    df.unpersist()


@pytest.mark.parametrize("name", ["forest_clf", "forest_reg"])
def test_node_ids_above_the_bound_are_not_kept(spark, monkeypatch, name):
    df = model_frame(load_base(spark, SF), "demo").persist()
    label, n = "label" if name == "forest_clf" else "nps_score", df.count()
    grown = []
    for most, kept in ((4 * 3 * n, True), (4 * 3 * n - 1, False)):
        monkeypatch.setattr(FIT, "NODE_IDS_BYTES", most)
        model = FIT.fit(df, "demo", label, name, trees=3, depth=6).stages[-1]
        assert model.getCacheNodeIds() == kept
        grown.append([t.toDebugString.split("\n", 1)[1] for t in model.trees])
    assert grown[0] == grown[1] and len(grown[0]) == 3
    df.unpersist()


def test_risk_scores_are_written_once_and_free_of_the_model(spark, monkeypatch):
    from voxpop.plans import q_model as Q
    fitted, scored_by, fit, score = [], [], FIT.fit, FIT.score
    monkeypatch.setattr(FIT, "fit", lambda *a, **kw: (fitted.append(fit(*a, **{**kw, "depth": 4}, trees=5)), fitted[-1])[1])
    monkeypatch.setattr(FIT, "score", lambda *a: (scored_by.append(a), score(*a))[1])
    rows = Q._risk_scored(spark, SF)
    assert rows.inputFiles() and all("/voxpop_scored/" in f for f in rows.inputFiles())
    got = {r["order_id"]: r["score"] for r in rows.collect()}
    again = {r["order_id"]: r["score"] for r in score(fitted[0], model_frame(load_base(spark, SF), "demo")).collect()}
    assert got == again and len(got) == load_base(spark, SF).count()
    assert Q.ml_risk_queue(spark, SF).count() > 0 and len(scored_by) == 2


def test_rows_are_not_shuffled_from_level_to_level_of_the_node_table(spark):
    x = np.random.default_rng(4).normal(size=(60, 2))
    unknown = lambda data, schema: spark.createDataFrame(spark.sparkContext.parallelize(data), schema)  # noqa: E731  (for Spark as large as can be)
    rows = unknown([(i, v.tolist()) for i, v in enumerate(x)], "order_id long, x array<double>")
    nodes = unknown([r for t in range(3) for r in ((t, 0, 1, 2, 0, 0.1 * t, None, 0.0, 0.5), (t, 1, 3, 4, 1, 0.0, None, 0.0, 0.5),
                                                   *[(t, n, -1, -1, -1, None, None, float(10 * t + n), 0.5) for n in (2, 3, 4)])],
                    "tree int, node int, left int, right int, feature int, split double, categories array<double>, value double, weight double")
    out = TR.derived(nodes, rows, "order_id", "x", TR.node_depth(nodes))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1  # the sum over the trees
    want = [sum(0.5 * (10 * t + (2 if v[0] > 0.1 * t else 3 if v[1] <= 0 else 4)) for t in range(3)) for v in x]
    assert {r["order_id"]: r["output"] for r in out.collect()} == pytest.approx(dict(enumerate(want)))


def test_csat_scenario_fits_both_regressors_at_once(spark, monkeypatch):
    import threading

    from voxpop.plans import q_model as Q
    both, real = threading.Barrier(2, timeout=60), FIT.holdout_metrics

    def metrics(*a, **kw):
        both.wait()  # the second fit begins before the first ends
        return real(*a, **{**kw, "trees": 3})

    monkeypatch.setattr(FIT, "holdout_metrics", metrics)
    got = {r["metric"]: (r["sem_csat"], r["com_csat"]) for r in Q.ml_csat_scenario(spark, SF).collect()}
    for i, s in enumerate(("ops", "ops_csat")):
        alone = {r["metric"]: r["value"] for r in real(Q.frame(spark, SF, s), s, "reg", ["gbt_reg"], trees=3).collect()}
        assert set(alone) == set(got) and all(got[m][i] == pytest.approx(v, abs=1e-9) for m, v in alone.items())
