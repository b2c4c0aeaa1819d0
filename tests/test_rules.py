"""Hand-made edge fixtures: class rules, bands, guarded ratios, correlation
of a constant column, duplicates, empty bands, rank-test ties, AUC extremes,
zero-division metrics, single-class guard, sign flip, residual bands."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxpop.functions import columns as C
from voxpop.functions.pvalues import chi2_sf, t_two_sided
from voxpop.functions.ranks import exact_quantiles, ranked_values
from voxpop.ml import evaluate as EV
from voxpop.operators import quality as Q
from voxpop.operators import stats as ST
from voxpop.operators import summary as S
from voxpop.schema import ORDERS_NPS_SCHEMA

SCORES = [0.0, 0.1, 5.9, 6.0, 6.1, 6.5, 6.99, 7.0, 7.5, 8.0, 8.5, 8.99, 9.0, 10.0, None]


def test_class_rules(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SCORES)], "order_id long, nps_score double")
    rows = df.select("nps_score", C.nps_class("nps_score", "floor").alias("f"),
                     C.nps_class("nps_score", "select").alias("s"), C.nps_class("nps_score", "cut").alias("c"),
                     C.is_detractor("nps_score", "select").alias("d")).collect()
    got = {r["nps_score"]: (r["f"], r["s"], r["c"], r["d"]) for r in rows}
    assert got[6.5] == ("Detrator", "Neutro", "Neutro", 0)
    assert got[6.99] == ("Detrator", "Neutro", "Neutro", 0)
    assert got[8.5] == ("Neutro", "Neutro", "Promotor", 0)
    assert got[8.99] == ("Neutro", "Neutro", "Promotor", 0)
    assert got[9.0] == ("Promotor", "Promotor", "Promotor", 0)
    assert got[6.0] == ("Detrator", "Detrator", "Detrator", 1)
    assert got[0.0] == ("Detrator", "Detrator", "Detrator", 1)
    assert got[None] == (None, "Sem classificação", None, 0)


def test_band_edges_right_closed(spark):
    xs = [-1, 0, 1, 2, 3, 4, 5, 6, 10, 11, 12, 25, 26, 35, 36, 50, 51, 72, 73, 100, 101, 999, 1000]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, x int")
    edges = [-1, 0, 2, 5, 999]
    out = {r["x"]: r["b"] for r in df.select("x", C.band_id("x", edges).alias("b")).collect()}
    assert out[-1] is None and out[0] == 0 and out[1] == 1 and out[2] == 1 and out[3] == 2
    assert out[5] == 2 and out[6] == 3 and out[999] == 3 and out[1000] is None
    low = {r["x"]: r["b"] for r in df.select("x", C.band_id("x", [-1, 0, 1, 3, 5, 10, None], True).alias("b")).collect()}
    assert low[-1] == 0 and low[11] == 5 and low[1000] == 5


def test_guarded_ratios(spark):
    df = spark.createDataFrame([(0.0, 5.0, 3.0), (10.0, 0.0, 0.0), (None, 1.0, 1.0)],
                               "order_value double, discount_value double, freight_value double")
    r = df.select(C.ratio_or_zero("discount_value", "order_value").alias("p"),
                  C.ratio_if_positive("freight_value", "order_value").alias("f")).collect()
    assert [x["p"] for x in r] == [0.0, 0.0, 0.0]
    assert [x["f"] for x in r] == [None, 0.0, None]


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(10)], "x double, y double")
    assert df.agg(C.safe_corr("x", "y").alias("r")).first()["r"] is None
    assert ST.pearson_with(df, ["x"], "y").first()["r"] is None


def _base_rows(n, **over):
    cols = [f.name for f in ORDERS_NPS_SCHEMA.fields]
    rows = []
    for i in range(n):
        r = {c: 0 for c in cols}
        r.update(customer_id=i, order_id=i, customer_region="ASIA", order_value=100.0, discount_value=1.0,
                 freight_value=2.0, nps_score=5.0, csat_internal_score=5.0, customer_age=30)
        r.update({k: (v(i) if callable(v) else v) for k, v in over.items()})
        rows.append(tuple(r[c] for c in cols))
    return rows


def test_duplicates_and_keys(spark):
    rows = _base_rows(3)
    rows.append(rows[0])
    df = spark.createDataFrame(rows, ORDERS_NPS_SCHEMA)
    d = Q.duplicate_rows(df).first()
    assert (d["n_rows"], d["n_distinct_rows"], d["duplicate_rows"]) == (4, 3, 1)
    k = {r["key_column"]: r for r in Q.duplicate_keys(df, ("order_id", "missing_col")).collect()}
    assert k["order_id"]["duplicates"] == 1 and k["missing_col"]["present"] is False


def test_range_check_flags_violation(spark):
    df = spark.createDataFrame(_base_rows(3, customer_age=lambda i: 130 if i == 0 else 30), ORDERS_NPS_SCHEMA)
    res = {r["coluna"]: r["ok"] for r in Q.range_check(df).collect()}
    assert res["customer_age"] is False and res["nps_score"] is True


def test_empty_band_kept(spark):
    from voxpop.operators.features import service_features
    df = service_features(spark.createDataFrame(_base_rows(5, customer_service_contacts=lambda i: i % 2),
                                                ORDERS_NPS_SCHEMA))
    out = {r["band"]: r["qtd_clientes"] for r in S.band_summary(df, "contact_range").collect()}
    assert out == {"Nenhum": 3, "1-2 contatos": 2, "3+ contatos": 0}


TIES = [("a", v) for v in (1, 2, 2, 3, 5, 7)] + [("b", v) for v in (2, 4, 6, 6, 8, 9, 9)]


def test_kruskal_and_mann_whitney_with_ties(spark):
    df = spark.createDataFrame(TIES, "g string, v int")
    k = ST.kruskal(df, "v", "g").first()
    assert k["h_stat"] == pytest.approx(3.506784, abs=1e-6)
    assert k["p_value"] == pytest.approx(chi2_sf(3.506784, 1), abs=1e-6)
    m = ST.mann_whitney_pairs(df, "v", "g", groups=("a", "b")).first()
    u1 = m["u_stat"]
    assert u1 + (6 * 7 - u1) == 42
    # Kruskal with two groups equals z^2 of Mann-Whitney without continuity
    n1, n2 = 6, 7
    ties = (3 ** 3 - 3) + (2 ** 3 - 2) + (2 ** 3 - 2)  # value 2 three times, 6 and 9 twice
    sigma = math.sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1))))
    z0 = (u1 - n1 * n2 / 2) / sigma
    assert z0 * z0 == pytest.approx(k["h_stat"], rel=1e-9)


def test_perfect_reversed_tied_auc(spark):
    def auc(rows):
        df = spark.createDataFrame(rows, "label int, score double")
        return EV.auc_rank(df).first()["auc"]
    assert auc([(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)]) == 1.0
    assert auc([(1, 0.1), (1, 0.2), (0, 0.8), (0, 0.9)]) == 0.0
    assert auc([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)]) == 0.5


def test_zero_division_metrics_and_confusion(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "label int, prediction int")
    m = EV.classification_metrics(df).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0
    cells = {(r["label"], r["prediction"]): r["n"] for r in EV.confusion(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 2, (1, 1): 0}


def test_single_class_guard(spark):
    assert EV.single_class(spark.createDataFrame([(1,), (1,)], "label int"))
    assert not EV.single_class(spark.createDataFrame([(1,), (0,)], "label int"))


def test_sign_flip_verdict(spark):
    # with zeros: positive correlation; without zeros (nps > 0): negative
    rows = [(0.0, 0.0)] * 5 + [(5.0, 9.0), (6.0, 8.0), (7.0, 7.0), (8.0, 6.0), (9.0, 5.0)]
    df = spark.createDataFrame(rows, "x double, nps_score double")
    r = ST.corr_change(df, ["x"]).first()
    assert r["v1"] > 0 and r["v2"] < 0 and r["mudanca"] == "inverteu sinal"


def test_residual_band_excludes_zero(spark):
    df = spark.createDataFrame([(0.0, 1.0), (3.0, 2.0), (9.5, 9.0)], "nps_score double, prediction double")
    out = {r["band"]: r["n"] for r in ST.residual_bands(df).collect()}
    assert out == {"0-3": 1, "4-6": 0, "7-8": 0, "9-10": 1}
    incl = {r["band"]: r["n"] for r in ST.residual_bands(df, include_lowest=True).collect()}
    assert incl["0-3"] == 2


def test_pvalue_closed_forms():
    for h in (0.5, 3.0, 11.2):
        assert chi2_sf(h, 2) == pytest.approx(math.exp(-h / 2), rel=1e-12)
        assert chi2_sf(h, 4) == pytest.approx(math.exp(-h / 2) * (1 + h / 2), rel=1e-12)
    assert t_two_sided(2.0, 10) == pytest.approx(0.0733880347707404, rel=1e-9)


def test_exact_quantiles_match_pandas(spark):
    vals = [float((i * 7919) % 1013) / 7 - 40 for i in range(2000)] + [3.0] * 700
    df = spark.createDataFrame([(i % 3 or None, v) for i, v in enumerate(vals)] + [(5, None)], "g int, v double")
    pdf = pd.DataFrame({"g": [i % 3 for i in range(len(vals))], "v": vals})
    want = pdf.groupby("g")["v"].quantile([0.25, 0.5, 0.75]).unstack()
    got = {r["g"] or 0: r for r in exact_quantiles(df, "v", [0.25, 0.5, 0.75], by=["g"]).collect()}
    assert sorted(got) == [0, 1, 2]   # a NULL group is a group; a group without values is none
    for g in range(3):
        for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            assert got[g][q] == pytest.approx(want.loc[g, p], abs=1e-9)


def test_ranks_of_a_continuous_score_by_group(spark):
    rng = np.random.default_rng(4)
    vals = np.concatenate([rng.uniform(0, 10, 100_000), np.round(rng.normal(0, 3, 20_000), 1), np.full(5_000, 7.25), rng.normal(0, 1e-9, 500)])
    pdf = pd.DataFrame({"g": np.arange(len(vals)) % 2, "nps_score": vals})
    pdf["rank"] = pdf.groupby("g")["nps_score"].rank(method="average")
    got = ranked_values(spark.createDataFrame(pdf[["g", "nps_score"]]), "nps_score", by=["g"]).toPandas()
    both = got.merge(pdf.drop_duplicates(["g", "nps_score"]), on=["g", "nps_score"])
    assert len(both) == len(got) and (both["avg_rank"] == both["rank"]).all()
    assert set(got["total"]) == set(pdf.groupby("g").size())


def test_value_ranges_rise_with_the_value(spark):
    import voxpop.functions.ranks as R
    edges = [s * m * 2.0 ** e for s in (-1, 1) for e in (-1074, -1022, -30, -1, 0, 1, 9, 52, 1023)
             for m in (1.0, 1 - 2.0 ** -53, 1 + 2.0 ** -52, 1.5) if m * 2.0 ** e <= 1.7e308]
    vals = edges + [0.0, -0.0, float("inf"), float("-inf"), float("nan")] + [i / 100 for i in range(-300, 5000, 7)]
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    rows = df.select("v", R.value_range("v").alias("r")).orderBy("v").collect()
    ranges = [x["r"] for x in rows]
    assert ranges == sorted(ranges) and None not in ranges
    cents = {x["v"]: x["r"] for x in rows if 1.05 < x["v"] < 50 and x["v"] == round(x["v"], 2)}
    assert len(set(cents.values())) == len(cents) > 600


def test_quantile_plan_has_no_value_map_and_ranks_only_ranges(spark):
    df = spark.range(1000).withColumn("v", F.rand(1))
    plan = exact_quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "SortMergeJoin" not in plan


def test_stacked_spearman_equals_single_and_pandas(spark):
    rows = [(i % 7, (i * 13) % 11, float((i * 31) % 17) / 2, None) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b int, y double, z int")
    pdf = pd.DataFrame(rows, columns=["a", "b", "y", "z"])
    stacked = {r["variable"]: r for r in ST.spearman_stacked(df, ["a", "b", "z"], "y").collect()}
    table = {r["variable"]: r for r in ST.spearman_table(df, ["a", "b", "z"], "y").collect()}
    for got in (stacked, table):
        for v in ("a", "b"):
            want = pdf[v].rank().corr(pdf["y"].rank())
            assert got[v]["rho"] == pytest.approx(want, abs=1e-12)
            assert got[v]["rho"] == pytest.approx(ST.spearman(df, v, "y").first()["rho"], abs=1e-12)
            assert got[v]["n"] == 400
        assert got["z"]["n"] == 0 and got["z"]["rho"] is None


def test_qq_positions_match_brute_force(spark):
    for vals, points in (([5.0, 1.0, 3.0, 3.0, 9.0, 2.0, 7.0], 10), ([4.0], 5),
                         ([float(i % 13) for i in range(500)], 40)):
        df = spark.createDataFrame([(v,) for v in vals], "v double")
        got = sorted((r["ordem"], r["observado"]) for r in ST.qq_points(df, "v", points).collect())
        srt, n = sorted(vals), len(vals)
        want = sorted((j * (n - 1) // max(points - 1, 1) + 1, srt[j * (n - 1) // max(points - 1, 1)])
                      for j in range(points))
        assert got == want


def test_roc_and_sweep_match_brute_force(spark):
    rows = [(int((i * 37) % 5 < 2), ((i * 7919) % 1009) / 1009.0) for i in range(3000)]
    rows += [(1, 0.15), (0, 0.15), (1, 0.85), (0, 0.1)]   # scores exactly on thresholds
    df = spark.createDataFrame(rows, "label int, score double")
    P = sum(y for y, _ in rows)
    Nn = len(rows) - P
    got = {r["threshold"]: (r["tpr"], r["fpr"]) for r in EV.roc_points(df).collect()}
    assert got[None] == (0.0, 0.0)
    for s_ in {sc for _, sc in rows}:
        tp = sum(1 for y, sc in rows if y == 1 and sc >= s_)
        fp = sum(1 for y, sc in rows if y != 1 and sc >= s_)
        assert got[s_] == pytest.approx((tp / P, fp / Nn), abs=1e-12)
    sweep = {r["t_pct"]: r for r in EV.threshold_sweep(df).collect()}
    for t in range(10, 90, 5):
        tp = sum(1 for y, sc in rows if y == 1 and sc >= t / 100.0)
        fp = sum(1 for y, sc in rows if y != 1 and sc >= t / 100.0)
        assert (sweep[t]["tp"], sweep[t]["fp"]) == (tp, fp)
        assert sweep[t]["recall"] == pytest.approx(tp / P, abs=1e-12)


def test_six_stat_profile_matches_pandas(spark):
    rows = [("abc"[i % 3], (i * 7) % 13, ((i * 7919) % 1009) / 7.0) for i in range(900)]
    df = spark.createDataFrame(rows, "classificacao_nps string, delivery_delay_days int, money double")
    pdf = pd.DataFrame(rows, columns=["classificacao_nps", "delivery_delay_days", "money"])
    got = {(r["classificacao_nps"], r["variable"]): r
           for r in S.six_stat_profile(df, ["delivery_delay_days", "money"]).collect()}
    for (g, c), r in got.items():
        x = pdf.loc[pdf.classificacao_nps == g, c]
        assert r["count"] == len(x) and r["median"] == pytest.approx(x.median(), abs=1e-12)
        assert r["mean"] == pytest.approx(x.mean()) and r["std"] == pytest.approx(x.std())
        assert (r["min"], r["max"]) == (x.min(), x.max())
    assert len(got) == 6


def test_corr_change_one_pass_and_null_fallback(spark):
    rows = [(float(i % 11), float((i * 7) % 5) if i % 9 else None, float((i * 3) % 10)) for i in range(300)]
    pdf = pd.DataFrame(rows, columns=["x", "z", "y"])
    for cols in (["x"], ["x", "z"]):          # complete columns: one pass; z has NULLs: fallback
        got = {r["variable"]: r for r in ST.corr_change(spark.createDataFrame(rows, "x double, z double, y double"),
                                                         cols, "y").collect()}
        for c in cols:
            assert got[c]["v1"] == pytest.approx(pdf[c].corr(pdf["y"]), abs=1e-12)
            v2 = pdf[pdf.y > 0]
            assert got[c]["v2"] == pytest.approx(v2[c].corr(v2["y"]), abs=1e-12)


def test_pearson_matrix_gram_and_fallback(spark):
    import math as _m
    rows = [(float(i % 7), float((i * 5) % 11), 3.0, float((i * 3) % 13) if i % 10 else None) for i in range(200)]
    pdf = pd.DataFrame(rows, columns=["a", "b", "c", "z"])
    df = spark.createDataFrame(rows, "a double, b double, c double, z double")
    for cols in (["a", "b", "c"], ["a", "b", "z"]):   # complete: Gram path; z has NULLs: fallback
        got = {(r["x"], r["y"]): r["r"] for r in ST.pearson_matrix(df, cols).collect()}
        assert len(got) == len(cols) ** 2
        for x in cols:
            for y in cols:
                want = pdf[[x, y]].dropna().corr().iloc[0, 1] if x != y else (1.0 if pdf[x].std() > 0 else None)
                if want is None or (isinstance(want, float) and _m.isnan(want)):
                    assert got[(x, y)] is None
                else:
                    assert got[(x, y)] == pytest.approx(want, abs=1e-12)
                assert got[(x, y)] == got[(y, x)]


def test_repartition_stability(spark):
    vals = [((i * 31) % 17, float((i * 7) % 11)) for i in range(500)]
    base = spark.createDataFrame(vals, "g int, v double")
    outs = []
    for n in (1, 8, 64):
        df = base.repartition(n)
        k = ST.kruskal(df.withColumn("g", F.col("g") % 3), "v", "g").first()["h_stat"]
        outs.append(round(k, 9))
    assert len(set(outs)) == 1


def test_repartition_stability_of_ranks_splits_and_sweeps(spark):
    from voxpop.ml import split as SP
    rows = [(i, i % 3, (i * 13) % 7, float((i * 31) % 17) / 2, ((i * 7919) % 1009) / 1009.0, int(i % 5 < 2))
            for i in range(600)]
    base = spark.createDataFrame(
        rows, "order_id bigint, cls int, complaints_count int, nps_score double, score double, label int")
    seen = []
    for n in (1, 8, 64):
        df = base.repartition(n)
        sp = {r["variable"]: round(r["rho"], 12) for r in ST.spearman_stacked(df, ["complaints_count"]).collect()}
        six = sorted((r["cls"], r["variable"], r["median"], round(r["std"], 12))
                     for r in S.six_stat_profile(df, ["complaints_count", "score"], by="cls").collect())
        auc = round(EV.auc_rank(df).first()["auc"], 12)
        sweep = sorted((r["t_pct"], r["tp"], r["fp"]) for r in EV.threshold_sweep(df).collect())
        split = sorted((r["order_id"], r["split"]) for r in SP.stratified_split(df, "label").collect())
        seen.append((sp, six, auc, sweep, split))
    assert seen[0] == seen[1] == seen[2]


def test_t_tail_stays_exact_at_large_df():
    from voxpop.functions.pvalues import betainc_reg, normal_sf, t_two_sided
    for t in (0.3, 1.5, 1.96, 5.0):
        below = betainc_reg(5e5, 0.5, 1e6 / (1e6 + t * t))
        assert abs(t_two_sided(t, 1e6 + 1) / below - 1) < 1e-5
        for df in (1.5e11, 1e13):
            assert abs(t_two_sided(t, df) - 2 * normal_sf(t)) < 1e-9


def test_pair_medians_and_residual_bins_match_numpy(spark):
    rng = np.random.default_rng(3)
    values = {"a": rng.integers(0, 9, 40).astype(float), "b": rng.normal(size=31), "c": rng.integers(3, 5, 2).astype(float)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs] + [("a", None)], "g string, v double")
    for r in ST.mann_whitney_pairs(df, "v", "g", groups=("a", "b", "c", "none"), with_p=False).collect():
        for g, m, n in (("g1", "mediana_1", "n1"), ("g2", "mediana_2", "n2")):
            mine = values.get(r[g], np.array([]))
            assert r[n] == len(mine)
            assert r[m] == (pytest.approx(np.median(mine)) if len(mine) else None)
    with_p = {r["comparacao"]: r for r in ST.mann_whitney_pairs(df, "v", "g", groups=("a", "b", "none")).collect()}
    for pair in ("a vs none", "b vs none"):
        assert with_p[pair]["p_value"] is None and with_p[pair]["significativo"] == "Não"
    one = ST.kruskal(df.filter("v IS NOT NULL").limit(1), "v", "g").first()
    assert one["n"] == 1 and one["h_stat"] is None
    y, p = rng.uniform(0, 10, 500), rng.uniform(0, 10, 500)
    out = ST.residual_histogram(spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "nps_score double, prediction double"), bins=12)
    got = sorted(out.collect(), key=lambda r: r["bin"])
    assert [r["n"] for r in got] == np.histogram(y - p, 12)[0].tolist()
    assert got[0]["mediana"] == pytest.approx(np.median(y - p))
