"""Duplicates by hash and bitmap, distinct keys by words, exact U, the Q-Q line."""

import itertools
from collections import Counter
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxpop.functions import pvalues as PV
from voxpop.operators import quality as Q
from voxpop.operators import stats as ST


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bits", [Q.FILTER_BITS, 1 << 15])
def test_duplicate_rows_of_any_kind(spark, monkeypatch, bits):
    monkeypatch.setattr(Q, "FILTER_BITS", bits)
    rng = np.random.default_rng(4)
    rows = [(int(a), None if b > 8 else str(b), float(c)) for a, b, c in zip(rng.integers(0, 40, 3000), rng.integers(0, 10, 3000), rng.integers(0, 3, 3000))]
    rows += [(None, None, None)] * 5 + [(1000 + i, "u", 0.0) for i in range(2000)] + [(7, "hot", 1.0)] * 2500
    df = spark.createDataFrame(rows, "_h1 int, b string, c double").repartition(7)
    seen = Counter(rows)
    got = Q.duplicate_rows(df).first().asDict()
    assert got == {"n_rows": len(rows), "n_distinct_rows": len(seen), "duplicate_rows": len(rows) - len(seen)}
    assert Q.duplicate_rows(df.limit(0)).first().asDict() == {"n_rows": 0, "n_distinct_rows": 0, "duplicate_rows": 0}


def test_only_suspected_rows_are_compared_in_full(spark):
    df = spark.range(50_000).select("id", F.repeat(F.lit("wide"), 50).alias("text"))
    one = Q.may_be_among(df.withColumn("h", F.xxhash64("id")), "h", df.where("id < 300").select(F.xxhash64("id").alias("h")))
    assert 300 <= one.count() <= 400 and one.where("id < 300").count() == 300


@pytest.mark.parametrize("keys", [list(range(5000)), [-(1 << 63), (1 << 63) - 1, 0, -1, 63, 64, -64, -65, None, None, 64] * 3, [i * 997_001 for i in range(-800, 800)] * 2])
def test_distinct_integers_by_words(spark, keys):
    df = spark.createDataFrame([(k, None if k is None else k % 1000) for k in keys], "order_id bigint, other int").repartition(5)
    rows = {r["key"]: r for r in Q.distinct_integers(df, ["order_id", "other"]).collect()}
    filled = [k for k in keys if k is not None]
    for name, values in (("order_id", filled), ("other", [k % 1000 for k in filled])):
        assert (rows[name]["n_rows"], rows[name]["n_filled"], rows[name]["n_distinct"]) == (len(keys), len(filled), len(set(values)))


def test_duplicate_keys_need_no_expand_and_take_any_type(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 5), (2, "a", None), (None, "b", 7)], "order_id bigint, name string, customer_id int")
    out = Q.duplicate_keys(df, ("order_id", "name", "missing", "customer_id"))
    assert "Expand" not in _plan(out)
    got = {r["key_column"]: tuple(r)[1:] for r in out.collect()}
    assert got == {"order_id": (True, 4, 2, 1, 0.5), "name": (True, 4, 2, 1, 0.5), "missing": (False, 4, None, None, None), "customer_id": (True, 4, 2, 1, 0.5)}
    assert {r["key_column"]: r["n_distinct"] for r in Q.duplicate_keys(df.limit(0), ("order_id", "name")).collect()} == {"order_id": 0, "name": 0}


@pytest.mark.parametrize("n1,n2", [(1, 1), (1, 6), (3, 4), (5, 5), (6, 3)])
def test_exact_u_equals_enumeration(n1, n2):
    us = Counter(sum(r > s for r in pick for s in range(n1 + n2) if s not in pick) for pick in itertools.combinations(range(n1 + n2), n1))
    total = sum(us.values())
    for u in range(n1 * n2 + 1):
        want = min(1.0, 2 * sum(c for v, c in us.items() if v >= max(u, n1 * n2 - u)) / total)
        assert PV.mann_whitney_exact(u, n1, n2) == pytest.approx(want, rel=1e-12)


def test_exact_u_of_a_small_and_a_large_group_nears_the_normal_tail():
    n1, n2 = 8, 4000
    sigma = (n1 * n2 * (n1 + n2 + 1) / 12) ** 0.5
    for z in (0.5, 1.0, 1.9):
        p = PV.mann_whitney_exact(n1 * n2 / 2 - round(z * sigma), n1, n2)
        # U of 8 values among many is a sum of 8 uniforms: excess kurtosis -1.2 / 8
        near = 2 * (NormalDist().cdf(-z) - 0.15 / 24 * (z ** 3 - 3 * z) * NormalDist().pdf(z))
        assert p == pytest.approx(near, abs=1e-3)


def test_small_groups_without_ties_take_the_exact_p(spark):
    rows = [("Detrator", float(v)) for v in (1, 4, 9)] + [("Neutro", float(v)) for v in (2, 3, 5, 7)] + [("Promotor", v / 7 + 0.01) for v in range(200)]
    out = {r["comparacao"]: r for r in ST.mann_whitney_pairs(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()}
    r = out["Detrator vs Neutro"]
    assert r["p_value"] == pytest.approx(PV.mann_whitney_exact(r["u_stat"], 3, 4)) and r["p_value"] != pytest.approx(2 * NormalDist().cdf(-abs(r["z"])), abs=1e-3)
    tied = [("Detrator", 1.0), ("Detrator", 2.0), ("Neutro", 2.0), ("Neutro", 3.0), ("Promotor", 5.0)]
    for r in ST.mann_whitney_pairs(spark.createDataFrame(tied, "g string, v double"), "v", "g").collect():
        if r["comparacao"] == "Detrator vs Neutro":
            assert r["p_value"] == pytest.approx(min(1, 2 * NormalDist().cdf(-abs(r["z"]))), abs=1e-9)


def _scores(n):
    i = np.arange(1, n + 1)
    p = (i - 0.3175) / (n + 0.365)
    p[-1] = 0.5 ** (1 / n)
    p[0] = 1 - p[-1]
    return np.array([NormalDist().inv_cdf(x) for x in p])


@pytest.mark.parametrize("n", [1, 2, 5, 127, 129, 400, 15_000])
def test_score_sums_equal_the_listed_ranks(n):
    s = _scores(n) if n > 1 else np.array([0.0])
    rng = np.random.default_rng(n)
    cuts = sorted({0, n, 1, n - 1, *rng.integers(0, n + 1, 12).tolist()} & set(range(n + 1)))
    for a, b in itertools.combinations(cuts, 2):
        assert PV.score_sum(a, b, n) == pytest.approx(s[a:b].sum(), abs=1e-9)
    assert PV.score_sum(0, n, n, 2) == pytest.approx((s * s).sum(), rel=1e-11, abs=1e-12)


def test_qq_line_equals_least_squares_over_all_rows(spark):
    rng = np.random.default_rng(8)
    y = np.sort(np.round(rng.gamma(2, 2, 15_000), 1))
    got = ST.qq_line(spark.createDataFrame([(float(v),) for v in rng.permutation(y)] + [(None,)], "nps_score double").repartition(4)).first()
    slope, intercept = np.polyfit(_scores(len(y)), y, 1)
    assert (got["slope"], got["intercept"], got["n"]) == (pytest.approx(slope, rel=1e-9), pytest.approx(intercept, rel=1e-9), len(y))
    assert got["r"] == pytest.approx(np.corrcoef(_scores(len(y)), y)[0, 1], rel=1e-9)
