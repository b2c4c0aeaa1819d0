"""Ranks and quantiles on narrow, wide and odd values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxpop.functions import ranks as R


def _values(kind):
    rng = np.random.default_rng(5)
    if kind == "narrow":  # 200,000 distinct values in one range, repeats
        v = 1 + np.arange(200_000) * (0.00005 / 200_000)
        return np.concatenate([v, rng.choice(v, 20_000)])
    if kind == "negative":
        return -(1 + np.arange(30_000) * (0.00005 / 30_000))
    if kind == "wide":
        v = rng.choice([-1, 1], 40_000) * 2.0 ** rng.uniform(-1070, 1020, 40_000)
        return np.concatenate([v, [0.0] * 50, [5e-324, -5e-324, np.inf, -np.inf, np.inf]])
    near = np.concatenate([np.nextafter(2.0 ** k, [0, np.inf]) for k in range(-30, 31)] + [2.0 ** np.arange(-30, 31)])
    return np.concatenate([near, -near, rng.integers(-3, 4, 500)])


@pytest.mark.parametrize("many", [R.MANY, 8])
@pytest.mark.parametrize("kind", ["narrow", "negative", "wide", "powers"])
def test_ranks_and_quantiles_equal_numpy(spark, kind, many):
    v = _values(kind)
    df = spark.createDataFrame([(float(x),) for x in np.random.default_rng(1).permutation(v)], "v double").repartition(6)
    uniq, n = np.unique(v, return_counts=True)
    before = np.cumsum(n) - n
    got = R.cumulative(R.frequencies(df, "v"), "v").select("v", "n", "cum_before", "total").toPandas().sort_values("v")
    assert (got["v"].to_numpy() == uniq).all() and (got["n"].to_numpy() == n).all()
    assert (got["cum_before"].to_numpy() == before).all() and (got["total"] == len(v)).all()
    finite = v[np.isfinite(v)]
    q = R.exact_quantiles(df.where(F.abs("v") < float("inf")), "v", [0.0, 0.25, 0.5, 0.9, 1.0], many=many).first()
    for p, c in ((0, "q0"), (0.25, "q25"), (0.5, "q50"), (0.9, "q90"), (1, "q100")):
        s = np.sort(finite)
        pos = p * (len(s) - 1)
        lo, hi = s[int(np.floor(pos))], s[int(np.ceil(pos))]
        assert q[c] == pytest.approx(lo + (hi - lo) * (pos - np.floor(pos)), rel=1e-12)


def test_a_million_values_of_one_range_are_spread_over_cells(spark):
    df = spark.range(1_000_000, numPartitions=8).select((1 + F.col("id") * (0.00005 / 1_000_000)).alias("v"))
    placed = df.select(R.value_range("v").alias("range"), R.value_cell("v").alias("cell"))
    assert placed.select("range").distinct().count() == 1
    most = placed.groupBy("range", "cell").count().agg(F.max("count")).first()[0]
    assert most <= 10  # of 2^21 at most: the share of one window partition
    r = R.cumulative(R.frequencies(df, "v"), "v")
    bad = r.where(F.abs(F.col("cum_before") - F.round((F.col("v") - 1) / (0.00005 / 1_000_000))) > 0).count()
    assert bad == 0


def test_cells_rise_with_the_value_and_groups_are_apart(spark):
    rng = np.random.default_rng(2)
    v = np.sort(np.concatenate([rng.normal(size=3000), rng.normal(size=3000) * 1e-9 + 3]))
    rows = spark.createDataFrame([(float(x), int(i % 3) or None) for i, x in enumerate(v)], "v double, g int")
    order = rows.select("v", R.value_range("v").alias("a"), R.value_cell("v").alias("b")).orderBy("v").collect()
    assert all((x["a"], x["b"]) <= (y["a"], y["b"]) for x, y in zip(order, order[1:]))
    assert all(0 <= x["b"] < R.CELLS for x in order)
    got = R.cumulative(R.frequencies(rows, "v", ["g"]), "v", ["g"]).collect()
    for g in (None, 1, 2):
        mine = sorted(r["v"] for r in got if r["g"] == g)
        assert [r["cum_before"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["v"])] == list(range(len(mine)))
