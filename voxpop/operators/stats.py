"""Relational statistics (ST1-ST14).

* Pearson: safe (NULL for a constant column) covariance / std aggregates, all
  variables in ONE aggregation pass, unpivoted.
* Rank statistics (Spearman, Kruskal-Wallis, Mann-Whitney): rows are reduced
  to (group, value) or (x, y) frequency tables first; average ranks come from
  the distributed cumulative counts (``functions.ranks``) — the fact table is
  never sorted and no group is collected into one task.
* p-values: statistic in Spark, tail probability by a vectorised UDF on the
  few result rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxpop.functions import columns as C
from voxpop.functions.pvalues import (chi2_sf_udf, inverse_normal_udf, mann_whitney_exact_udf, normal_two_sided_udf,
                                      score_square_sum_udf, score_sum_udf, t_two_sided_udf)
from voxpop.functions.ranks import cumulative, exact_quantiles, frequencies, quantile, ranked_values, stacked
from voxpop.schema import NPS_CLASSES


def _explode(row: DataFrame, structs) -> DataFrame:
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# --- ST1 / ST2 / SO3 ------------------------------------------------------------------

def _q(c: str) -> str:
    return f"`{c}`"


def _dbl(v) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST('{float(v)!r}' AS DOUBLE)"


def _inline(row: DataFrame, items) -> DataFrame:
    """Wide one-row aggregate -> long rows with ONE SQL expression
    (``inline(array(named_struct(...)))``), parsed once in the JVM."""
    arr = ", ".join("named_struct(" + ", ".join(f"'{k}', {v}" for k, v in it.items()) + ")" for it in items)
    return row.selectExpr(f"inline(array({arr}))")


def _complete(df: DataFrame, cols) -> tuple[bool, dict]:
    """One small job: row count, non-null counts and means (bounded summary)."""
    exprs = ["count(1) AS `__n`"] + [f"count({_q(c)}) AS `{c}__nn`" for c in cols] \
        + [f"avg(CAST({_q(c)} AS DOUBLE)) AS `{c}__mean`" for c in cols]
    row = df.selectExpr(*exprs).first()
    ok = all(row[f"{c}__nn"] == row["__n"] for c in cols)
    return ok, {c: row[f"{c}__mean"] for c in cols}


def _centred_corr(df: DataFrame, pairs, cols) -> DataFrame:
    """Second pass over complete rows: centred cross products (numerically
    stable two-pass moments); returns one row with ``a__b`` and ``c__sd``.
    Columns with NULLs fall back to the pairwise-complete safe correlation."""
    ok, means = _complete(df, cols)
    if not ok:
        return df.agg(*[C.safe_corr(a, b).alias(f"{a}__{b}") for a, b in pairs],
                      *[F.stddev_pop(c).alias(f"{c}__sd") for c in cols])
    d = {c: f"(CAST({_q(c)} AS DOUBLE) - {_dbl(means[c] if means[c] is not None else 0.0)})" for c in cols}
    sums = ["count(1) AS `__n`"] + [f"sum({d[a]} * {d[b]}) AS `{a}__{b}__s`" for a, b in pairs] \
        + [f"sum({d[c]} * {d[c]}) AS `{c}__ss`" for c in cols]
    row = df.selectExpr(*sums)
    out = [f"`{a}__{b}__s` / nullif(sqrt(`{a}__ss` * `{b}__ss`), 0D) AS `{a}__{b}`" for a, b in pairs]
    out += [f"sqrt(`{c}__ss` / `__n`) AS `{c}__sd`" for c in cols]
    return row.selectExpr(*out)


def _centred_corr_versions(df: DataFrame, pairs, cols, versions) -> DataFrame | None:
    """Centred-moment correlations for several row filters ``versions``
    (``[(tag, sql_condition)]``) in the same two passes: one job for all the
    means (conditional averages), one pass for all the centred cross
    products (conditional sums).  One row with ``a__b__<tag>``.  Returns None
    when a column has NULLs (the caller then uses the pairwise-complete path)."""
    exprs = []
    for tag, cond in versions:
        exprs += [f"count(CASE WHEN {cond} THEN 1 END) AS `__n__{tag}`"]
        exprs += [f"count(CASE WHEN {cond} THEN {_q(c)} END) AS `{c}__nn__{tag}`" for c in cols]
        exprs += [f"avg(CASE WHEN {cond} THEN CAST({_q(c)} AS DOUBLE) END) AS `{c}__mean__{tag}`" for c in cols]
    row = df.selectExpr(*exprs).first()
    if not all(row[f"{c}__nn__{tag}"] == row[f"__n__{tag}"] for tag, _ in versions for c in cols):
        return None
    sums, out = [], []
    for tag, cond in versions:
        m = {c: row[f"{c}__mean__{tag}"] for c in cols}
        d = {c: f"(CAST({_q(c)} AS DOUBLE) - {_dbl(m[c] if m[c] is not None else 0.0)})" for c in cols}
        sums += [f"sum(CASE WHEN {cond} THEN {d[a]} * {d[b]} END) AS `{a}__{b}__s__{tag}`" for a, b in pairs]
        sums += [f"sum(CASE WHEN {cond} THEN {d[c]} * {d[c]} END) AS `{c}__ss__{tag}`" for c in cols]
        out += [f"`{a}__{b}__s__{tag}` / nullif(sqrt(`{a}__ss__{tag}` * `{b}__ss__{tag}`), 0D) AS `{a}__{b}__{tag}`"
                for a, b in pairs]
    return df.selectExpr(*sums).selectExpr(*out)


def pearson_with(df: DataFrame, variables, target: str = "nps_score") -> DataFrame:
    """(variable, r) of each variable with the target: pairwise-complete safe
    correlation (NULL for a constant column); two-pass centred moments when
    the columns have no NULLs."""
    cols = list(dict.fromkeys(list(variables) + [target]))
    row = _centred_corr(df, [(v, target) for v in variables], cols)
    return _inline(row, [{"variable": f"'{v}'", "r": f"`{v}__{target}`"} for v in variables])


def _gram_matrix(df: DataFrame, cols, means) -> DataFrame:
    """Long (x, y, r) from the centred cross-product (Gram) matrix.  Every
    row is exploded into k rows keyed by a column index ``a`` carrying its
    centred value; ``groupBy(a)`` with k sums gives row a of the matrix.  The
    aggregation buffer stays narrow (k sums per group, inside whole-stage
    codegen) instead of one buffer of k(k+1)/2 sums; partial aggregation
    leaves k rows per task."""
    k = len(cols)
    d = [(F.col(c).cast("double") - F.lit(float(means[c] if means[c] is not None else 0.0))).alias(f"_d{i}")
         for i, c in enumerate(cols)]
    x = df.select(*d)
    st = x.select("*", F.posexplode(F.array(*[F.col(f"_d{i}") for i in range(k)])).alias("a", "_da"))
    gram = st.groupBy("a").agg(*[F.sum(F.col("_da") * F.col(f"_d{j}")).alias(f"_s{j}") for j in range(k)])
    cells = gram.select("a", F.inline(F.array(*[F.struct(F.lit(j).alias("b"), F.col(f"_s{j}").alias("s"))
                                                  for j in range(k)])))
    diag = F.max(F.when(F.col("a") == F.col("b"), F.col("s")))
    ss_a = diag.over(Window.partitionBy("a"))
    ss_b = F.max(F.when(F.col("a") == F.col("b"), F.col("s"))).over(Window.partitionBy("b"))
    upper = (cells.withColumn("_ssa", ss_a).withColumn("_ssb", ss_b).filter(F.col("a") <= F.col("b"))
             .withColumn("r", F.when(F.col("a") == F.col("b"), F.when(F.col("s") > 0, F.lit(1.0)))
                         .otherwise(F.col("s") / F.nullif(F.sqrt(F.col("_ssa") * F.col("_ssb")), F.lit(0.0)))))
    mirrored = upper.filter(F.col("a") < F.col("b")).select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    names = F.create_map(*[v for i, c in enumerate(cols) for v in (F.lit(i), F.lit(c))])
    return (upper.select("a", "b", "r").unionByName(mirrored)
            .select(names[F.col("a")].alias("x"), names[F.col("b")].alias("y"), "r"))


def pearson_matrix(df: DataFrame, cols) -> DataFrame:
    """Long (x, y, r) matrix: each unordered pair computed once, mirrored,
    diagonal = 1 for a non-constant column.  Complete columns use the
    stacked Gram aggregation; columns with NULLs the pairwise-complete path."""
    ok, means = _complete(df, cols)
    if ok:
        return _gram_matrix(df, cols, means)
    pairs = list(itertools.combinations(cols, 2))
    row = _centred_corr(df, pairs, cols)
    items = []
    for a, b in pairs:
        items.append({"x": f"'{a}'", "y": f"'{b}'", "r": f"`{a}__{b}`"})
        items.append({"x": f"'{b}'", "y": f"'{a}'", "r": f"`{a}__{b}`"})
    for c in cols:
        items.append({"x": f"'{c}'", "y": f"'{c}'", "r": f"CASE WHEN `{c}__sd` > 0 THEN 1D END"})
    return _inline(row, items)


def top_bottom(corr: DataFrame, k: int = 3, col: str = "r") -> DataFrame:
    """SO3: the k highest and k lowest correlations (NULLs excluded)."""
    c = corr.filter(F.col(col).isNotNull())
    hi = c.orderBy(F.desc(col), "variable").limit(k).withColumn("lado", F.lit("positivo"))
    lo = c.orderBy(F.asc(col), "variable").limit(k).withColumn("lado", F.lit("negativo"))
    return hi.unionByName(lo)


# --- ST3 / ST4 ------------------------------------------------------------------------

def spearman(df: DataFrame, x: str, y: str = "nps_score") -> DataFrame:
    """One row (variable, rho, n): Pearson of average ranks."""
    return spearman_stacked(df, [x], y)


def _weighted_rho(j: DataFrame, by) -> DataFrame:
    """Pearson of the average ranks ``rx``, ``ry`` weighted by the pair count ``w``."""
    w = F.col("w")
    n = F.sum(w)
    mx, my = F.sum(w * F.col("rx")) / n, F.sum(w * F.col("ry")) / n
    cov = F.sum(w * F.col("rx") * F.col("ry")) / n - mx * my
    vx = F.sum(w * F.col("rx") * F.col("rx")) / n - mx * mx
    vy = F.sum(w * F.col("ry") * F.col("ry")) / n - my * my
    aggs = [(cov / F.nullif(F.sqrt(vx * vy), F.lit(0.0))).alias("rho"),
            F.coalesce(n.cast("bigint"), F.lit(0).cast("bigint")).alias("n")]
    return j.groupBy(*by).agg(*aggs) if by else j.agg(*aggs)


def spearman_stacked(df: DataFrame, variables, y: str = "nps_score") -> DataFrame:
    """Spearman of several variables with ``y`` in one scan.

    Rows are stacked to (variable, x, y) and reduced at once by a partial
    aggregation to the joint frequency table.  The average ranks of x and of y,
    per variable, come from the distributed cumulative counts over the sums of
    that table and are joined back to it by value."""
    rows = stacked(df.withColumn("_y", F.col(y).cast("double")), variables, ["_y"], value="x").withColumnRenamed("_y", "y")
    joint = rows.filter(F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy("variable", "x", "y").agg(F.count(F.lit(1)).alias("w"))
    for c in ("x", "y"):
        rank = cumulative(frequencies(joint, c, ["variable"], "w"), c, ["variable"])
        joint = joint.join(rank.select("variable", c, F.col("avg_rank").alias(f"r{c}")), ["variable", c])
    rho = _weighted_rho(joint, ["variable"])
    # every requested variable is reported, also one without any complete row
    names = df.sparkSession.createDataFrame([(v,) for v in variables], "variable string")
    return (F.broadcast(names).join(rho, "variable", "left")
            .withColumn("n", F.coalesce("n", F.lit(0).cast("bigint"))))


def spearman_table(df: DataFrame, variables, y: str = "nps_score") -> DataFrame:
    """ST3 / ST4: rho per variable and |rho|, by which they are ranked."""
    return spearman_stacked(df, list(variables), y).withColumn("impacto_abs", F.abs("rho"))


def with_t_pvalue(df: DataFrame, r: str = "rho", n: str = "n") -> DataFrame:
    """Two-sided p of a correlation via Student t with n - 2 df."""
    t = F.col(r) * F.sqrt((F.col(n) - 2) / F.nullif(1 - F.col(r) * F.col(r), F.lit(0.0)))
    return (df.withColumn("t_stat", t)
            .withColumn("p_value", t_two_sided_udf(F.col("t_stat"), (F.col(n) - 2).cast("double")))
            .withColumn("leitura", C.significance("p_value")))


# --- ST5 ------------------------------------------------------------------------------

def kruskal(df: DataFrame, value: str, group: str) -> DataFrame:
    """Kruskal-Wallis H with tie correction; p by chi-square (df = k - 1)."""
    freq = frequencies(df.filter(F.col(group).isNotNull()), value, [group])
    pooled = cumulative(freq.groupBy(value).agg(F.sum("n").alias("n")), value)
    g = (freq.join(pooled.select(value, "avg_rank", F.col("n").alias("t")), value)
         .groupBy(group).agg(F.sum(F.col("n") * F.col("avg_rank")).alias("R"), F.sum("n").alias("ng")))
    # tie sum and N over the pooled values: one scalar subquery (a struct)
    ties = pooled.agg(F.struct(F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("tt"),
                               F.sum("n").alias("N")).alias("t")).scalar()
    s = g.agg(F.sum(F.col("R") * F.col("R") / F.col("ng")).alias("S"), F.count(F.lit(1)).alias("k"))
    N = ties["N"].cast("double")
    h0 = F.lit(12.0) / (N * (N + 1)) * F.col("S") - 3 * (N + 1)
    corr = 1 - ties["tt"] / F.nullif(N * N * N - N, F.lit(0.0))
    out = s.select(
        (h0 / F.nullif(corr, F.lit(0.0))).alias("h_stat"), (F.col("k") - 1).alias("df"),
        F.col("k"), ties["N"].alias("n"))
    return out.withColumn("p_value", chi2_sf_udf(F.col("h_stat"), F.col("df").cast("double"))) \
              .withColumn("leitura", C.significance("p_value"))


# --- ST6 / ST14 -----------------------------------------------------------------------

def _pairs(spark, groups) -> DataFrame:
    """Unordered pairs of groups by a theta self-join on the group list."""
    dim = spark.createDataFrame(list(enumerate(groups)), "gid int, g string")
    a, b = dim.alias("a"), dim.alias("b")
    return (a.join(b, F.col("a.gid") < F.col("b.gid"))
            .select(F.col("a.g").alias("g1"), F.col("b.g").alias("g2"),
                    F.col("a.gid").alias("i1"), F.col("b.gid").alias("i2")))


def mann_whitney_pairs(df: DataFrame, value: str, group: str, groups=tuple(NPS_CLASSES),
                       alpha: float = 0.05, with_p: bool = True, exact_up_to: int = 8) -> DataFrame:
    """Pairwise two-sided Mann-Whitney U, re-ranked inside each pair;
    Bonferroni-adjusted p; verdict text.  p is exact for a pair without ties one
    of whose groups has at most ``exact_up_to`` values, and by the normal tail with
    tie correction and continuity for the others.  A group without a value has no
    mean and no median; its pairs have no z and no p."""
    spark = df.sparkSession
    d = df.filter(F.col(group).isin(list(groups)) & F.col(value).isNotNull())
    freq = frequencies(d, value, [group])
    pairs = F.broadcast(_pairs(spark, list(groups)))
    # each (group, value) row joins the k-1 pairs holding its group by an
    # equi-join on the ordered index pair (no disjunctive join condition)
    k = len(groups)
    gi = F.create_map(*[x for i, g in enumerate(groups) for x in (F.lit(g), F.lit(i))])[F.col(group)]
    keyed = (freq.withColumn("_gi", gi).withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
             .filter(F.col("_o") != F.col("_gi"))
             .withColumn("i1", F.least("_gi", "_o")).withColumn("i2", F.greatest("_gi", "_o"))
             .drop("_gi", "_o"))
    pf = (keyed.join(pairs, ["i1", "i2"])
          .groupBy("g1", "g2", "i1", "i2", value)
          .agg(F.sum(F.when(F.col(group) == F.col("g1"), F.col("n")).otherwise(0)).alias("n1v"),
               F.sum(F.when(F.col(group) == F.col("g2"), F.col("n")).otherwise(0)).alias("n2v"),
               F.sum("n").alias("n")))
    # the running count of the first group gives the ranks inside either group, hence both medians
    r = (cumulative(pf, value, by=["g1", "g2", "i1", "i2"], also=["n1v"])
         .withColumn("_before_2", F.col("cum_before") - F.col("cum_before_n1v")).withColumn("_total_2", F.col("total") - F.col("total_n1v")))
    s = r.groupBy("g1", "g2", "i1", "i2").agg(
        quantile(value, 0.5, "total_n1v", "cum_before_n1v", "n1v").alias("mediana_1"),
        quantile(value, 0.5, "_total_2", "_before_2", "n2v").alias("mediana_2"),
        F.sum(F.col("n1v") * F.col("avg_rank")).alias("R1"), F.sum("n1v").alias("n1"), F.sum("n2v").alias("n2"),
        F.sum(F.col("n1v") * F.col(value)).alias("_s1"), F.sum(F.col("n2v") * F.col(value)).alias("_s2"),
        F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("tt"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    N = n1 + n2
    u1 = F.col("R1") - n1 * (n1 + 1) / 2
    out = (s.withColumn("u_stat", u1)
           .withColumn("_u", F.greatest(u1, n1 * n2 - u1))
           .withColumn("_sigma", F.sqrt(n1 * n2 / 12.0 * ((N + 1) - F.col("tt") / F.nullif(N * (N - 1), F.lit(0.0)))))
           .withColumn("z", (F.col("_u") - n1 * n2 / 2.0 - 0.5) / F.nullif(F.col("_sigma"), F.lit(0.0))))
    m = len(groups) * (len(groups) - 1) // 2
    cols = [F.concat_ws(" vs ", "g1", "g2").alias("comparacao"), "g1", "g2", "n1", "n2",
            F.try_divide("_s1", "n1").alias("media_1"), F.try_divide("_s2", "n2").alias("media_2"),
            "mediana_1", "mediana_2", (F.col("mediana_1") - F.col("mediana_2")).alias("diferenca_mediana"),
            "u_stat", "z"]
    small = F.least("n1", "n2").between(1, exact_up_to) & (F.col("tt") == 0)  # exact null distribution: a small group, no ties
    out = out.select(*cols, small.alias("_exact"))
    if not with_p:
        return out.drop("_exact")
    sized = lambda c: F.when(F.col("_exact"), F.col(c).cast("double"))
    exact = mann_whitney_exact_udf(sized("u_stat"), sized("n1"), sized("n2"))
    out = (out.withColumn("_p", normal_two_sided_udf(F.col("z"))).withColumn("_e", exact)
           .withColumn("p_value", F.when(F.col("_exact"), F.col("_e")).otherwise(F.col("_p"))).drop("_exact", "_p", "_e")
           .withColumn("p_ajustado", F.least(F.col("p_value") * m, F.lit(1.0)))
           .withColumn("significativo", F.when(F.col("p_ajustado") < alpha, "Sim").otherwise("Não")))
    return out.withColumn("interpretacao", interpretation())


def interpretation():
    """ST14: verdict text from significance and median difference."""
    d = F.col("diferenca_mediana")
    return (F.when(F.col("significativo") == "Não",
                   F.lit("Não há diferença estatisticamente significativa entre os grupos."))
            .when(d > 0, F.concat(F.col("g1"), F.lit(" apresenta mediana de atraso maior que "), F.col("g2"), F.lit(".")))
            .when(d < 0, F.concat(F.col("g2"), F.lit(" apresenta mediana de atraso maior que "), F.col("g1"), F.lit(".")))
            .otherwise(F.lit("Há diferença estatística, mas as medianas são iguais; verificar distribuição e dispersão.")))


# --- ST7 ------------------------------------------------------------------------------

def trend(df: DataFrame, x: str = "csat_internal_score", y: str = "nps_score") -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"),
                  F.min(x).cast("double").alias("x_min"), F.max(x).cast("double").alias("x_max"))


def trend_points(df: DataFrame, x: str = "csat_internal_score", y: str = "nps_score", points: int = 100) -> DataFrame:
    """100 points of the fitted line over [min(x), max(x)] (linspace)."""
    t = trend(df, x, y)
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    return (t.select("slope", "intercept", "x_min", "x_max", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
            .withColumn("x", F.when(F.col("i") == points - 1, F.col("x_max")).otherwise(F.col("x_min") + F.col("i") * step))
            .withColumn("y_hat", F.col("intercept") + F.col("slope") * F.col("x"))
            .select("i", "x", "y_hat"))


# --- ST8 / ST9 ------------------------------------------------------------------------

def corr_change(df: DataFrame, variables, target: str = "nps_score") -> DataFrame:
    """V1 (all rows) vs V2 (nps > 0) correlations; delta, |delta| and the
    change verdict.  Both versions come from the same two passes
    (conditional means, then conditional centred cross products)."""
    cols = list(dict.fromkeys(list(variables) + [target]))
    pairs = [(v, target) for v in variables]
    row = _centred_corr_versions(df, pairs, cols, [("v1", "TRUE"), ("v2", f"{_q(target)} > 0")])
    if row is None:   # NULLs present: pairwise-complete correlations per version
        r1 = _centred_corr(df, pairs, cols).select(*[F.col(f"{v}__{target}").alias(f"{v}__{target}__v1")
                                                     for v in variables])
        # the V2 row enters as one struct-valued scalar subquery
        r2 = _centred_corr(df.filter(F.col(target) > 0), pairs, cols) \
            .select(F.struct(*[F.col(f"{v}__{target}").alias(f"{v}__{target}__v2") for v in variables])).scalar()
        row = r1.select("*", *[r2[f"{v}__{target}__v2"].alias(f"{v}__{target}__v2") for v in variables])
    row = row.select(*[F.col(f"{v}__{target}__{t}").alias(f"{v}__{t}") for v in variables for t in ("v1", "v2")])
    out = _inline(row, [{"variable": f"'{v}'", "v1": f"`{v}__v1`", "v2": f"`{v}__v2`"} for v in variables])
    v1, v2 = F.col("v1"), F.col("v2")
    flipped = ((v1 > 0) & (v2 < 0)) | ((v1 < 0) & (v2 > 0))
    return (out.withColumn("delta", v2 - v1).withColumn("delta_abs", F.abs(v2 - v1))
            .withColumn("mudanca", F.when(flipped, "inverteu sinal")
                        .when(F.abs(v2) < F.abs(v1), "enfraqueceu").otherwise("fortaleceu")))


def version_overview(df: DataFrame, rule: str = "floor") -> DataFrame:
    """Rows, mean NPS, official NPS and class % for V1 and V2, with delta —
    one pass with conditional aggregates."""
    cls = C.nps_class("nps_score", rule)
    keep = F.col("nps_score") > 0

    def stats(cond, tag):
        c = (lambda e: F.when(cond, e)) if cond is not None else (lambda e: e)
        n = F.count(c(cls))
        out = [F.count(c(F.lit(1))).cast("double").alias(f"linhas_{tag}"), F.avg(c(F.col("nps_score"))).alias(f"nps_medio_{tag}")]
        for k in NPS_CLASSES:
            out.append(F.try_divide(F.count(c(F.when(cls == k, 1))) * 100.0, n).alias(f"{k}_{tag}"))
        return out
    row = df.agg(*stats(None, "v1"), *stats(keep, "v2"))
    for tag in ("v1", "v2"):
        row = row.withColumn(f"nps_oficial_{tag}", F.col(f"Promotor_{tag}") - F.col(f"Detrator_{tag}"))
    names = [("linhas", "Linhas na base"), ("nps_medio", "NPS médio"), ("nps_oficial", "NPS oficial"),
             ("Detrator", "% Detratores"), ("Neutro", "% Neutros"), ("Promotor", "% Promotores")]
    structs = [F.struct(F.lit(i).alias("ordem"), F.lit(label).alias("metrica"), F.col(f"{k}_v1").alias("v1"),
                        F.col(f"{k}_v2").alias("v2"), (F.col(f"{k}_v2") - F.col(f"{k}_v1")).alias("delta"))
               for i, (k, label) in enumerate(names)]
    return _explode(row, structs)


# --- ST10 / ST11 / ST12 / ST13 -------------------------------------------------------------

def histogram(df: DataFrame, col: str = "nps_score", bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; empty bins kept;
    mean and median markers on every row."""
    spark = df.sparkSession
    x = F.col(col).cast("double")
    med = exact_quantiles(df, col, [0.5]).select("q50").scalar()
    # range and mean: one struct-valued scalar subquery, used as values
    st = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), F.avg(x).alias("media")).alias("s")).scalar()
    lo, hi = st["lo"], st["hi"]
    w = (hi - lo) / bins
    binned = (df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
              .withColumn("bin", F.least(F.floor((F.col("_x") - lo) / F.nullif(w, F.lit(0.0))),
                                         F.lit(bins - 1)).cast("int"))
              .withColumn("bin", F.coalesce("bin", F.lit(0)))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    dim = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (F.broadcast(dim).join(binned, "bin", "left")
            .select("bin", (lo + F.col("bin") * w).alias("inicio"),
                    F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * w).alias("fim"),
                    F.coalesce("n", F.lit(0)).alias("n"), st["media"].alias("media"), med.alias("mediana")))


def box_table(df: DataFrame, value: str, group: str = "classificacao_nps") -> DataFrame:
    """q1/median/q3, whiskers (most extreme datum within 1.5 IQR) and outlier
    count per group; quartiles joined back, extremes by conditional min/max."""
    d = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    q = exact_quantiles(d, value, [0.25, 0.5, 0.75], by=[group]) \
        .withColumn("iqr", F.col("q75") - F.col("q25")) \
        .withColumn("_lo", F.col("q25") - 1.5 * F.col("iqr")).withColumn("_hi", F.col("q75") + 1.5 * F.col("iqr"))
    x = F.col(value).cast("double")
    inside = (x >= F.col("_lo")) & (x <= F.col("_hi"))
    agg = d.join(F.broadcast(q), group).groupBy(group).agg(
        F.first("q25").alias("q1"), F.first("q50").alias("mediana"), F.first("q75").alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_baixo"), F.max(F.when(inside, x)).alias("whisker_alto"),
        F.count_if(~inside).alias("outliers"), F.count(F.lit(1)).alias("n"))
    return agg


def qq_points(df: DataFrame, col: str = "nps_score", points: int = 1000) -> DataFrame:
    """Normal Q-Q: ``points`` evenly spaced order statistics (exact values by
    the distributed cumulative counts) against the Filliben order-statistic
    medians mapped through the inverse normal (the line: ``qq_line``)."""
    r = ranked_values(df, col)
    total = r.agg(F.sum("n")).scalar()
    # Sample j (0..points-1) takes order statistic i = floor(j (N-1) / (P-1)) + 1.
    # A value row holds the order statistics (a, b], a = cum_before, b = a + n,
    # so its samples are the integer range ceil(a (P-1) / (N-1)) <= j <=
    # floor((b (P-1) - 1) / (N-1)): each row emits its own samples, exactly
    # ``points`` rows in total, with no join against the position list.
    p1 = max(points - 1, 1)
    bounds = r.select(col, F.col("cum_before").cast("bigint").alias("_a"),
                      (F.col("cum_before") + F.col("n")).cast("bigint").alias("_b"),
                      (total - 1).cast("bigint").alias("_n1"))
    # exact integer arithmetic (ceil / floor of non-negative quotients by ``div``)
    j_lo = F.expr(f"CASE WHEN _n1 = 0 THEN 0L ELSE (_a * {p1}L + _n1 - 1) div _n1 END")
    j_hi = F.expr(f"least(CASE WHEN _n1 = 0 THEN {points - 1}L ELSE (_b * {p1}L - 1) div _n1 END, {points - 1}L)")
    hit = (bounds.select(col, j_lo.alias("_jl"), j_hi.alias("_jh"))
           .filter(F.col("_jl") <= F.col("_jh"))
           .select(col, F.explode(F.sequence("_jl", "_jh")).alias("j"))
           .withColumn("n_total", total)
           .withColumn("i", F.floor(F.col("j") * (F.col("n_total") - 1) / max(points - 1, 1)) + 1))
    N = F.col("n_total").cast("double")
    m = (F.when(F.col("i") == N, F.pow(F.lit(0.5), 1 / N))
         .when(F.col("i") == 1, 1 - F.pow(F.lit(0.5), 1 / N))
         .otherwise((F.col("i") - 0.3175) / (N + 0.365)))
    return (hit.withColumn("m", m).withColumn("teorico", inverse_normal_udf(F.col("m")))
            .select(F.col("i").cast("bigint").alias("ordem"), "teorico", F.col(col).cast("double").alias("observado")))


def qq_line(df: DataFrame, col: str = "nps_score") -> DataFrame:
    """ST12: least-squares line of the ordered values on their normal scores, and
    their correlation, over all n rows: ``slope``, ``intercept``, ``r``, ``n``.

    A value's rows hold consecutive ranks; the sum of the scores over them comes
    in closed form with end corrections, so nothing is listed by rank.  The scores
    are symmetric: their mean is 0."""
    ranked = ranked_values(df, col)
    y, n = F.col(col).cast("double"), F.col("n").cast("double")
    scores = score_sum_udf(F.col("cum_before").cast("double"), (F.col("cum_before") + F.col("n")).cast("double"), F.col("total").cast("double"))
    mean = df.agg(F.avg(F.col(col).cast("double"))).scalar()
    one = (ranked.withColumn("_s", scores).withColumn("_d", y - mean)
           .agg(F.sum("n").alias("n"), F.max(mean).alias("intercept"), F.sum(F.col("_d") * F.col("_s")).alias("_sy"), F.sum(n * F.col("_d") * F.col("_d")).alias("_yy")))
    one = one.withColumn("_ss", score_square_sum_udf(F.col("n").cast("double")))
    return one.select((F.col("_sy") / F.nullif("_ss", F.lit(0.0))).alias("slope"), "intercept",
                      (F.col("_sy") / F.nullif(F.sqrt(F.col("_ss") * F.col("_yy")), F.lit(0.0))).alias("r"), "n")


def residual_bands(scored: DataFrame, y: str = "nps_score", pred: str = "prediction",
                   include_lowest: bool = False) -> DataFrame:
    """ST13: |error| mean and n per real-NPS band (0,3],(3,6],(6,8],(8,10];
    NPS exactly 0 falls outside unless ``include_lowest``."""
    spark = scored.sparkSession
    bid = C.band_id(y, [0, 3, 6, 8, 10], include_lowest)
    agg = (scored.withColumn("band_id", bid).filter(F.col("band_id").isNotNull()).groupBy("band_id")
           .agg(F.avg(F.abs(F.col(y) - F.col(pred))).alias("erro_medio_abs"), F.count(F.lit(1)).alias("n")))
    from voxpop.operators.features import band_dimension
    return F.broadcast(band_dimension(spark, "residual_band")).join(agg, "band_id", "left") \
        .withColumn("n", F.coalesce("n", F.lit(0)))


def residual_histogram(scored: DataFrame, y: str = "nps_score", pred: str = "prediction", bins: int = 30) -> DataFrame:
    """ST13: equal-width bins of the residual (real - predicted), as ``histogram``."""
    residual = F.col(y).cast("double") - F.col(pred).cast("double")
    return histogram(scored.select(residual.alias("residuo")), "residuo", bins)


def residual_summary(scored: DataFrame, y: str = "nps_score", pred: str = "prediction") -> DataFrame:
    e = F.col(y) - F.col(pred)
    return scored.agg(F.avg(F.abs(e)).alias("mae"), F.stddev(e).alias("residuo_std"),
                      F.avg(e).alias("residuo_medio"), F.count(F.lit(1)).alias("n"))

