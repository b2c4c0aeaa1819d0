"""Linear, ridge and logistic regression from Gram tables, for all folds at once
(ML7, ML8, ML11, ML19).

A Gram table holds, for each fold, the sums of products of the design row
``(1, z..., y)``.  It is additive: the training rows of fold f are the total
less fold f, so one scan of the rows gives the ridge fits of every fold and, from
fold f's own table, their held-out R².  The table has folds x columns^2 numbers;
it is all that reaches the driver, which solves systems of the number of columns.

The logistic fit takes Newton steps on the penalised likelihood: one scan a step
gives gradient, curvature and loss of the models of all folds.  A step that
raises the loss is halved.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxpop.functions.ranks import cumulative


def _dot(z: str, beta: Column) -> Column:
    """Intercept and slopes applied to an array column."""
    parts = F.zip_with(F.col(z), F.slice(beta, 2, F.size(z)), lambda a, b: a * b)
    return F.element_at(beta, 1) + F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)


def standardised(df: DataFrame, columns: dict[str, Column], train: Column) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """``df`` with ``_z``: the columns less their mean over the ``train`` rows, by
    their population standard deviation there (a constant column is 0).  A row
    with a NULL feature has a NULL ``_z``; ``Gram`` tables and steps refuse it."""
    inside = df.where(train)
    one = inside.agg(*[f(c.cast("double")).alias(f"{n}_{i}") for i, c in enumerate(columns.values()) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    moments = {name: (one[f"m_{i}"], one[f"s_{i}"]) for i, name in enumerate(columns)}
    if None in [v for pair in moments.values() for v in pair]:
        raise ValueError("no training row with a value in: " + ", ".join(n for n, p in moments.items() if None in p))
    z = [(c.cast("double") - F.lit(m)) / F.lit(s) if s else F.when(c.isNotNull(), F.lit(0.0)) for (m, s), c in zip(moments.values(), columns.values())]
    whole = F.lit(True)
    for v in z:
        whole = whole & v.isNotNull()
    return df.withColumn("_z", F.when(whole, F.array(*z))), moments


def _refuse_gaps(df: DataFrame, y: str) -> None:
    gaps = df.where(F.col("_z").isNull() | F.col(y).isNull()).count()
    if gaps:
        raise ValueError(f"missing values in features or {y}: {gaps} rows")


def gram(df: DataFrame, y: str, fold: str) -> dict[int, np.ndarray]:
    """Sums of products of (1, z..., y) by fold, from one scan: a table a task and
    fold, added up."""
    _refuse_gaps(df, y)
    rows = df.select("_z", F.col(y).cast("double").alias("y"), F.col(fold).cast("int").alias("fold"))
    width = 2 + len(rows.first()["_z"])
    out: dict[int, np.ndarray] = {}
    for r in rows.mapInArrow(_products, "fold int, at int, v double").groupBy("fold", "at").agg(F.sum("v").alias("v")).collect():  # folds x columns^2
        out.setdefault(r["fold"], np.zeros((width, width))).flat[r["at"]] = r["v"]
    return out


def _design(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(1, z...), y and fold of a batch."""
    y, fold = batch.column("y").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False)
    z = batch.column("_z").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return np.hstack([np.ones((len(z), 1)), z]), y, fold


def _products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and fold: the sums of products of the design row and y."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        if batch.num_rows:
            x, y, fold = _design(batch)
            v = np.hstack([x, y[:, None]])
            for f in np.unique(fold):
                a = v[fold == f]
                sums[int(f)] = sums.get(int(f), 0.0) + a.T @ a
    for f, s in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, f), pa.int32()), pa.array(np.arange(s.size), pa.int32()), pa.array(s.ravel())], ["fold", "at", "v"])


def solve_ridge(g: np.ndarray, alpha: float) -> np.ndarray:
    """Intercept (unpenalised) and slopes of least squares with penalty ``alpha``."""
    a = g[:-1, :-1] + alpha * np.diag([0.0, *[1.0] * (len(g) - 2)])
    return np.linalg.lstsq(a, g[:-1, -1], rcond=1e-12)[0]


def r2(g: np.ndarray, beta: np.ndarray) -> float | None:
    """R² of ``beta`` over the rows of a Gram table."""
    n, s, yy = g[0, 0], g[0, -1], g[-1, -1]
    total = yy - s * s / n
    left = yy - 2 * beta @ g[:-1, -1] + beta @ g[:-1, :-1] @ beta
    return float(1 - left / total) if total > 0 else None


def ridge_by_fold(df: DataFrame, y: str, fold: str, alpha: float = 1.0) -> dict[int, tuple[np.ndarray, float | None]]:
    """For each fold the ridge fit on the other folds and its R² on the fold; one scan."""
    tables = gram(df, y, fold)
    total = sum(tables.values())
    fits = {f: solve_ridge(total - g, alpha) for f, g in tables.items()}
    return {f: (b, r2(tables[f], b)) for f, b in fits.items()}


def _step_sums(models: list[tuple[int | None, np.ndarray, float, float]]):
    """Per task and model: loss, gradient and curvature at the model's weights."""
    schema = pa.schema([("model", pa.int32()), ("at", pa.int32()), ("v", pa.float64())])

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [None] * len(models)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, fold = _design(batch)
            for k, (left_out, beta, w0, w1) in enumerate(models):
                use = slice(None) if left_out is None else fold != left_out
                a, b = x[use], y[use]
                w, t = np.where(b == 1, w1, w0), a @ beta
                p = 1 / (1 + np.exp(-np.clip(t, -700, 700)))
                loss = (w * (np.logaddexp(0, t) - b * t)).sum()
                new = np.concatenate([[loss], a.T @ (w * (p - b)), ((a * (w * p * (1 - p))[:, None]).T @ a).ravel()])
                sums[k] = new if sums[k] is None else sums[k] + new
        for k, s in enumerate(sums):
            if s is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), k), pa.int32()), pa.array(np.arange(len(s)), pa.int32()), pa.array(s)], schema=schema)
    return part


def logistic(df: DataFrame, y: str, fold: str | None = None, leave_out: Iterable[int | None] = (None,), C: float = 1.0, balanced: bool = False,
             tol: float = 1e-10, max_steps: int = 60) -> dict[int | None, np.ndarray]:
    """Weights (intercept unpenalised) of the logistic fits that leave out each of
    ``leave_out`` (None: no fold), minimising the summed weighted loss plus
    |slopes|² / (2C).  ``balanced``: class weights n / (2 n_c) of a model's own rows."""
    _refuse_gaps(df, y)
    rows = df.select("_z", F.col(y).cast("double").alias("y"), (F.lit(0) if fold is None else F.col(fold)).cast("int").alias("fold"))
    counts = {(r["fold"], int(r["y"])): r["n"] for r in rows.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}
    width = 1 + len(rows.first()["_z"])
    names = list(leave_out)
    weight = []
    for f in names:
        by = [sum(n for (g, c), n in counts.items() if c == k and g != f) for k in (0, 1)]
        weight.append([sum(by) / (2 * n) if balanced and n else 1.0 for n in by])
    penalty = np.array([0.0, *[1 / C] * (width - 1)])
    beta, last = [np.zeros(width) for _ in names], [None] * len(names)  # last: (loss, weights) the steps come from
    for _ in range(max_steps):
        models = [(f, b, w[0], w[1]) for f, b, w in zip(names, beta, weight)]
        found = rows.mapInArrow(_step_sums(models), "model int, at int, v double").groupBy("model", "at").agg(F.sum("v").alias("v")).collect()
        sums = np.zeros((len(names), 1 + width + width * width))
        for r in found:  # models x columns^2
            sums[r["model"], r["at"]] = r["v"]
        done = True
        for k, b in enumerate(beta):
            loss, grad = sums[k, 0] + (penalty * b * b).sum() / 2, sums[k, 1:1 + width] + penalty * b
            if last[k] is not None and loss > last[k][0] * (1 + 1e-14):  # too far: half way back
                beta[k], done = (b + last[k][1]) / 2, False
                continue
            curve = sums[k, 1 + width:].reshape(width, width) + np.diag(penalty)
            step = np.linalg.lstsq(curve, grad, rcond=1e-12)[0]
            last[k] = (loss, b)
            if np.abs(step).max() > tol * (1 + np.abs(b).max()):
                beta[k], done = b - step, False
        if done:
            break
    return dict(zip(names, beta))


def probability(df: DataFrame, betas: dict[int | None, np.ndarray], fold: str | None = None, name: str = "score") -> DataFrame:
    """P(positive) of each row by its fold's weights (or by the only ones)."""
    if fold is None:
        beta = F.array(*[F.lit(float(v)) for v in next(iter(betas.values()))])
    else:
        beta = F.element_at(F.create_map(*[c for f, b in betas.items() for c in (F.lit(int(f)), F.array(*[F.lit(float(v)) for v in b]))]), F.col(fold).cast("int"))
    return df.withColumn("_beta", beta).withColumn(name, 1 / (1 + F.exp(-_dot("_z", F.col("_beta"))))).drop("_beta")


def fold_scores(scored: DataFrame, y: str = "label", fold: str = "fold", score: str = "score") -> DataFrame:
    """``fold``, ``f1`` (score above 0.5) and ``auc`` of every fold, from one frequency table by fold and score."""
    hit = F.col(score) > 0.5
    tp, pp, yy = F.count_if(hit & (F.col(y) == 1)), F.count_if(hit), F.count_if(F.col(y) == 1)
    f1 = scored.groupBy(fold).agg(F.coalesce(F.try_divide(2.0 * tp, pp + yy), F.lit(0.0)).alias("f1"))
    by = scored.where(F.col(score).isNotNull()).groupBy(fold, score).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    r = cumulative(by.withColumn("n", F.col("pos") + F.col("neg")), score, [fold])
    n1, n0 = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    auc = r.groupBy(fold).agg(((F.sum(F.col("pos") * F.col("avg_rank")) - n1 * (n1 + 1) / 2) / F.nullif(n1 * n0, F.lit(0.0))).alias("auc"))
    return f1.join(auc, fold, "left")
