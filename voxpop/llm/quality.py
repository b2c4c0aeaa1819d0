"""Quality classifier: a Bradley-Terry model learned from preference pairs.

Every document has a score ``w . x(text)``; of a pair in which one document is
labelled good and the other bad, the good one is preferred with probability
sigmoid(score difference).  ``w`` minimises the logistic loss on the feature
differences of the pairs (L2-regularised, Newton steps).  The cut is the
quantile of the labelled scores at the share of bad documents, mapped to the
decision point ``cut_score``.

Learned from about ``sample`` labelled rows, chosen by a hash of the id (a
documented bound); every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxpop.functions.ranks import exact_quantiles
from voxpop.llm.textkit import apart, saved, slices, small_batches
from voxpop.operators.quality import may_be_among

LETTERS = bytes(b for b in range(256) if chr(b).isalpha() and b < 128)
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
MARKS = b"!#$%&*+<=>@[\\]^_`{|}~"
STOPS = b".,;:?"
FEATURES = 15


def features(text: str | None) -> np.ndarray:
    """Language-free surface statistics of one whole text."""
    b = (text or "").encode()
    words = b.split()
    n, nw = max(1, len(b)), max(1, len(words))
    share = lambda chars: 1 - len(b.translate(None, chars)) / n
    distinct = len(set(words))
    again = sum(map(bytes.__eq__, words, words[1:]))
    lines = b.split(b"\n")
    letters = max(1e-9, share(LETTERS))
    lower = b.lower().split()
    short = sum(len(w) <= 3 for w in words)
    marked = sum(w[-1] in MARKS for w in words)
    stopped = sum(w[-1] in STOPS for w in words)
    return np.array([
        np.log1p(len(words)), n / nw / 10, share(UPPER) / letters, share(MARKS), share(DIGITS), share(STOPS),
        distinct / nw, np.log(nw / max(1, distinct)), again / nw, len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        short / nw, marked / nw, stopped / nw, len(set(lower)) / max(1, distinct)])


def expanded(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """The features with hinges at the knots (quantiles of the sample)."""
    return np.concatenate([x, *(np.maximum(0, x - k) for k in knots)], axis=1)


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs: int, ridge: float = 1.0, seed: int = 5) -> np.ndarray:
    """Weights that minimise the mean logistic loss of ``pairs`` good-bad differences."""
    rng = np.random.default_rng(seed)
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(a) or not len(b):
        return np.zeros(x.shape[1])
    d = x[rng.choice(a, pairs)] - x[rng.choice(b, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # of the wrong order
        grad = -(d.T @ p) + ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """Scale, knots and weights; the cut once ``place`` has set it."""

    def __init__(self, x: np.ndarray, good: np.ndarray, pairs: int):
        self.mean = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
        self.std = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(FEATURES)
        z = (x - self.mean) / self.std
        self.knots = np.quantile(z, [0.1, 0.25, 0.5, 0.75, 0.9], axis=0) if len(x) else np.zeros((1, FEATURES))
        self.w = fit_pairs(expanded(z, self.knots), good, pairs) if len(x) else np.zeros(2 * FEATURES)
        self.fitted = bool(self.w.any())
        self.place(0.0, 1.0, 0.5)

    def place(self, cut: float, scale: float, cut_score: float) -> None:
        self.cut, self.scale = cut, max(1e-9, scale)
        self.shift = float(np.log(cut_score / (1 - cut_score)))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return expanded((x - self.mean) / self.std, self.knots) @ self.w

    def score(self, x: np.ndarray) -> np.ndarray:
        z = 4 * (self.raw(x) - self.cut) / self.scale + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _rows(text: str, of: Callable[[np.ndarray], np.ndarray], schema: pa.Schema):
    def part(batches):
        for batch in batches:
            for x in slices(batch, text):
                f = np.stack([features(t) for t in x.column(text).to_pylist()])
                cols = [x.column(c) for c in schema.names[:-1]]
                new = of(f)
                last = pa.array(list(new), schema.field(len(cols)).type)
                yield pa.RecordBatch.from_arrays([c.cast(g.type) for c, g in zip([*cols, last], schema)], schema=schema)
    return part


def _raw(model):
    def part(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(model.value.raw(x))], ["good", "raw"])
    return part


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = 20_000, cut_score: float = 0.3, pairs: int = 60_000) -> Model:
    """The model of the labelled rows of ``docs``.  Null labels are no labels; of
    several labels of one document the mean decides; repeated rows of a document
    count one by one; without good or without bad rows (an empty table has
    neither) every score is 0.5."""
    from pyspark.sql.pandas.types import to_arrow_type
    spark = docs.sparkSession
    small_batches(spark)
    marks = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id"))
             .agg((F.avg(label) >= 0.5).alias("good")))
    # a bitmap of the labelled ids lets their texts through (and few others); only features reach the exact join
    some = may_be_among(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(doc_id).alias("h")), "h", marks.select(F.xxhash64("id").alias("h")))
    kind = some.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("x", pa.list_(pa.float64()))])
    measured = some.select("id", "text").mapInArrow(_rows("text", lambda f: f, schema), f"id {kind.simpleString()}, x array<double>")
    known = saved(measured.join(marks, "id").select("id", "good", "x"), "quality-labelled")
    part = min(1.0, sample / max(1, known.count()))
    got = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(part * (1 << 30))).select("good", "x").toArrow()  # about ``sample`` rows
    x = np.stack(got["x"].to_numpy()) if got.num_rows else np.zeros((0, FEATURES))
    good = got["good"].to_numpy().astype(bool)
    order = np.lexsort([*x.T, good])  # the same fit however the rows arrive
    model = Model(x[order], good[order], pairs)
    if model.fitted:
        scored = saved(known.mapInArrow(_raw(spark.sparkContext.broadcast(model)), "good boolean, raw double"), "quality-raw")
        spread = scored.agg(F.avg((~F.col("good")).cast("double")).alias("bad"), F.stddev_pop("raw").alias("std")).first()
        cut = exact_quantiles(scored, "raw", [spread["bad"]]).first()[0]
        model.place(cut, spread["std"], cut_score)
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``__score`` (0 to 1; at the cut: the model's ``cut_score``).

    A null or empty text is scored by its features like any other; repeated rows
    are scored each; an empty table gives an empty one.  Other columns pass
    through; one called ``__score`` gets underscores behind its name."""
    docs = apart(docs, "__score")
    small_batches(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_rows(text, lambda f: sent.value.score(f), to_arrow_schema(schema)), schema)
