"""Distributed cumulative counts over sorted values: average ranks with ties,
exact quantiles, rank sums.

Nothing here sorts the fact table, looks at a column's name or size first, or
runs a job while a plan is built.  Values fall into order-preserving ranges
(``value_range``: 512 ranges an octave of the number), whose number is bounded
by the type, not by the rows.

* Running counts (``cumulative``): rows are reduced to a frequency table
  ``(group..., value, n)``, dealt by range and cell (the next 22 mantissa bits).
  A window per cell counts inside it, one per range over the totals of its cells,
  one per group over the totals of its ranges.  However narrow or wide the values,
  no window partition has more than 2^22 rows: a cell holds 2^21 doubles, a range
  2^22 cells, a group about 2^21 ranges.
* Quantiles (``exact_quantiles``): range counts straight from the rows (a partial
  aggregation) name the one or two ranges that hold each order statistic, and
  only the rows of those ranges are counted by value: no shuffle of fact size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ranges per octave, and the least binary exponent of a double
PER_OCTAVE, LEAST_EXPONENT = 1 << 9, -1074
CELLS = 1 << 22  # cells of a range: the mantissa's 52 bits are 9 for the range, 22 for the cell, 21 inside
MANY = 1 << 20  # rows from which a range that holds a quantile is cut into cells
FIRST = (Window.unboundedPreceding, -1)


def value_range(value: str) -> Column:
    """Number of the range that holds the value, rising with it (NaN last).

    Exponent and leading mantissa bits of the double, by arithmetic.  The formula
    is continuous across powers of two, so a logarithm that is off in its last
    digit there gives the same range."""
    x = F.col(value).cast("double")
    size = F.abs(x)
    exponent = F.floor(F.log2(size))
    inside = F.floor((size / F.pow(F.lit(2.0), exponent.cast("double")) - 1) * PER_OCTAVE)
    number = (exponent - LEAST_EXPONENT) * PER_OCTAVE + inside + 1
    top = 1 << 28
    return (F.when(F.isnan(x), F.lit(top + 1)).when(x == 0, F.lit(0)).when(size == float("inf"), F.signum(x) * top)
            .otherwise(F.signum(x) * number).cast("long"))


def value_cell(value: str) -> Column:
    """Number of the value's cell inside its range, rising with the value: the
    next 22 mantissa bits (0 for zero, infinities and NaN)."""
    x = F.col(value).cast("double")
    size = F.abs(x)
    inside = (size / F.pow(F.lit(2.0), F.floor(F.log2(size)).cast("double")) - 1) * PER_OCTAVE
    cell = F.floor((inside - F.floor(inside)) * CELLS)
    return (F.when(F.isnan(x) | (x == 0) | (size == float("inf")), F.lit(0))
            .when(x < 0, F.lit(CELLS - 1) - cell).otherwise(cell).cast("int"))


def frequencies(df: DataFrame, value: str, by=(), weight: str | None = None) -> DataFrame:
    """(by..., value, n) over non-null values; ``weight`` sums a count column."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return (df.filter(F.col(value).isNotNull()).groupBy(*by, value)
            .agg(n.cast("bigint").alias("n")))


def _range_sums(ranged: DataFrame, by: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """(by..., _range) with ``_sum_<c>``, ``_off_<c>`` (sum over lower ranges of
    the group) and ``total_<c>``."""
    t = ranged.groupBy(*by, "_range").agg(*[s.cast("bigint").alias(f"_sum_{c}") for c, s in sums.items()])
    lower = Window.partitionBy(*by).orderBy("_range").rowsBetween(*FIRST)
    for c in sums:
        t = (t.withColumn(f"_off_{c}", F.coalesce(F.sum(f"_sum_{c}").over(lower), F.lit(0)))
             .withColumn(f"total_{c}", F.sum(f"_sum_{c}").over(Window.partitionBy(*by))))
    return t


def _join_keys(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``other``; a NULL group is a group."""
    right = other.withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(keys)})
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & rows[k].eqNullSafe(right[f"_key_{i}"])
    return rows.join(right, on, how).drop(*[f"_key_{i}" for i in range(len(keys))])


def cumulative(freq: DataFrame, value: str, by=(), also=()) -> DataFrame:
    """Adds ``cum_before`` (count of smaller values in the group), ``total``
    (count in the group) and ``avg_rank`` = cum_before + (n + 1) / 2.
    Each column ``c`` of ``also`` gets the same running sum as
    ``cum_before_<c>`` (sum over smaller values) and ``total_<c>``."""
    by = list(by)
    sums = ["n"] + [c for c in also if c != "n"]
    keys = [*by, "_range", "_cell"]
    dealt = freq.withColumns({"_range": value_range(value), "_cell": value_cell(value)}).repartition(*keys)
    # cells of a range, ranges of a group: the totals of the one from those of the other
    cells = dealt.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(f"_cell_{c}") for c in sums])
    lower = Window.partitionBy(*by, "_range").orderBy("_cell").rowsBetween(*FIRST)
    for c in sums:
        cells = cells.withColumn(f"_in_{c}", F.coalesce(F.sum(f"_cell_{c}").over(lower), F.lit(0)))
    ranges = _range_sums(cells, by, {c: F.sum(f"_cell_{c}") for c in sums}).drop(*[f"_sum_{c}" for c in sums])
    cells = _join_keys(cells.drop(*[f"_cell_{c}" for c in sums]), ranges, [*by, "_range"])
    below = Window.partitionBy(*keys).orderBy(value).rowsBetween(*FIRST)
    for c in sums:
        dealt = dealt.withColumn(f"_at_{c}", F.coalesce(F.sum(c).over(below), F.lit(0)))
    out = _join_keys(dealt, cells, keys)
    for c in sums:
        out = out.withColumn(f"cum_before_{c}", F.col(f"_off_{c}") + F.col(f"_in_{c}") + F.col(f"_at_{c}"))
    out = (out.drop("_range", "_cell", *[f"_{k}_{c}" for c in sums for k in ("off", "in", "at")])
           .withColumnsRenamed({"cum_before_n": "cum_before", "total_n": "total"}))
    return out.withColumn("avg_rank", F.col("cum_before") + (F.col("n") + 1) / 2.0)


def ranked_values(df: DataFrame, value: str, by=(), weight: str | None = None) -> DataFrame:
    """(by..., value, n, cum_before, total, avg_rank) from raw rows."""
    return cumulative(frequencies(df, value, by, weight), value, by)


def _tag(p: float) -> str:
    return f"{round(p * 100, 6):g}".replace(".", "_")


def _held(p: float, total: str, before: str, n: str) -> tuple[Column, Column, Column]:
    """Position of a quantile, and whether its lower / upper order statistic is
    among the ``n`` that follow ``before``."""
    pos = F.lit(p) * (F.col(total) - 1)
    hit = lambda i: (F.col(before) <= i) & (i < F.col(before) + F.col(n))
    return pos, hit(F.floor(pos)), hit(F.ceil(pos))


def exact_quantiles(df: DataFrame, value: str, probs, by=(), many: int = MANY) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas ``quantile`` / Spark
    ``percentile``): one row per group with a column ``q<pct>`` per
    probability.  ``by`` are labels (classes, bands, regions, variable names):
    the named ranges, at most two for each group and probability, are broadcast.
    Only the values of a named range are shuffled, once each; one with more than
    ``many`` rows is counted cell by cell."""
    by = list(by)
    rows = df.filter(F.col(value).isNotNull()).select(*by, value).withColumn("_range", value_range(value))
    ranges = _range_sums(rows, by, {"n": F.count(F.lit(1))})
    named = F.lit(False)
    for p in probs:
        _, low, high = _held(p, "total_n", "_off_n", "_sum_n")
        named = named | low | high
    ranges = ranges.filter(named).withColumn("_many", F.col("_sum_n") > many).drop("_sum_n")
    inside = (_join_keys(rows, F.broadcast(ranges), [*by, "_range"])
              .groupBy(*by, "_range", value, "_off_n", "_many", F.col("total_n").alias("total")).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("_cell", F.when(F.col("_many"), value_cell(value)).otherwise(F.lit(0))))
    # of the cells, too, only those that hold a quantile are kept and broadcast
    keys = [*by, "_range", "_cell"]
    cells = inside.groupBy(*keys).agg(F.sum("n").alias("_sum"), F.max("_off_n").alias("_off"), F.max("total").alias("_total"))
    lower = Window.partitionBy(*by, "_range").orderBy("_cell").rowsBetween(*FIRST)
    cells = cells.withColumn("_off", F.col("_off") + F.coalesce(F.sum("_sum").over(lower), F.lit(0)))
    named = F.lit(False)
    for p in probs:
        _, low, high = _held(p, "_total", "_off", "_sum")
        named = named | low | high
    inside = _join_keys(inside, F.broadcast(cells.filter(named).select(*keys, "_off")), keys)
    below = Window.partitionBy(*keys).orderBy(value).rowsBetween(*FIRST)
    inside = inside.withColumn("cum_before", F.col("_off") + F.coalesce(F.sum("n").over(below), F.lit(0)))
    return quantiles_from_ranks(inside, value, probs, by)


def quantile(value: str, p: float, total: str = "total", before: str = "cum_before", n: str = "n") -> Column:
    """Aggregate over the value rows of a ``cumulative`` table: the linear
    interpolation between the two order statistics around the position."""
    pos, low, high = _held(p, total, before, n)
    at = lambda held: F.max(F.when(held, F.col(value).cast("double")))
    return at(low) + (at(high) - at(low)) * F.max(pos - F.floor(pos))


def quantiles_from_ranks(r: DataFrame, value: str, probs, by=()) -> DataFrame:
    """Exact linear-interpolation quantiles from a ``cumulative`` table: the
    values at the two order statistics around each position, one grouped
    aggregation (one row per group, a column ``q<pct>`` per probability)."""
    return r.groupBy(*by).agg(*[quantile(value, p).alias(f"q{_tag(p)}") for p in probs])


def stacked(df: DataFrame, cols: Sequence[str], by=(), name: str = "variable", value: str = "v") -> DataFrame:
    """(by..., name, value): one row per row and column, values as doubles."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(*by, F.explode(pairs).alias("_s")).select(*by, "_s.*")
