"""Data-quality and profiling (DQ1-DQ9).

Each check is ONE aggregation pass over the table (partial aggregation on the
executors, a tiny final merge) whose single wide row is turned long with
``explode(array(struct...))`` — never one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxpop.functions.ranks import exact_quantiles, stacked
from voxpop.schema import RANGE_RULES


def _numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType, T.FloatType,
                                       T.ShortType, T.DecimalType))]


def _long(agg_row: DataFrame, structs: list) -> DataFrame:
    return agg_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def shape(df: DataFrame) -> DataFrame:
    """DQ1: one row per column with its position and type, plus table rows/cols."""
    n_cols = len(df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    structs = [F.struct(F.lit(f.name).alias("coluna"), F.lit(i).alias("ordinal"),
                        F.lit(f.dataType.simpleString()).alias("dtype"),
                        F.col("n_rows"), F.lit(n_cols).alias("n_cols"))
               for i, f in enumerate(df.schema.fields)]
    return _long(counted, structs)


def describe(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """DQ2: count/mean/std/min/25/50/75/max per numeric column.

    Every column is stacked into (column, value) rows right after the scan, so
    the moments are five aggregates grouped by column (a narrow buffer that
    stays inside whole-stage codegen, partial aggregation on the executors)
    instead of one very wide row.  The exact quartiles of all columns come from
    the same stack by range counts.  ``exact=False`` uses ``percentile_approx``."""
    cols = cols or _numeric_cols(df)
    probs = [0.25, 0.5, 0.75]
    stack = stacked(df, cols, name="coluna")
    v = F.col("v")
    aggs = [F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max")]
    if not exact:
        aggs.append(F.percentile_approx(v, probs, 10000).alias("_q"))
    moments = stack.groupBy("coluna").agg(*aggs)
    if not exact:
        return moments.select("coluna", "count", "mean", "std", "min",
                              *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(("p25", "p50", "p75"))],
                              "max")
    out = moments.join(exact_quantiles(stack, "v", probs, ["coluna"]), "coluna", "left")
    return out.select("coluna", "count", "mean", "std", "min", F.col("q25").alias("p25"), F.col("q50").alias("p50"),
                      F.col("q75").alias("p75"), "max")


def null_counts(df: DataFrame) -> DataFrame:
    """DQ3: NULL (and NaN) count per column, plus a ``__total__`` row."""
    def is_missing(f):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return c.isNull() | F.isnan(c)
        return c.isNull()
    aggs = [F.sum(is_missing(f).cast("bigint")).alias(f.name) for f in df.schema.fields]
    row = df.agg(*aggs)
    total = None
    for f in df.schema.fields:
        total = F.col(f.name) if total is None else total + F.col(f.name)
    structs = [F.struct(F.lit(f.name).alias("coluna"), F.coalesce(F.col(f.name), F.lit(0)).alias("nulls"))
               for f in df.schema.fields]
    structs.append(F.struct(F.lit("__total__").alias("coluna"), F.coalesce(total, F.lit(0)).alias("nulls")))
    return _long(row, structs).orderBy(F.desc("nulls"), "coluna")


FILTER_BITS = 1 << 27  # 16 MB, sent to every task


def may_be_among(rows: DataFrame, hashed: str, marked: DataFrame) -> DataFrame:
    """``rows`` whose ``hashed`` value may be among those of ``marked`` (same
    column): a bitmap of ``FILTER_BITS`` bits, all its marks and few others pass.
    At most 4,096 bitmaps of 4 KB are broadcast, whatever the size of ``marked``."""
    place = F.pmod(F.col(hashed), F.lit(FILTER_BITS)) + 1
    maps = marked.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_map"))
    bit = F.bitmap_bit_position(place)
    octet = F.conv(F.hex(F.substring("_map", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    out = rows.withColumn("_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(maps), "_bucket")
    return out.where(F.getbit(octet, (bit % 8).cast("int")) == 1).drop("_bucket", "_map")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """DQ4: rows, distinct rows and rows beyond the first of each identical row.

    First 128-bit hashes of the rows are counted, then the rows whose hash was
    seen twice (found by a bitmap of fixed size, without a shuffle) are compared
    in full.  What is shuffled for the others does not depend on their width."""
    h1, h2 = free_name("_h1", df), free_name("_h2", df)
    cols = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.withColumns({h1: F.xxhash64(F.lit(1), *cols), h2: F.xxhash64(F.lit(2), *cols)})
    seen = hashed.groupBy(h1, h2).agg(F.count(F.lit(1)).alias("n"))
    suspects = may_be_among(hashed, h1, seen.where("n > 1").select(h1)).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    beyond = suspects.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).scalar()
    return seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.max(beyond).alias("_b")).select(
        "n_rows", (F.col("n_rows") - F.coalesce("_b", F.lit(0))).alias("n_distinct_rows"), F.coalesce("_b", F.lit(0)).alias("duplicate_rows"))


def free_name(name: str, df: DataFrame) -> str:
    while name.lower() in [c.lower() for c in df.columns]:
        name += "_"
    return name


def distinct_integers(df: DataFrame, cols) -> DataFrame:
    """``key``, ``n_rows``, ``n_filled``, ``n_distinct`` of integer columns, one pass.

    Keys are gathered as words of 64 bits (``key div 64`` and the bit inside, merged
    by OR): dense ids take 1/64 of the rows that distinct keys would, sparse ones
    a row each; the words' bits are counted at the end."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("bigint").alias("v")) for c in cols])
    long = df.select(F.explode(pairs).alias("_p")).select("_p.*")
    word = F.shiftright("v", 6)
    bits = F.when(F.col("v").isNotNull(), F.expr("shiftleft(1L, CAST(v & 63 AS INT))"))
    words = long.groupBy("key", word.alias("word")).agg(F.bit_or(bits).alias("bits"), F.count(F.lit(1)).alias("n"), F.count("v").alias("filled"))
    return words.groupBy("key").agg(F.sum("n").alias("n_rows"), F.sum("filled").alias("n_filled"), F.sum(F.coalesce(F.bit_count("bits"), F.lit(0))).alias("n_distinct"))


def duplicate_keys(df: DataFrame, keys=("order_id", "customer_id")) -> DataFrame:
    """DQ5: per key column: rows, distinct keys, duplicates, unique ratio.
    A key column missing from the table yields a row of NULLs.

    Integer keys are counted together as bits of words; a key of another type by
    an exact grouping of its own."""
    spark = df.sparkSession
    kinds = dict(df.dtypes)
    whole = [k for k in keys if kinds.get(k) in ("tinyint", "smallint", "int", "bigint")]
    parts = [distinct_integers(df, whole)] if whole else []
    for k in keys:
        if k in kinds and k not in whole:
            by = df.groupBy(F.col(f"`{k}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
            parts.append(by.agg(F.lit(k).alias("key"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                                F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("n_filled"), F.count("v").alias("n_distinct")))
    dim = spark.createDataFrame([(i, k, k in kinds) for i, k in enumerate(keys)], "_i int, key_column string, present boolean")
    counts = spark.createDataFrame([], "key string, n_rows bigint, n_filled bigint, n_distinct bigint")
    for p in parts:
        counts = counts.unionByName(p)
    rows = df.agg(F.count(F.lit(1))).scalar()  # an empty table or a missing key has no counts
    out = F.broadcast(dim).join(counts, F.col("key_column") == F.col("key"), "left")
    distinct = F.when(F.col("present"), F.coalesce("n_distinct", F.lit(0)))
    return out.select("key_column", "present", F.coalesce("n_rows", rows).alias("n_rows"), distinct.alias("n_distinct"),
                      (F.coalesce("n_filled", F.lit(0)) - distinct).alias("duplicates"),
                      (distinct / F.nullif(F.coalesce("n_rows", rows), F.lit(0))).alias("unique_ratio"))


def range_check(df: DataFrame, rules=RANGE_RULES) -> DataFrame:
    """DQ6 (J6): observed min/max per rule column (one pass), unpivoted and
    joined to the small fixed rules table; ``ok`` when inside the bounds."""
    spark = df.sparkSession
    cols = list(dict.fromkeys(r[0] for r in rules))
    row = df.agg(*[F.min(F.col(c).cast("double")).alias(f"{c}__min") for c in cols],
                 *[F.max(F.col(c).cast("double")).alias(f"{c}__max") for c in cols])
    observed = _long(row, [F.struct(F.lit(c).alias("coluna"), F.col(f"{c}__min").alias("observed_min"),
                                    F.col(f"{c}__max").alias("observed_max")) for c in cols])
    rules_df = spark.createDataFrame(
        [(c, float(lo), None if hi is None else float(hi), d) for c, lo, hi, d in rules],
        "coluna string, rule_min double, rule_max double, description string")
    out = F.broadcast(rules_df).join(observed, "coluna", "left")
    ok = (F.col("observed_min") >= F.col("rule_min")) & (
        F.col("rule_max").isNull() | (F.col("observed_max") <= F.col("rule_max")))
    return out.withColumn("ok", ok)


def continuity_check(df: DataFrame, col: str = "nps_score") -> DataFrame:
    """DQ7: how many values are fractional; distinct values; range."""
    x = F.col(col)
    return df.agg(
        F.lit(col).alias("coluna"),
        F.count(x).alias("n"),
        F.sum((x != F.floor(x)).cast("bigint")).alias("non_integer"),
        (F.avg((x != F.floor(x)).cast("double")) * 100).alias("pct_non_integer"),
        F.countDistinct(x).alias("n_distinct"),
        F.min(x).cast("double").alias("min"), F.max(x).cast("double").alias("max"))


def key_metrics(df: DataFrame) -> DataFrame:
    """DQ8: rows, columns, mean and median NPS, repurchase %."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"),
        F.avg("nps_score").alias("nps_medio"), exact_quantiles(df, "nps_score", [0.5]).select("q50").scalar().alias("nps_mediano"),
        (F.avg("repeat_purchase_30d") * 100).alias("pct_recompra"))


def preview(df: DataFrame, n: int = 5, by: str = "order_id") -> DataFrame:
    """DQ9: first n rows by key (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(by).limit(n)
