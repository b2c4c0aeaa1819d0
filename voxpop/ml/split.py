"""Deterministic splits, folds and class weights (ML1, ML2, ML14, ML19 fold ids).

Splits hash the key with the seed (md5, identical in any SQL engine), so a
row's side never depends on partitioning.  The stratified exact split finds
each class's cut from counts per hash bucket (no class is ever sorted in one
task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def key_hash(key: str = "order_id", seed: int = 42, hex_digits: int = 8):
    """Integer from the first hex digits of md5(key || seed)."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(h, 1, hex_digits), 16, 10).cast("bigint")


def random_split(df: DataFrame, frac: float = 0.8, seed: int = 42, key: str = "order_id") -> DataFrame:
    """ML1: ``split`` = train when the 32-bit key hash falls below frac·2^32."""
    u = key_hash(key, seed, 8) / F.lit(4294967296.0)
    return df.withColumn("split", F.when(u < frac, "train").otherwise("test"))


def _hash_counts(hashed: DataFrame, label: str) -> DataFrame:
    """(label, _b, n, _before, _total): rows per class and hash bucket (the
    hash's first 16 bits), rows of the class in lower buckets, rows of the class.
    At most 65,536 rows a class, from one partial aggregation."""
    counts = hashed.filter(F.col(label).isNotNull()).groupBy(label, "_b").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy(label)
    return (counts.withColumn("_before", F.sum("n").over(by.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
            .withColumn("_total", F.sum("n").over(by)))


def _hashed(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn("_h", key_hash(key, seed, 15)).withColumn("_b", F.shiftright("_h", 44).cast("int"))


def stratified_split(df: DataFrame, label: str = "label", frac: float = 0.8, seed: int = 42,
                     key: str = "order_id") -> DataFrame:
    """ML2: exact per-class counts — the rows of class c with the
    ``n_c - ceil((1-frac) n_c)`` smallest 60-bit key hashes go to train.

    The hash is uniform, so per-class bucket counts name the one bucket that
    holds the cut; only its rows (about 1/65,536 of a class) are ranked for the
    cut's hash.  The rows themselves are then compared with one value per
    class: no shuffle or join of fact size."""
    hashed = _hashed(df, key, seed)
    n_train = F.col("_total") - F.ceil(F.col("_total") * (1 - frac))
    edge = (_hash_counts(hashed, label).withColumn("_need", n_train - F.col("_before"))
            .filter((F.col("_need") > 0) & (F.col("_need") <= F.col("n"))).select(label, "_b", "_need"))
    inside = hashed.select(label, "_h", "_b").join(F.broadcast(edge), [label, "_b"])  # one row a class
    by = Window.partitionBy(label).orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    cut = (inside.groupBy(label, "_h", "_need").agg(F.count(F.lit(1)).alias("n"))
           .withColumn("_before", F.sum("n").over(by) - F.col("n")).filter("_before < _need")
           .groupBy(label).agg(F.max("_h").alias("_cut")))
    return (hashed.filter(F.col(label).isNotNull()).join(F.broadcast(cut), label, "left")
            .withColumn("split", F.when(F.col("_h") <= F.col("_cut"), "train").otherwise("test"))
            .drop("_h", "_b", "_cut"))


def stratified_folds(df: DataFrame, label: str = "label", k: int = 5, seed: int = 42,
                     key: str = "order_id") -> DataFrame:
    """ML19 fold ids: position of the key hash inside its class, modulo k
    (fold sizes differ by at most one per class).  Rank inside the class's hash
    bucket plus the bucket's offset: one shuffle of the rows."""
    hashed = _hashed(df, key, seed)
    offset = _hash_counts(hashed, label).select(label, "_b", "_before")
    inside = F.rank().over(Window.partitionBy(label, "_b").orderBy("_h"))
    return (hashed.withColumn("_r", inside - 1).join(offset, [label, "_b"])
            .withColumn("fold", ((F.col("_before") + F.col("_r")) % k).cast("int")).drop("_h", "_b", "_r", "_before"))


def class_rates(split_df: DataFrame, label: str = "label") -> DataFrame:
    """Class rate per split (ML2 report)."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                         (F.avg(label) * 100).alias("taxa_positiva"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """ML14: balanced weights n / (2 n_c) per class (a 2-row table)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    total = F.sum("n_c").over(Window.partitionBy())
    k = F.count(F.lit(1)).over(Window.partitionBy())
    return counts.withColumn("weight", total / (k * F.col("n_c")))


def positive_scale(df: DataFrame, label: str = "label") -> DataFrame:
    """ML14: class counts and ``scale_pos`` = negatives / positives (NULL without a
    positive); rows without a label count for neither."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg"), F.try_divide(neg.cast("double"), pos).alias("scale_pos"))


def with_weights(df: DataFrame, label: str = "label", pos_weight: float | None = None) -> DataFrame:
    """Weight column: balanced (default) or a plain positive-class weight."""
    if pos_weight is not None:
        return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))
    w = class_weights(df, label).select(label, "weight")
    return df.join(F.broadcast(w), label)
