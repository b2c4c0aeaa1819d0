"""Target-distribution importance resampling by array-scored weights and a
distributed quickselect.

Every run of 1 to ``grams`` words is a feature; its bucket is the crc32 of its
UTF-8 bytes modulo ``buckets``.  One pass over each corpus counts the buckets
(one array a task), a native expression turns the two arrays into integer gains
(log ratio of the smoothed target and source shares), and a second pass scores
every document by looking its features up in the gain array, whose length is the
only thing that is broadcast.  A Gumbel term from the id's sha256 makes the
highest scores a weighted draw without replacement.

The draw is a quickselect over the composite key (score falling, id rising): a
round picks random pivot keys among the rows still open, counts the rows before
and at each pivot, and goes on between the two pivots that enclose the k-th key
until a pivot is that key.  Only counts and pivots reach the driver.  The rows
up to the k-th key alone are sorted and ranked, in ranges of the key.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxpop.llm.textkit import byte_mask, saved, small_batches

BUCKETS, GRAMS, SEED = 10000, 3, 42
MIN_WORDS, SHARE = 20, (5, 100)
PIVOTS = 15
RANGE_ROWS = 1 << 20  # rows to rank in one task

# A-Z in lower case; everything that is no ASCII letter, digit or byte of another character is a blank
_KEEP = byte_mask(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if _KEEP[b] else 32 for b in range(256))


def feature_buckets(text: str | None, grams: int, buckets: int) -> tuple[int, np.ndarray]:
    """Words of ``text`` and the buckets of its features, repeats included."""
    words = (text or "").encode().translate(_WORDS).split()
    crc = list(map(crc32, words))
    found = [crc]
    joined = [b" " + w for w in words[1:]]
    for n in range(1, grams):  # the crc of a run goes on from that of the run one word shorter
        crc = list(map(crc32, joined[n - 1:], crc))
        found.append(crc)
    out = np.fromiter((c for run in found for c in run), np.int64, sum(map(len, found)))
    return len(words), out % buckets


def _counts(grams: int, buckets: int):
    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(feature_buckets(text.as_py(), grams, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])
    return part


def bucket_counts(docs: DataFrame, text: str, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``n``: features of all texts by bucket (buckets without any are missing)."""
    small_batches(docs.sparkSession)
    part = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_counts(grams, buckets), "bucket long, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``gain`` of every bucket, from the two tables of counts:
    floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))."""
    both = (source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
            .unionByName(source.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))))
    by = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    one = Window.partitionBy()  # over the buckets only
    by = by.withColumn("all_s", F.sum("s").over(one)).withColumn("all_t", F.sum("t").over(one))
    up = (F.col("t") + 1).cast("double") * (F.col("all_s") + buckets).cast("double")
    down = (F.col("s") + 1).cast("double") * (F.col("all_t") + buckets).cast("double")
    return by.select("bucket", F.floor(1000 * F.log(up / down)).alias("gain"))


def _weights(gain, grams: int, buckets: int):
    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(gain.value, np.int64)
        for batch in batches:
            rows = [(n, len(b), int(table[b].sum())) for n, b in (feature_buckets(t.as_py(), grams, buckets) for t in batch.column(1))]
            n, f, w = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in (n, f, w))], ["doc_id", "n_words", "n_features", "weight"])
    return part


def gumbel(doc_id: str | Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))), u from the first 32 bits of sha256('seed:id')."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def scores(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
           grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` of every row of ``docs``."""
    spark = docs.sparkSession
    table = gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, target_text, grams, buckets), buckets)
    array = np.zeros(buckets, np.int64)
    for r in table.collect():  # ``buckets`` rows
        array[r["bucket"]] = r["gain"]
    gain = spark.sparkContext.broadcast(array.tobytes())
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(_weights(gain, grams, buckets), "doc_id long, n_words long, n_features long, weight long")
    return out.withColumn("score", F.col("weight") + gumbel("doc_id", seed))


def _before(score: Column, doc_id: Column, key: tuple) -> Column:
    """Higher score than ``key``'s, or the same and a smaller id (null first)."""
    ahead = F.lit(False) if key[1] is None else doc_id.isNull() | (doc_id < key[1])
    return (score > key[0]) | ((score == key[0]) & ahead)


def _equal(score: Column, doc_id: Column, key: tuple) -> Column:
    return (score == key[0]) & doc_id.eqNullSafe(F.lit(key[1]))


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> tuple:
    """The k-th of the composite keys (``score`` falling, ``doc_id`` rising) of ``rows``, 1 <= k <= their number."""
    cols = (F.col("score"), F.col("doc_id"))
    low = high = None  # the k-th key lies between these two
    done, turn = 0, 0  # rows up to low
    while True:
        inside = rows if low is None else rows.where(~_before(*cols, low) & ~_equal(*cols, low))
        inside = inside if high is None else inside.where(_before(*cols, high))
        found = inside.select(*cols).orderBy(F.xxhash64(F.lit(turn), *cols)).limit(pivots).collect()
        found = sorted({(r[0], r[1]) for r in found}, key=lambda p: (-p[0], p[1] is not None, p[1] or 0))
        n = inside.agg(*[F.count_if(_before(*cols, p)).alias(f"before{i}") for i, p in enumerate(found)],
                       *[F.count_if(_equal(*cols, p)).alias(f"equal{i}") for i, p in enumerate(found)]).first()
        passed = done
        for i, p in enumerate(found):
            before, upto = done + n[f"before{i}"], done + n[f"before{i}"] + n[f"equal{i}"]
            if before < k <= upto:
                return p
            if k <= before:
                high = p
                break
            low, passed = p, upto
        done, turn = passed, turn + 1


def draw(scored: DataFrame, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, pivots: int = PIVOTS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... for the floor(share * N) highest scores
    of the N rows with at least ``min_words`` words, equal scores by smaller id;
    null for all others.  Equal rows are ranked one after the other."""
    cols = ["doc_id", "n_words", "n_features", "weight", "score"]
    rows = saved(scored.select(*cols), "draw-scores")
    able = rows.where(F.col("n_words") >= min_words)
    k = share[0] * able.count() // share[1]
    none = F.lit(None).cast("long").alias("rank")
    if k == 0:
        return rows.select(*cols, none)
    last = kth_key(able, k, pivots)
    key = (F.col("score"), F.col("doc_id"))
    wins = (F.col("n_words") >= min_words) & (_before(*key, last) | _equal(*key, last))
    won = rows.where(wins).groupBy(*cols).agg(F.count("*").alias("m"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features"), F.col("weight"), F.col("n_words")]
    parts = max(1, -(-k // range_rows))
    won = saved(won.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "draw-won")
    # ranges of the key: rows ahead of a range from one count a range
    sizes = won.groupBy("part").agg(F.sum("m").alias("n"))
    ahead = sizes.select(F.col("part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    upto = F.sum("m").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    ranked = won.join(F.broadcast(ahead), "part").withColumn("first", F.col("ahead") + upto - F.col("m"))
    ranked = ranked.withColumn("rank", F.explode(F.sequence(F.col("first") + 1, F.col("first") + F.col("m"))))
    ranked = ranked.select(*cols, F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))
    return ranked.unionByName(rows.where(~wins).select(*cols, none))


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` of every row of ``docs``.

    A null or empty text has no words and no features: weight 0, never drawn.
    A null id draws as the empty text and comes before every other id.  Rows
    that repeat an id count one by one; equal scores go to the smaller id.  An
    empty table gives an empty result, an empty target the gains of the source
    alone.  Other columns are not read.
    """
    return draw(scores(docs, target, doc_id, text, target_text, grams, buckets, seed), share, min_words)


def drawn(docs: DataFrame, ranked: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` (all their columns) whose id was drawn."""
    ids = ranked.where("rank is not null").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(ids, F.col(doc_id).cast("long").eqNullSafe(F.col("__drawn")), "left_semi")
