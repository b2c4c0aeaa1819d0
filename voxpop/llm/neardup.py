"""MinHash near-dedup by a multi-index Hamming join.

A document's set is its distinct ``shingle``-word shingles.  Its signature is
``chunks * width`` min-hashes of 16 bits each; the signature distance of two
documents is the number of positions that differ (expected: 1 - J of them).
Cut into ``chunks`` chunks, two signatures within distance
``(errors + 1) * chunks - 1`` have a chunk with at most ``errors`` differing
positions (pigeonhole).  The allowed errors are enumerated: each chunk is
indexed under every choice of ``errors`` ignored positions, so that every pair
within the distance meets under a key.  With the defaults (20 chunks of 4, one
error) that is distance 39 of 80; a pair with J = 0.75 expects 20 and exceeds
39 with a probability below 1e-6.  All links are confirmed on the full sets.

Groups of copies are never expanded into pairs:

* documents with equal sets are one class, searched once;
* under a key every member is first paired with the key's smallest member
  only; confirmed links are merged into components;
* what is left are pairs of different components under one key.  Among their
  documents, a shingle held once is not shared; those held by at most ``rare``
  documents are counted for each pair (at most ``rare`` rows a posting); of the
  frequent ones two documents share at most the smaller number.  Only pairs for
  which that bound allows the similarity are formed and confirmed.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxpop.llm.graph import components
from voxpop.llm.textkit import U, mix, saved, slices, small_batches, word_hashes
from voxpop.operators.quality import may_be_among

SHINGLE = 5
PERCENT = 75
CHUNKS, WIDTH, ERRORS = 20, 4, 1


def _shingles(col: pa.Array, n: int):
    """Distinct shingle hashes of each row, rising, and where each row's begin."""
    h, counts = word_hashes(col)
    first = np.concatenate([[0], np.cumsum(counts)])
    m = np.maximum(counts - n + 1, np.minimum(counts, 1))  # fewer words: the whole sequence
    rows = np.repeat(np.arange(len(counts)), m)
    begin = np.concatenate([[0], np.cumsum(m)])
    at = first[rows] + (np.arange(len(rows)) - begin[rows])
    size = np.minimum(counts, n)[rows]
    out = size.astype(U)
    for k in range(n):
        use = size > k
        out[use] = mix(out[use] * U(0x9E3779B97F4A7C15) + h[at[use] + k])
    order = np.lexsort((out, rows))
    out, rows = out[order], rows[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (rows[1:] != rows[:-1])
    out, rows = out[new], rows[new]
    return out, np.searchsorted(rows, np.arange(len(counts) + 1))


def _salts(n: int) -> np.ndarray:
    return np.random.default_rng(11).integers(0, 1 << 62, n, dtype=np.int64).astype(U) * U(2) + U(1)


def signatures(shingles: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """16-bit min-hash symbols, one row of ``n`` for each document (empty sets: zeros)."""
    out = np.zeros((len(begin) - 1, n), np.uint16)
    rows = np.flatnonzero(np.diff(begin))
    salts = _salts(n)
    i = 0
    while i < len(rows):  # some documents at a time: the hashes stay in cache
        j = max(i + 1, int(np.searchsorted(begin[rows], begin[rows[i]] + (1 << 15), side="right")))
        a, b = begin[rows[i]], begin[rows[min(j, len(rows)) - 1] + 1]
        x, cut = shingles[a:b], begin[rows[i:j]] - a
        for k in range(n):
            least = np.minimum.reduceat((x ^ (salts[k] >> U(3))) * salts[k], cut)
            out[rows[i:j], k] = (mix(least) >> U(48)).astype(np.uint16)
        i = j
    return out


def _sketch(doc_id: str, text: str, n: int, length: int):
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("sig", pa.binary())])

    def part(batches):
        for batch in batches:
            for x in slices(batch, text):
                sh, begin = _shingles(x.column(text), n)
                size = np.diff(begin)
                full = np.flatnonzero(size)
                c1, c2 = np.zeros(len(size), U), np.zeros(len(size), U)
                if len(full):  # the class: two sums of mixed hashes and the size
                    c1[full] = mix(np.add.reduceat(mix(sh), begin[full]) + size[full].astype(U))
                    c2[full] = mix(np.add.reduceat(mix(sh ^ U(0x5851F42D4C957F2D)), begin[full]))
                sig = signatures(sh, begin, length)
                yield pa.RecordBatch.from_arrays([x.column(doc_id), pa.array(size, pa.int64()), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)),
                                                  pa.array([s.tobytes() for s in sig], pa.binary())], schema=schema)

    return part


def _index_keys(chunks: int, width: int, errors: int):
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64())])
    kept = [[c * width + i for i in range(width) if i not in gone] for c in range(chunks) for gone in combinations(range(width), errors)]

    def part(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(batch.num_rows, -1).astype(U)
            ids = batch.column("doc")
            for name, cols in enumerate(kept):
                key = np.full(len(sig), U(name + 1))
                for c in cols:
                    key = mix(key * U(0x9E3779B97F4A7C15) + sig[:, c])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), ids], schema=schema)

    return part


def _near(limit: int):
    """Pairs whose signatures differ in at most ``limit`` positions."""
    def part(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
                yield batch.select(["a", "b"]).filter(pa.array((a != b).sum(axis=1) <= limit))
    return part


def _sets(doc_id: str, text: str, n: int):
    schema = pa.schema([("doc", pa.int64()), ("s", pa.list_(pa.int64()))])

    def part(batches):
        for batch in batches:
            for x in slices(batch, text):
                sh, begin = _shingles(x.column(text), n)
                yield pa.RecordBatch.from_arrays([x.column(doc_id), pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(sh.view(np.int64)))], schema=schema)

    return part


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc``, ``text`` of the documents in ``ids`` (``doc``, distinct).  A bitmap
    of fixed size keeps the texts of most others out of the exchange; the join
    behind it is exact."""
    marked = ids.select(F.xxhash64("doc").alias("h"))
    some = may_be_among(docs.select("doc", "text", F.xxhash64("doc").alias("h")), "h", marked)
    return some.drop("h").join(ids, "doc", "left_semi")


def confirmed(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``pairs`` (a, b) whose full sets reach the similarity; ``docs`` has ``doc``, ``text``.

    Only the sets of documents in pairs are made, anew from their texts."""
    pairs = saved(pairs, "dup-pairs")
    need = saved(pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct(), "dup-need")
    sets = saved(_texts_of(docs, need).mapInArrow(_sets("doc", "text", n), "doc long, s array<long>"), "dup-sets")
    left = sets.select(F.col("doc").alias("a"), F.col("s").alias("x"))
    right = sets.select(F.col("doc").alias("b"), F.col("s").alias("y"))
    both = pairs.join(left, "a").join(right, "b").withColumn("i", F.size(F.array_intersect("x", "y")).cast("long"))
    return both.where(f"100 * i >= {int(percent)} * (size(x) + size(y) - i)").select("a", "b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
                    chunks: int = CHUNKS, width: int = WIDTH, errors: int = ERRORS, rare: int = 8) -> DataFrame:
    """``doc`` (distinct non-null ids), ``n`` (set size), ``comp`` (smallest id of the group).

    A text without words (or null) has an empty set and links with nothing;
    rows that share an id count as one with the greatest of their texts; a null
    id is no document; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    length, limit = chunks * width, (errors + 1) * chunks - 1
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where("doc is not null")
    sketched = "doc long, n long, c1 long, c2 long, sig binary"
    sketch = saved(rows.mapInArrow(_sketch("doc", "text", shingle, length), sketched), "dup-sketch")
    if not sketch.groupBy("doc").count().where("count > 1").isEmpty():
        rows = saved(rows.groupBy("doc").agg(F.max("text").alias("text")), "dup-texts")
        sketch = saved(rows.mapInArrow(_sketch("doc", "text", shingle, length), sketched), "dup-sketch")
    one = sketch.select("doc", "n", "c1", "c2")
    first = saved(one.where("n > 0").groupBy("c1", "c2", "n").agg(F.min("doc").alias("rep")), "dup-classes")
    reps = saved(sketch.join(first.select(F.col("rep").alias("doc")), "doc", "left_semi").select("doc", "n", "sig"), "dup-reps")

    keys = reps.select("doc", "sig").mapInArrow(_index_keys(chunks, width, errors), "key long, doc long")
    hub = keys.groupBy("key").agg(F.min("doc").alias("hub"), F.max("doc").alias("top")).where("hub < top").select("key", "hub")
    met = saved(keys.join(hub, "key"), "dup-keys")  # only keys with two members or more
    pairs = met.where("doc > hub").select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct()
    links = saved(confirmed(_by_signature(pairs, reps, limit), rows, shingle, percent), "dup-links")
    comp = saved(components(links), "dup-comp")

    # keys whose members are still in different components
    part = met.join(comp, F.col("doc") == F.col("id"), "left").select("key", "hub", "doc", F.coalesce("comp", "doc").alias("comp"))
    split = part.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    part = saved(part.join(split, "key"), "dup-open")
    open_docs = saved(part.select("doc", "comp").distinct().join(reps.select("doc", "n"), "doc"), "dup-left")
    held = saved(_exploded_sets(rows, open_docs.select("doc"), shingle), "dup-held")
    seen = held.groupBy("s").agg(F.count("*").alias("c"), F.min("doc").alias("doc")).where(f"c <= {int(rare)}")
    seen = saved(seen, "dup-rare")
    lone = seen.where("c = 1").groupBy("doc").agg(F.count("*").alias("lone"))
    posts = saved(held.join(seen.where("c > 1").select("s"), "s"), "dup-posts")
    few = posts.groupBy("doc").agg(F.count("*").alias("few"))
    zero = F.lit(0).cast("long")
    able = (open_docs.join(lone, "doc", "left").join(few, "doc", "left")
            .select("doc", "comp", "n", (F.col("n") - F.coalesce("lone", zero)).alias("shared"), F.coalesce("few", zero).alias("few"))
            .where(f"100 * shared >= {int(percent)} * n").select("doc", "comp", "n", (F.col("shared") - F.col("few")).alias("often")))
    able = saved(able, "dup-able")

    def reach(least):
        return 100 * least >= percent * (F.col("x_n") + F.col("y_n") - least)

    def meet(df: DataFrame, by: str) -> DataFrame:
        x, y = (df.select(by, *[F.col(c).alias(f"{p}_{c}") for c in ("doc", "comp", "n", "often")]) for p in "xy")
        return x.join(y, by).where((F.col("x_doc") < F.col("y_doc")) & (F.col("x_comp") != F.col("y_comp")))

    # without a rare shingle in common only the frequent ones can be shared
    # (two documents under one key are both under its hub: fewer repeats of a pair than key by key)
    own = part.select("hub", "doc").distinct().join(able, "doc").where(f"100 * often >= {int(percent)} * n")
    common = meet(own, "hub").where(reach(F.least("x_often", "y_often"))).select("x_doc", "y_doc")
    rarely = (meet(posts.join(able, "doc"), "s").groupBy("x_doc", "y_doc", "x_n", "y_n", "x_often", "y_often").agg(F.count("*").alias("r"))
              .where(reach(F.least("x_often", "y_often") + F.col("r"))).select("x_doc", "y_doc"))
    more = common.unionByName(rarely).select(F.col("x_doc").alias("a"), F.col("y_doc").alias("b")).distinct()
    more = more.join(pairs, ["a", "b"], "left_anti")
    links2 = saved(confirmed(_by_signature(more, reps, limit), rows, shingle, percent), "dup-links")
    both = links.unionByName(links2) if not links2.isEmpty() else None
    comp = comp if both is None else saved(components(both), "dup-comp")

    of_class = first.join(comp, F.col("rep") == F.col("id"), "left").select("c1", "c2", "n", F.coalesce("comp", "rep").alias("comp"))
    return one.join(of_class, ["c1", "c2", "n"], "left").select("doc", "n", F.coalesce("comp", "doc").alias("comp"))


def _exploded_sets(rows: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    return (_texts_of(rows, docs).mapInArrow(_sets("doc", "text", n), "doc long, s array<long>")
            .select("doc", F.explode("s").alias("s")))


def _by_signature(pairs: DataFrame, reps: DataFrame, limit: int) -> DataFrame:
    a = reps.select(F.col("doc").alias("a"), F.col("sig").alias("sa"))
    b = reps.select(F.col("doc").alias("b"), F.col("sig").alias("sb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(_near(limit), "a long, b long")
