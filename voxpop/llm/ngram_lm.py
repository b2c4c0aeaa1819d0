"""Language-model scoring with a log-frequency Bloom filter.

Unigram and bigram counts of the training documents are quantised to levels
(powers of two).  An n-gram of level L is inserted with levels 1..L, so probing
level after level until the first miss reads its level back.  The filter is a
set of sub-filters by hash prefix, as many as the insertions need, each sized to
its n-grams and built in parallel.  A level stands for the mean count of its
n-grams, and

    P(w | v) = weight * min(1, c(v w) / c(v)) + (1 - weight) * (c(w) + 1) / (N + V + 1).

Bounds: the filter holds ``bits`` bits for each inserted (n-gram, level), of every
n-gram of the training rows.  At most about ``max_bits`` of it (and at least one
sub-filter) are broadcast at a time: a larger filter is probed group by group of
sub-filters, one pass over the texts each, and the levels of the passes are added
(an n-gram has its level in one group and 0 in all others).  So no count is
dropped; more n-grams cost more passes.  The exact counts of the most
frequent words (at most ``max_head``) are broadcast too; all other words meet
their exact counts in a join, so the base score is exact for any vocabulary.

Words are known by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxpop.llm.textkit import U, mix, moved, saved, slices, small_batches, word_hashes

EVEN = U(0xFFFFFFFFFFFFFFFE)
END, START = U(0x1F123BB5159A55E4), U(0x8B72E5A1D0C94C76)
PROBES = 4


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes (even) of all rows, each row closed by the end token, and tokens per row."""
    h, n = word_hashes(col)
    return np.insert(h & EVEN, np.cumsum(n), END), n + 1


def bigrams(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hashes (odd) of each token with the one before it."""
    prev = np.empty_like(h)
    prev[1:] = h[:-1]
    prev[np.cumsum(n) - n] = START
    return mix(prev * U(0x9E3779B97F4A7C15) + h) | U(1)


def _count(text: str, most: int):
    schema = pa.schema([("h", pa.int64()), ("n", pa.int32()), ("docs", pa.int64()), ("total", pa.int64())])

    def flush(kept, docs, total):
        for k in (0, 1):
            u, c = np.unique(np.concatenate([x[k] for x in kept]), return_counts=True)
            for i in range(0, len(u), 1 << 17):
                m = len(u[i:i + (1 << 17)])
                d, t = np.zeros(m, np.int64), np.zeros(m, np.int64)
                if i == 0 and k == 0:
                    d[0], t[0] = docs, total
                yield pa.RecordBatch.from_arrays([pa.array(u[i:i + m].view(np.int64)), pa.array(c[i:i + m].astype(np.int32)), pa.array(d), pa.array(t)], schema=schema)

    def part(batches):
        kept, docs, total = [], 0, 0
        for batch in batches:
            for x in slices(batch, text):
                h, n = tokens(x.column(text))
                kept.append((h, bigrams(h, n)))
                docs, total = docs + len(n), total + len(h)
                if total >= most:
                    yield from flush(kept, docs, total)
                    kept, docs, total = [], 0, 0
        if kept:
            yield from flush(kept, docs, total)

    return part


def _level(n: np.ndarray) -> np.ndarray:
    """1 + floor(log2) of the count."""
    return np.frexp(n.astype(np.float64))[1]


def _positions(h: np.ndarray, level: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    g = mix(h + level * U(0xA24BAED5))
    a, b = g >> U(32), (g & U(0xFFFFFFFF)) | U(1)
    return [(((a + U(i) * b) & U(0xFFFFFFFF)) * size) >> U(32) for i in range(PROBES)]


def _sub_filter(bits: int):
    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf["h"].to_numpy().view(U)
        lv = _level(pdf["n"].to_numpy())
        size = max(64, int(lv.sum()) * bits)
        out = np.zeros((size + 7) // 8, np.uint8)
        rep = np.repeat(h, lv)
        first = np.repeat(np.cumsum(lv) - lv, lv)
        for p in _positions(rep, (np.arange(len(rep)) - first + 1).astype(U), U(size)):
            np.bitwise_or.at(out, (p >> U(3)).astype(np.int64), np.left_shift(1, (p & U(7)).astype(np.uint8)).astype(np.uint8))
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "size": [size], "bits": [out.tobytes()]})
    return group


class LogFrequencyFilter:
    """Broadcast sub-filters of 2^``shard_bits``: ``levels`` probes an array of tagged
    hashes; an n-gram of a sub-filter that is not among them has level 0."""

    def __init__(self, parts: list[tuple[int, int, bytes]], shard_bits: int):
        n = 1 << shard_bits
        self.shard_bits = shard_bits
        self.size = np.zeros(n, U)
        self.base = np.zeros(n, U)
        at = 0
        for shard, size, raw in parts:
            self.size[shard], self.base[shard] = size, at
            at += 8 * len(raw)
        self.bits = np.frombuffer(b"".join(raw for _, _, raw in parts), np.uint8)

    def levels(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.int8)
        shard = (h >> U(64 - self.shard_bits)).astype(np.int64) if self.shard_bits else np.zeros(len(h), np.int64)
        size, base = self.size[shard], self.base[shard]
        live = np.flatnonzero(size)
        level = 0
        while len(live):
            level += 1
            at = _positions(h[live], np.full(1, level, U), size[live])
            hit = np.ones(len(live), bool)
            for p in at:
                p = (p[hit] + base[live[hit]]).astype(np.int64)
                hit[hit] = (self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
            live = live[hit]
            out[live] = level
        return out


def _log_p(word: np.ndarray, pair: np.ndarray, first: np.ndarray, m: dict, weight: float) -> np.ndarray:
    """Score of each row from the levels of its words and bigrams; ``first`` is where the rows begin."""
    cw = m["word"][word]
    prev = np.empty_like(cw)
    prev[1:] = cw[:-1]
    prev[first] = m["docs"]
    p = (1 - weight) * (cw + 1) / (m["total"] + m["vocab"] + 1) + weight * np.minimum(1.0, m["pair"][pair] / np.maximum(prev, 1.0))
    return np.add.reduceat(np.log10(p), first)


def _level_rows(word: np.ndarray, pair: np.ndarray, n: np.ndarray) -> pa.Array:
    """One binary value a row: the levels of its words, then those of its bigrams."""
    both, end = np.empty(2 * len(word), np.uint8), np.cumsum(n)
    at = np.arange(len(word)) + np.repeat(end - n, n)
    both[at], both[at + np.repeat(n, n)] = word, pair
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, 2 * end).astype(np.int32)), pa.py_buffer(both)])


def _levels(text: str, row: str, model):
    """One more pass: the levels that the model's group of sub-filters holds."""
    schema = pa.schema([(row, pa.int64()), ("levels", pa.binary())])

    def part(batches):
        filt = model.value["filter"]
        for batch in batches:
            for x in slices(batch, text):
                h, n = tokens(x.column(text))
                u, inv = np.unique(h, return_inverse=True)
                yield pa.RecordBatch.from_arrays([x.column(row), _level_rows(filt.levels(u)[inv], filt.levels(bigrams(h, n)), n)], schema=schema)

    return part


def _added(row: str, model: dict, weight: float):
    """Score of each row from the levels of all passes (a list of binary values)."""
    schema = pa.schema([(row, pa.int64()), ("score", pa.float64())])

    def part(batches):
        for batch in batches:
            score = []
            for values in batch.column("levels"):
                lv = np.sum([np.frombuffer(v.as_buffer(), np.uint8) for v in values.values], axis=0, dtype=np.int64)
                word, pair = lv.reshape(2, -1)
                score.append(_log_p(word, pair, np.zeros(1, np.int64), model, weight)[0])
            yield pa.RecordBatch.from_arrays([batch.column(row), pa.array(score, pa.float64())], schema=schema)

    return part


def _score(text: str, row: str, model, weight: float):
    """The first pass: exact base sums, and the score (``whole``: one group holds
    the filter) or the levels of the first group."""
    schema = pa.schema([(row, pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
                        ("tail", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())), ("levels", pa.binary())])

    def part(batches):
        m = model.value
        head, counts, filt = m["head"], m["counts"], m["filter"]
        logs = np.log10(counts + 1.0)
        for batch in batches:
            for x in slices(batch, text):
                h, n = tokens(x.column(text))
                first = np.cumsum(n) - n
                u, inv = np.unique(h, return_inverse=True)
                if len(head):
                    at = np.minimum(np.searchsorted(head, u), len(head) - 1)
                    in_head = head[at] == u
                else:
                    at, in_head = np.zeros(len(u), np.int64), np.zeros(len(u), bool)
                known = np.add.reduceat(in_head[inv].astype(np.int64), first)
                base = np.add.reduceat(np.where(in_head, logs[at] if len(head) else 0.0, 0.0)[inv], first)
                # the model: levels of the distinct words, then of every bigram
                word, pair = filt.levels(u)[inv], filt.levels(bigrams(h, n))
                if m["whole"]:
                    score, levels = pa.array(_log_p(word, pair, first, m, weight)), pa.nulls(len(n), pa.binary())
                else:
                    score, levels = pa.nulls(len(n), pa.float64()), _level_rows(word, pair, n)
                # words beyond the head: distinct for each row, with how often
                rest = np.flatnonzero(~in_head[inv])
                key = np.unique(np.repeat(np.arange(len(n)), n)[rest].astype(np.int64) * len(u) + inv[rest], return_counts=True)
                rows, words = key[0] // max(1, len(u)), key[0] % max(1, len(u))
                cut = pa.array(np.searchsorted(rows, np.arange(len(n) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    x.column(row), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base), score,
                    pa.ListArray.from_arrays(cut, pa.array(u[words].view(np.int64))), pa.ListArray.from_arrays(cut, pa.array(key[1].astype(np.int32))),
                    levels], schema=schema)

    return part


def _inserted(of: dict[int, tuple[int, int]]) -> int:
    return sum(lv * k for lv, (k, _) in of.items())


def _fitting(stats: list, kind: int, first: int, room: int) -> tuple[dict[int, tuple[int, int]], int]:
    """Of one kind of n-gram: level -> (how many, their total count), from the least
    count 2^first on whose insertions fit ``room``; and that ``first``."""
    while True:
        of = {r["lv"] - first + 1: (r["k"], r["n"]) for r in stats if r["bigram"] == kind and r["lv"] >= first}
        if not of or _inserted(of) <= room:
            return of, first
        first += 1


RESULT = ("__n_tokens", "__n_known", "__train_tokens", "__base", "__score")


def score_texts(docs: DataFrame, train: Column, text: str = "text", weight: float = 0.4, bits: int = 8, max_bits: int = 1 << 30,
                max_head: int = 1 << 20, most: int = 4_000_000, per_shard: int = 1 << 16) -> DataFrame:
    """``docs`` (without ``text``) with ``__n_tokens``, ``__n_known``, ``__train_tokens``,
    ``__base`` and ``__score``.  ``train`` is a condition over ``docs``: the rows to
    learn from.  ``max_bits`` bounds the sub-filters broadcast at a time, ``per_shard``
    is about the insertions of a sub-filter; neither changes which counts are kept.

    A null or empty text is the end token alone; without training rows every
    count is 0; repeated rows count and are scored each; an empty table gives
    an empty one.  Other columns pass through; one called like a result column
    gets underscores behind its name.
    """
    small_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    counted = docs.where(train).select(text).mapInArrow(_count(text, most), "h long, n int, docs long, total long")
    grams = saved(counted.groupBy("h").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.sum("total").alias("total")), "lm-grams")
    bigram = F.col("h").bitwiseAND(1).alias("bigram")
    level = (F.length(F.bin("n")) - 1).alias("lv")  # floor(log2): at most 64 rows for each kind
    stats = grams.groupBy(bigram, level).agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.sum("total").alias("total")).collect()
    total, vocab, n_docs = (sum(r[c] for r in stats if r["bigram"] == 0) for c in ("total", "k", "docs"))
    words, pairs = (_fitting(stats, kind, 0, math.inf)[0] for kind in (0, 1))  # every level of both kinds
    inserted = _inserted(words) + _inserted(pairs)
    shard_bits = max(0, math.ceil(math.log2(max(1, inserted / per_shard))))
    groups = max(1, min(1 << shard_bits, -(-inserted * bits // max_bits)))
    shard = F.shiftrightunsigned("h", 64 - shard_bits).cast("int") if shard_bits else F.lit(0)
    parts = grams.select(shard.alias("shard"), "h", "n").groupBy("shard").applyInPandas(_sub_filter(bits), "shard int, size long, bits binary")
    if groups > 1:
        parts = saved(parts, "lm-filter")

    def group(g: int) -> LogFrequencyFilter:
        of_g = parts.where(F.shiftright(F.col("shard").cast("long") * groups, shard_bits) == g) if groups > 1 else parts
        return LogFrequencyFilter([tuple(r) for r in of_g.collect()], shard_bits)  # about max_bits / 8 bytes

    low = 0  # the least level whose words fit the head
    while sum(r["k"] for r in stats if r["bigram"] == 0 and r["lv"] >= low) > max_head:
        low += 1
    # at most max_head rows
    head = grams.where(f"h & 1 = 0 and n >= {1 << low}").select("h", "n").toArrow()
    h = head["h"].to_numpy().view(U)
    order = np.argsort(h)

    def means(of: dict) -> np.ndarray:
        out = np.zeros(129)
        for lv in range(1, 129):
            out[lv] = of[lv][1] / of[lv][0] if lv in of else out[lv - 1] * 2
        return out

    means_of = {"word": means(words), "pair": means(pairs), "docs": float(n_docs), "total": total, "vocab": vocab}
    model = sc.broadcast({"head": h[order], "counts": head["n"].to_numpy()[order], "filter": group(0), "whole": groups == 1, **means_of})
    away = moved(docs.columns, [*RESULT, "__row", "__known", "__tail", "__times", "__levels", "tk", "tb"])
    passed = [F.col(f"`{away.get(c, c)}`").alias(away[c] if c.lower() in RESULT and c in away else c) for c in docs.columns if c != text]
    docs, text = docs.withColumnsRenamed(away), away.get(text, text)
    keep = [c for c in docs.columns if c != text]
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    if groups > 1:
        numbered = saved(numbered, "lm-texts")  # every pass sees the same row numbers
    # one scan keeps the row numbers and the scores together
    scored = saved(_with_scores(numbered, text, keep, model, weight), "lm-scores")
    if groups > 1:
        model.unpersist()
        levels = scored.select("__row", F.col("__levels").alias("levels"))
        for g in range(1, groups):
            model = sc.broadcast({"filter": group(g)})
            levels = levels.unionByName(saved(numbered.select("__row", text).mapInArrow(_levels(text, "__row", model), "__row long, levels binary"), "lm-levels"))
            model.unpersist()
        added = (levels.groupBy("__row").agg(F.collect_list("levels").alias("levels"))
                 .mapInArrow(_added("__row", means_of, weight), "__row long, __score double"))
        scored = scored.drop("__score", "__levels").join(added, "__row")
    tail = (scored.select("__row", F.explode(F.arrays_zip("__tail", "__times")).alias("t")).select("__row", F.col("t.__tail").alias("h"), F.col("t.__times").alias("k"))
            .join(grams.where("h & 1 = 0").select("h", "n"), "h")
            .groupBy("__row").agg(F.sum("k").alias("tk"), F.sum(F.col("k") * F.log10(F.col("n") + 1.0)).alias("tb")))
    norm = math.log10(total + vocab + 1)
    return (scored.join(tail, "__row", "left")
            .select(*passed, F.col("__n_tokens"), (F.col("__known") + F.coalesce("tk", F.lit(0))).alias("__n_known"), F.lit(total).cast("long").alias("__train_tokens"),
                    (F.col("__base") + F.coalesce("tb", F.lit(0.0)) - F.col("__n_tokens") * norm).alias("__base"), "__score"))


def _with_scores(numbered: DataFrame, text: str, keep: list[str], model, weight: float) -> DataFrame:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    new = [("__n_tokens", T.LongType()), ("__known", T.LongType()), ("__base", T.DoubleType()), ("__score", T.DoubleType()),
           ("__tail", T.ArrayType(T.LongType())), ("__times", T.ArrayType(T.IntegerType())), ("__levels", T.BinaryType())]
    schema = T.StructType([f for f in numbered.schema.fields if f.name in keep or f.name == "__row"] + [T.StructField(*x) for x in new])
    arrow = to_arrow_schema(schema)
    inner = _score(text, "__row", model, weight)

    def part(batches):
        for batch in batches:
            names = [f for f in arrow.names if f not in dict(new)]
            at = 0
            for out in inner([batch]):
                cols = [batch.column(c).slice(at, out.num_rows) for c in names] + out.columns[1:]
                at += out.num_rows
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return numbered.mapInArrow(part, schema)
