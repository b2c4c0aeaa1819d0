"""Line dedup with a once-seen and a twice-seen Bloom filter.

Pass 1 hashes the distinct keys of every document's lines; every task keeps a
once-seen filter and sends its set bits.  A bit sent for two documents (or by
two tasks) enters the twice-seen filter.  Pass 2 probes every line against the
twice-seen filter, and only the suspected repeats - true repeats plus the
filter's few false positives - are shuffled as (128-bit hash, doc_id) for the
exact confirmation and the choice of the first holder.  A full filter costs
more shuffled suspects, never a wrong result.

Size: ``bits_per_line`` bits for each line, at most ``max_bits`` (the
broadcast's proven bound, 128 MB by default).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxpop.llm.textkit import NOT_SPACE, U, apart, free, hasher, mix, saved, slices, small_batches, text_buffer

MIN_CHARS = 10
PROBES = 2


def line_keys(col: pa.Array, min_chars: int):
    """Of every line of every row: its row, and its key's two hashes where the
    stripped line has ``min_chars`` code points (``ok``)."""
    buf, off = text_buffer(col)
    nl = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate([off[:-1], nl + 1]), kind="stable")
    ends = np.sort(np.concatenate([nl, off[1:]]), kind="stable")
    rows = np.repeat(np.arange(len(off) - 1), 1 + np.diff(np.searchsorted(nl, off)))
    solid = np.flatnonzero(NOT_SPACE[buf])
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    ok = b > a
    s, e = solid[a[ok]], solid[b[ok] - 1] + 1
    long = chars[e] - chars[s] >= min_chars
    ok[ok] = long
    s, e = s[long], e[long]
    return rows, ok, hasher(1).spans(buf, s, e), hasher(2).spans(buf, s, e)


def positions(h: np.ndarray) -> list[np.ndarray]:
    """32-bit filter positions of each probe; a smaller filter takes their high bits."""
    return [mix(h + U((i + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> U(32) for i in range(PROBES)]


def _marks(text: str, min_chars: int):
    schema = pa.schema([("pos", pa.int64()), ("n", pa.int32()), ("lines", pa.int64())])

    def part(batches):
        kept, lines = [], 0
        for batch in batches:
            for x in slices(batch, text):
                rows, ok, h, _ = line_keys(x.column(text), min_chars)
                lines += len(h)
                r = rows[ok]
                order = np.lexsort((h, r))
                r, h = r[order], h[order]
                new = np.ones(len(h), bool)
                new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
                kept.append(h[new])  # once for each row
        if not kept:
            return
        u, c = np.unique(np.concatenate(kept), return_counts=True)
        pos = np.concatenate(positions(u)).astype(np.int64)
        n = np.minimum(np.concatenate([c] * PROBES), 2).astype(np.int32)
        order = np.argsort(pos, kind="stable")
        pos, n = pos[order], n[order]
        size = np.zeros(len(pos), np.int64)
        if len(size):
            size[0] = lines
        for i in range(0, len(pos), 1 << 16):
            j = i + (1 << 16)
            yield pa.RecordBatch.from_arrays([pa.array(pos[i:j]), pa.array(n[i:j]), pa.array(size[i:j])], schema=schema)

    return part


def twice_seen(docs: DataFrame, text: str, min_chars: int, bits_per_line: int, max_bits: int) -> tuple[np.ndarray, int]:
    """The twice-seen filter (packed bits, at most ``max_bits``) and its log2 size."""
    marks = saved(docs.select(text).mapInArrow(_marks(text, min_chars), "pos long, n int, lines long"), "line-marks")
    lines = marks.agg(F.sum("lines")).first()[0] or 0
    log2 = max(16, min(int(np.log2(max_bits)), int(np.ceil(np.log2(max(1, lines * bits_per_line))))))
    bit = F.shiftrightunsigned("pos", 32 - log2)
    twice = marks.groupBy(bit.alias("bit")).agg(F.sum("n").alias("n")).where("n >= 2")
    maps = (twice.groupBy(F.expr("bitmap_bucket_number(bit + 1)").alias("bucket"))  # the functions count from 1
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))").alias("bits")))
    out = np.zeros(1 << (log2 - 3), np.uint8)
    for r in maps.collect():  # max_bits / 8 bytes in all
        at = (r["bucket"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(r["bits"], np.uint8)[:len(out) - at]
    return out, log2


def _suspects(doc_id: str, text: str, min_chars: int, filt, log2: int):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64())])

    def part(batches):
        bits = filt.value
        for batch in batches:
            for x in slices(batch, text):
                rows, ok, h1, h2 = line_keys(x.column(text), min_chars)
                hit = np.ones(len(h1), bool)
                for p in positions(h1):
                    p = (p >> U(32 - log2)).astype(np.int64)
                    hit &= (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
                if hit.any():
                    ids = x.column(doc_id).take(pa.array(rows[ok][hit]))
                    yield pa.RecordBatch.from_arrays([pa.array(h1[hit].view(np.int64)), pa.array(h2[hit].view(np.int64)), ids], schema=schema)

    return part


def _rebuild(text: str, drop: str, min_chars: int, schema: pa.Schema):
    def part(batches):
        for batch in batches:
            for x in slices(batch, text):
                drops = x.column(drop)
                texts = x.column(text).to_pylist()
                n_lines = [1 if t is None else t.count("\n") + 1 for t in texts]
                n_dropped = [0] * len(texts)
                some = np.flatnonzero(np.asarray(drops.is_valid()))
                if len(some):
                    rows, ok, h1, _ = line_keys(x.column(text).take(pa.array(some)), min_chars)
                    gone = np.zeros(len(rows), bool)
                    own = rows[ok]
                    dead = np.zeros(len(h1), bool)
                    first = np.searchsorted(own, np.arange(len(some) + 1))
                    for k, i in enumerate(some):
                        a, b = first[k], first[k + 1]
                        dead[a:b] = np.isin(h1[a:b].view(np.int64), np.array(drops[int(i)].as_py(), np.int64))
                    gone[ok] = dead
                    first = np.searchsorted(rows, np.arange(len(some) + 1))
                    for k, i in enumerate(some):
                        g = gone[first[k]:first[k + 1]]
                        n_dropped[i] = int(g.sum())
                        texts[i] = "\n".join(t for t, d in zip(texts[i].split("\n"), g) if not d)
                cols = [pa.array(texts, pa.string()) if f == text else x.column(f) for f in x.schema.names if f != drop]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], schema)], schema=schema)

    return part


RESULT = ("__n_lines", "__n_dropped")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                bits_per_line: int = 16, max_bits: int = 1 << 30) -> DataFrame:
    """``docs`` with every repeated line removed outside the smallest ``doc_id``
    that holds it, plus ``__n_lines`` (before) and ``__n_dropped``.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased;
    only keys of at least ``min_chars`` code points count.  Null text stays null
    and has one empty line; a row with a null id takes no part and keeps all its
    lines; rows that share an id are one document; an empty table gives an
    empty one.  Other columns pass through; one called like a result column gets
    underscores behind its name.
    """
    docs = apart(docs, *RESULT)
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    take = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.col(text).alias("__text")).where("__doc is not null")
    bits, log2 = twice_seen(take, "__text", min_chars, bits_per_line, max_bits)
    filt = spark.sparkContext.broadcast(bits)
    suspects = saved(take.mapInArrow(_suspects("__doc", "__text", min_chars, filt, log2), "h1 long, h2 long, doc long"), "line-suspects")
    repeats = saved(suspects.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                    .where("first < last").select("h1", "h2", "first"), "line-repeats")
    own, drop = free("__doc", docs), free("__drops", docs)
    drops = (suspects.join(repeats, ["h1", "h2"]).where("doc > first")
             .groupBy(F.col("doc").alias(own)).agg(F.collect_set("h1").alias(drop)))
    joined = docs.withColumn(own, F.col(doc_id).cast("long")).join(drops, own, "left").drop(own)
    schema = T.StructType([*docs.schema.fields, T.StructField("__n_lines", T.LongType()), T.StructField("__n_dropped", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    return joined.mapInArrow(_rebuild(text, drop, min_chars, to_arrow_schema(schema)), schema)


def sha256_hex(s: str | None) -> str:
    return hashlib.sha256((s or "").encode()).hexdigest()
