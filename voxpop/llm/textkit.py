"""Vectorised text helpers shared by the operators: Arrow text columns as byte
buffers, hashes of words and lines without a Python object per word, and shared
intermediate tables.

A span's hash is a polynomial over a random table of byte values, read off one
prefix sum (``(S[end] - S[start]) * p^-start``) and mixed with the span's
length; 64 bits per hash, two independent hashes where 128 are wanted.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.session import checkpoint_root

U = np.uint64
SPACE = bytes([0x20, 9, 10, 11, 12, 13])
PIECE = 1 << 18  # bytes hashed at a time


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = _lower_table()


def byte_mask(separators: bytes) -> np.ndarray:
    m = np.ones(256, dtype=bool)
    m[list(separators)] = False
    return m


NOT_SPACE = byte_mask(SPACE)
# letters, digits and every byte of a non-ASCII character, after lower-casing
ALNUM = np.array([(48 <= b < 58) or (65 <= b < 91) or (97 <= b < 123) or b >= 128 for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (wrap-around arithmetic)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class SpanHasher:
    """Hashes of byte spans after lower-casing A-Z; ``seed`` picks the function."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        table = rng.integers(1, 1 << 63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
        self.table = table[LOWER]
        self.p = int(rng.integers(1, 1 << 60)) * 8 + 5
        self.inv = pow(self.p, -1, 1 << 64)
        self.pow = np.empty(0, U)
        self.ipow = np.empty(0, U)

    def _powers(self, n: int) -> None:
        if len(self.pow) < n:
            out = []
            for base in (self.p, self.inv):
                a = np.full(n, U(base & ((1 << 64) - 1)), U)
                a[0] = U(1)
                out.append(np.multiply.accumulate(a))
            self.pow, self.ipow = out

    def spans(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each span; spans are disjoint and in order."""
        out = np.empty(len(starts), U)
        i = 0
        while i < len(starts):
            base = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, base + PIECE, side="right")))
            n = int(ends[j - 1]) - base
            self._powers(max(min(PIECE, len(buf)), n) + 1)
            cs = np.empty(n + 1, U)
            cs[0] = 0
            np.cumsum(self.table[buf[base:base + n]] * self.pow[:n], out=cs[1:])
            s, e = starts[i:j] - base, ends[i:j] - base
            out[i:j] = mix((cs[e] - cs[s]) * self.ipow[s] + (e - s).astype(U) * U(0x9E3779B97F4A7C15))
            i = j
        return out


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the row offsets of a string column; null counts as empty."""
    col = col.fill_null("") if col.null_count else col
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def word_spans(buf: np.ndarray, off: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of ``in_word`` bytes inside one row)
    and the words per row."""
    w = in_word[buf]
    if len(w) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(off) - 1, np.int64)
    s = w.copy()
    s[1:] &= ~w[:-1]
    inner = off[:-1][off[:-1] < len(buf)]
    s[inner] = w[inner]
    e = np.empty(len(w) + 1, bool)  # e[i]: a word ends before byte i
    e[0] = False
    e[1:] = w
    e[1:-1] &= ~w[1:]
    cut = off[1:]
    cut = cut[cut > 0]
    e[cut] = w[cut - 1]
    starts, ends = np.flatnonzero(s), np.flatnonzero(e)
    return starts, ends, np.diff(np.searchsorted(starts, off))


_HASHERS: dict[int, SpanHasher] = {}


def hasher(seed: int = 1) -> SpanHasher:
    if seed not in _HASHERS:
        _HASHERS[seed] = SpanHasher(seed)
    return _HASHERS[seed]


def word_hashes(col: pa.Array, in_word: np.ndarray = NOT_SPACE, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a text column, and the words per row."""
    buf, off = text_buffer(col)
    starts, ends, n = word_spans(buf, off, in_word)
    return hasher(seed).spans(buf, starts, ends), n


def slices(batch: pa.RecordBatch, text: str = "text", max_bytes: int = 2 << 20):
    """The batch in row slices of about ``max_bytes`` of text (at least one row)."""
    buf, off = text_buffer(batch.column(text))
    del buf
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, df: DataFrame) -> str:
    """``name``, with underscores behind it until ``df`` has no such column."""
    while name.lower() in [c.lower() for c in df.columns]:
        name += "_"
    return name


def moved(columns: list[str], names: Iterable[str]) -> dict[str, str]:
    """New names, with underscores behind, for the ``columns`` called like one of
    ``names`` (in any case): an operator's own columns take those."""
    own = {n.lower() for n in names}
    taken = own | {c.lower() for c in columns}
    out = {}
    for c in columns:
        if c.lower() in own:
            new = c + "_"
            while new.lower() in taken:
                new += "_"
            taken.add(new.lower())
            out[c] = new
    return out


def apart(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the columns that clash with ``names`` renamed (see ``moved``)."""
    return df.withColumnsRenamed(moved(df.columns, names))


def restored(df: DataFrame, columns: list[str], *names: str) -> DataFrame:
    """The inverse of ``apart`` once the operator's own columns are gone."""
    return df.withColumnsRenamed({new: c for c, new in moved(columns, names).items()})


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts travel to Python in Arrow batches of ``rows`` rows: the default
    of 10,000 holds tens of megabytes several times over in each task.  A session
    that has set another size keeps it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it
    back: later steps and retries after a lost executor start from there."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(doc_id: str, mod: int):
    """crc32 of the id as text, modulo ``mod`` (a null id: of the empty text)."""
    return (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % mod).cast("int")
