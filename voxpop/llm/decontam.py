"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items (word ids) form one automaton; every document streams
through it, and the length of the longest match that ends at each word tells
which words lie inside a test window.  A window is ``window`` consecutive item
words, or a whole shorter item.

The automaton is broadcast and holds at most ``max_words`` item words (a
documented bound, about 100 bytes a word); more items make more automata, which
one pass over the documents applies one after the other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxpop.llm.textkit import ALNUM, apart, hasher, restored, slices, small_batches, text_buffer, word_hashes, word_spans

WINDOW = 10


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of ints, with the items whose
    windows each state stands for."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        """``items``: (id, word hashes), none of them empty."""
        self.window = window
        self.vocab = np.unique(np.concatenate([w for _, w in items])) if items else np.empty(0, np.uint64)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(k, np.searchsorted(self.vocab, w).tolist()) for k, w in items]
        for _, seq in coded:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.least = min([window, *(len(s) for _, s in coded)]) if coded else window
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for k, seq in coded:
            v = n = 0
            for c in seq:
                v, n = self.next[v][c], n + 1
                if n >= window:
                    self.items.setdefault(self._cut(v, window), set()).add(k)
            if n < window:
                self.short.setdefault(self._cut(v, n), {}).setdefault(n, set()).add(k)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last] and length[nxt[last][c]] == length[last] + 1:
            return nxt[last][c]
        made = -1
        if c not in nxt[last]:
            made = self._state({}, length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = made
            p = link[p]
        if p < 0:
            link[made] = 0
            return made
        q = nxt[p][c]
        if length[q] == length[p] + 1:
            link[made] = q
            return made
        twin = self._state(dict(nxt[q]), length[p] + 1)
        link[twin] = link[q]
        link[q] = twin
        if made >= 0:
            link[made] = twin
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = twin
            p = link[p]
        return made if made >= 0 else twin

    def _state(self, edges: dict[int, int], length: int) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _cut(self, v: int, n: int) -> int:
        """The state of the last ``n`` words of a match at ``v``."""
        while self.link[v] >= 0 and self.length[self.link[v]] >= n:
            v = self.link[v]
        return v

    def scan(self, ids: list[int], base: int, hits: list[tuple[int, int]], found: set[str]) -> None:
        """Stream known word ids; adds the hit ranges of words and the items."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        v = n = 0
        for i, c in enumerate(ids):
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v, n = nxt[v][c], n + 1
            if n >= window:
                hits.append((base + i + 1 - window, base + i + 1))
                found |= self.items[self._cut(v, window)]
            if self.short:
                u = v
                while u > 0:
                    for m, ks in self.short.get(u, {}).items():
                        if m <= n:
                            hits.append((base + i + 1 - m, base + i + 1))
                            found |= ks
                    u = link[u]

    def read(self, words: np.ndarray, hits: list[tuple[int, int]], found: set[str]) -> None:
        """One document's word hashes: only runs of known words that a window fits in are streamed."""
        if not len(self.vocab) or len(words) < self.least:
            return
        at = np.searchsorted(self.vocab, words)
        known = self.vocab[np.minimum(at, len(self.vocab) - 1)] == words
        edge = np.flatnonzero(np.diff(np.concatenate([[0], known.view(np.int8), [0]])))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if e - s >= self.least:
                self.scan(at[s:e].tolist(), s, hits, found)


def shards(items: DataFrame, item_id: str, text: str, max_words: int) -> list[list[tuple[str, np.ndarray]]]:
    """Items in lists of at most ``max_words`` words (or one larger item)."""
    out, room = [], 0
    rows = items.select(F.col(item_id).cast("string"), F.col(text)).where(F.col(text).isNotNull())
    for k, t in rows.toLocalIterator(prefetchPartitions=True):  # one partition at a time on the driver
        words, _ = word_hashes(pa.array([t]), ALNUM)
        if len(words):
            if not out or room < len(words):
                out.append([])
                room = max_words
            out[-1].append((k if k is not None else "", words))
            room -= len(words)
    return out


def union_runs(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    runs: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    return runs


def _match(text: str, autos: list, schema: pa.Schema):
    def part(batches):
        for batch in batches:
            for x in slices(batch, text):
                buf, off = text_buffer(x.column(text))
                starts, ends, counts = word_spans(buf, off, ALNUM)
                words = hasher(1).spans(buf, starts, ends)
                first = np.concatenate([[0], np.cumsum(counts)])
                n_hit, spans, items = [], [], []
                for i in range(x.num_rows):
                    a, b = first[i], first[i + 1]
                    hits: list[tuple[int, int]] = []
                    found: set[str] = set()
                    for auto in autos:
                        auto.value.read(words[a:b], hits, found)
                    runs = union_runs(hits)
                    n_hit.append(sum(e - s for s, e in runs))
                    spans.append([[int(starts[a + s] - off[i]), int(ends[a + e - 1] - off[i])] for s, e in runs])
                    items.append(sorted(found))
                new = [pa.array(counts, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*x.columns, *new], schema)], schema=schema)

    return part


RESULT = ("__n_words", "__n_hit", "__spans", "__items")


def match_items(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                item_text: str = "text", window: int = WINDOW, max_words: int = 2_000_000) -> DataFrame:
    """``docs`` with ``__n_words``, ``__n_hit`` (words inside an item's window),
    ``__spans`` (byte ranges of the hit runs) and ``__items`` (ids, as strings).

    A null text has no words; an item without words fits nothing; an item with a
    null id counts under the empty id; repeated items are one; empty tables are
    allowed on both sides.  Other columns pass through; one called like a result
    column gets underscores behind its name.
    """
    docs = apart(docs, *RESULT)
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    autos = [spark.sparkContext.broadcast(SuffixAutomaton(x, window)) for x in shards(items, item_id, item_text, max_words)]
    schema = T.StructType([*docs.schema.fields, T.StructField("__n_words", T.LongType()), T.StructField("__n_hit", T.LongType()),
                           T.StructField("__spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("__items", T.ArrayType(T.StringType()))])
    from pyspark.sql.pandas.types import to_arrow_schema
    return docs.mapInArrow(_match(text, autos, to_arrow_schema(schema)), schema)


def _remove(text: str, schema: pa.Schema):
    def part(batches):
        for batch in batches:
            out = []
            for t, spans in zip(batch.column(text).to_pylist(), batch.column("__spans").to_pylist()):
                if spans:
                    raw, at, left = t.encode(), 0, []
                    for a, b in spans:
                        left.append(raw[at:a])
                        at = b
                    t = b"".join([*left, raw[at:]]).decode()
                out.append(t)
            cols = [pa.array(out, pa.string()) if f.name == text else batch.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)

    return part


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, max_coverage: float = 0.5, max_words: int = 2_000_000) -> DataFrame:
    """``docs`` without the text of hit runs; documents with more than
    ``max_coverage`` of their words hit go altogether.  Same columns as ``docs``, whatever their names."""
    hit = match_items(docs, items, text, item_id, item_text, window, max_words)
    hit = hit.where(F.col("__n_hit") <= max_coverage * F.col("__n_words"))
    from pyspark.sql.pandas.types import to_arrow_schema
    kept = apart(docs, *RESULT).schema
    return restored(hit.mapInArrow(_remove(text, to_arrow_schema(kept)), kept), docs.columns, *RESULT)


def ids_digest(ids: list[str] | None) -> str:
    return hashlib.sha256(",".join(sorted(ids or [])).encode()).hexdigest()
