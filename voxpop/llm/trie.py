"""Prefix trie of conversations from adaptive radix trees.

A turn's id is the 16-byte md5 of its role and text; a conversation's key is its
turn ids, big-endian and end to end.  Equal keys are one entry with a count and
a smallest conversation.  The entries are cut into shards by ranges of the key
(a hot first turn, or any hot prefix, is cut further down); each shard is built
into an adaptive radix tree by one task, whose nodes grow from 4 to 16, 48 and
256 children and keep single paths compressed.  Only byte depths that are
multiples of an id's width give trie nodes, also inside a compressed path.

A prefix that crosses shards is counted in each of them.  All measures of a node
are sums over shards once two facts are known, which the neighbouring shards'
outermost keys tell: whether an earlier shard holds the prefix too (then that
one counts the node), and whether the next shard goes on behind a last key (then
it is no leaf).  Texts never reach the trees: an entry is 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxpop.llm.textkit import saved

WIDTH = 16
GROUP, SHARED = 20, 4
SHARD_BYTES = 4 << 20  # of keys in one tree
CHUNK = 1 << 14  # conversation ids listed in one row
TOKEN = r"[^\x20\x09-\x0D]+"


class Inner:
    """A radix-tree node: compressed ``path``, ``entry`` of a key that ends behind
    it, and children by byte in a layout for 4, 16, 48 or 256 of them."""

    __slots__ = ("path", "entry", "size", "index", "kids")

    def __init__(self, path: bytes, entry: int | None = None):
        self.path, self.entry, self.size, self.index, self.kids = path, entry, 4, bytearray(), []

    def get(self, byte: int):
        if self.size == 256:
            return self.kids[byte]
        if self.size == 48:
            return self.kids[self.index[byte] - 1] if self.index[byte] else None
        at = self.index.find(byte)
        return None if at < 0 else self.kids[at]

    def put(self, byte: int, kid: Inner) -> None:
        if self.size == 256:
            self.kids[byte] = kid
        elif self.size == 48:
            if not self.index[byte]:
                if len(self.kids) == 48:
                    self._grow()
                    return self.put(byte, kid)
                self.kids.append(kid)
                self.index[byte] = len(self.kids)
            else:
                self.kids[self.index[byte] - 1] = kid
        else:
            at = self.index.find(byte)
            if at >= 0:
                self.kids[at] = kid
            elif len(self.kids) == self.size:
                self._grow()
                self.put(byte, kid)
            else:
                self.index.append(byte)
                self.kids.append(kid)

    def _grow(self) -> None:
        held = self.items()
        self.size = {4: 16, 16: 48, 48: 256}[self.size]
        if self.size >= 48:
            self.index, self.kids = bytearray(256), [None] * 256 if self.size == 256 else []
            for byte, kid in held:
                self.put(byte, kid)

    def items(self) -> list[tuple[int, Inner]]:
        if self.size == 256:
            return [(b, k) for b, k in enumerate(self.kids) if k is not None]
        if self.size == 48:
            return [(b, self.kids[i - 1]) for b, i in enumerate(self.index) if i]
        return sorted(zip(self.index, self.kids), key=lambda x: x[0])


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def insert(root: Inner, key: bytes, entry: int) -> None:
    """Add a key (distinct from those already there)."""
    node, at = root, 0
    while True:
        # the root's path is empty, every other path begins with the byte it hangs under
        n = shared(node.path, key[at:at + len(node.path)])
        if n < len(node.path):  # split the path
            below = Inner(node.path[n:], node.entry)
            below.size, below.index, below.kids = node.size, node.index, node.kids
            node.path, node.entry, node.size, node.index, node.kids = node.path[:n], None, 4, bytearray(), []
            node.put(below.path[0], below)
        at += n
        if at == len(key):
            node.entry = entry
            return
        kid = node.get(key[at])
        if kid is None:
            node.put(key[at], Inner(key[at:], entry))
            return
        node = kid


def walk(root: Inner, keys: list[bytes], n: np.ndarray, least: np.ndarray, tokens: list, before: int, goes_on: int | None, width: int) -> Iterator[tuple]:
    """The trie nodes of one tree: (node, parent, depth, conv_id, n_convs, n_children, n_leaves, saved).

    ``before``: turns that the first key shares with an earlier shard;
    ``goes_on``: the entry whose key is continued by a later shard.  A node that
    an earlier shard holds is counted there: here it adds its members only.
    """
    empty = hashlib.md5()
    first = min(range(len(keys)), key=keys.__getitem__)

    def trail(node: Inner, start: int, state):
        """Aligned depths in (start, start + len(path)] with their ids, and the state behind them."""
        out, end = [], start + len(node.path)
        for d in range(start // width + 1, end // width + 1):
            # the id's bytes before ``start`` were taken by the nodes above
            state = state.copy()
            state.update(node.path[max(0, (d - 1) * width - start):d * width - start])
            out.append((d, state))
        rest = state.copy()
        rest.update(node.path[max(0, end // width * width - start):] if end % width else b"")
        return out, rest

    def under(node: Inner, start: int, state, parent: bytes):
        """Post-order without recursion on depth: (members, least, leaves, saved, nodes at the top, an entry)."""
        stack, done = [[node, start, state, parent, None, None, []]], None
        while stack:
            frame = stack[-1]
            top, at, st, par, marks, todo, got = frame
            if todo is None:
                marks, rest = trail(top, at, st)
                if at == 0 and top is root:  # the textless root
                    marks = [(0, empty), *marks]
                end = marks[-1][1].digest() if marks else par
                frame[4] = marks
                frame[5] = todo = [(kid, at + len(top.path), rest, end) for _, kid in reversed(top.items())]
            if done is not None:
                got.append(done)
                done = None
            if todo:
                kid, kid_at, kid_state, kid_parent = todo.pop()
                stack.append([kid, kid_at, kid_state, kid_parent, None, None, []])
                continue
            members = sum(g[0] for g in got)
            low = min((g[1] for g in got), default=None)
            leaves, kept, owned = (sum(g[i] for g in got) for i in (2, 3, 4))
            entry = got[0][5] if got else top.entry
            has_first = any(g[6] for g in got) or top.entry == first
            if top.entry is not None:
                members += int(n[top.entry])
                low = int(least[top.entry]) if low is None else min(low, int(least[top.entry]))
                leaves += not got and top.entry != goes_on
            for i in range(len(marks) - 1, -1, -1):
                d, at_d = marks[i]
                old = has_first and d <= before
                words = int(tokens[entry][d - 1]) if d else 0
                kept += members * words - (0 if old else words)
                above = marks[i - 1][1].digest() if i else par
                yield at_d.digest(), (above if d else None), d, low, members, owned, leaves, kept
                owned = int(not old)
            stack.pop()
            done = (members, low, leaves, kept, owned, entry, has_first)

    yield from under(root, 0, empty, empty.digest())


NODES = "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _tree(width: int):
    def shard(table: pa.Table) -> pa.Table:
        keys, n, least, tokens = (table.column(c) for c in ("key", "n", "conv_id", "tokens"))
        keys, tokens = keys.to_pylist(), [t.values.to_numpy() for t in tokens.combine_chunks()]
        root = Inner(b"")
        for i, key in enumerate(keys):
            insert(root, key, i)
        low, high = min(keys), max(range(len(keys)), key=keys.__getitem__)
        last, following = table.column("last")[0].as_py(), table.column("next")[0].as_py()
        before = -1 if last is None else shared(last, low) // width
        goes_on = high if following is not None and following.startswith(keys[high]) else None
        rows = list(walk(root, keys, n.to_numpy(), least.to_numpy(), tokens, before, goes_on, width))
        names = [c.split()[0] for c in NODES.split(", ")]
        types = [pa.binary(), pa.binary(), *[pa.int64()] * 6]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    return shard


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of each node's listed ids, in order, one chunk at a time."""
    node, state = None, None
    for batch in batches:
        out = []
        for at, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if at == node:
                state.update(b",")
            else:
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256()
            state.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out])], ["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])


def rebuilt(turns: DataFrame, group: int = GROUP, shared_turns: int = SHARED, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turns`` (array of ``id``, ``words``) of every conversation c:
    the first h turns of conversation c - c % ``group`` and then its own behind
    its first h, with h = crc32(c) % ``shared_turns``."""
    full = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    said = turns.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), full(role).alias("role"), full(text).alias("text"))
    at = ["conv_id", "turn", "role"]
    tied = saved(said.groupBy(*at).count().where("count > 1").select(*[F.col(c).alias(f"t_{c}") for c in at]), "trie-tied")
    tie = F.lit(None).cast("string")
    if not tied.isEmpty():  # their texts alone travel, to be put in order
        same = F.col("conv_id").eqNullSafe(F.col("t_conv_id")) & F.col("turn").eqNullSafe(F.col("t_turn")) & F.col("role").eqNullSafe(F.col("t_role"))
        said = said.join(tied, same, "left")
        tie = F.when(F.col("t_conv_id").isNotNull(), F.col("text"))
    said = said.select("conv_id", "turn", "role", tie.alias("tie"), F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("id"),
                       F.size(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))).alias("words"))
    own = said.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "tie", "id", "words"))).alias("own"))
    own = saved(own.select("conv_id", F.transform("own", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("own")), "trie-convs")
    heads = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, max(1, shared_turns - 1)).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % shared_turns).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(heads, "base", "left").withColumn("h", h)
    none = F.slice("own", 1, 0)
    return both.select("conv_id", F.concat(F.coalesce(F.expr("slice(head, 1, h)"), none), F.expr("slice(own, h + 1, size(own))")).alias("turns"))


def trie_nodes(convs: DataFrame, shard_bytes: int = SHARD_BYTES, width: int = WIDTH) -> DataFrame:
    """One row a trie node of ``convs`` (``conv_id``, ``turns``): ``node``, ``parent``
    (16-byte ids of the prefixes), ``depth``, ``conv_id`` (smallest member),
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``.

    Rows that repeat a conversation count as further members; an empty table has
    no nodes, a table of turnless conversations a root only.
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key")
    rows = saved(convs.select("conv_id", key, F.transform("turns", lambda t: t["words"]).alias("tokens")), "trie-rebuilt")
    entries = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.max("tokens").alias("tokens"))
    size = rows.agg(F.sum(F.length("key") + 64)).first()[0] or 0
    parts = max(1, -(-size // shard_bytes))
    cut = saved(entries.repartitionByRange(parts, "key").withColumn("shard", F.spark_partition_id()), "trie-entries")
    order = Window.orderBy("shard")  # one row a shard
    edges = cut.groupBy("shard").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    edges = edges.select("shard", F.lag("high").over(order).alias("last"), F.lead("low").over(order).alias("next"))
    shards = cut.join(edges.withColumnRenamed("shard", "s"), F.col("shard") == F.col("s")).drop("s").repartition(parts, "shard")
    part = shards.groupBy("shard").applyInArrow(_tree(width), NODES)
    total = (part.groupBy("node").agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
                                      *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]))
    total = saved(total, "trie-nodes")
    listed = (rows.select(F.unhex(F.md5("key")).alias("node"), "conv_id").groupBy("node", F.expr(f"conv_id div {CHUNK}").alias("chunk"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))
    ends = listed.repartition("node").sortWithinPartitions("node", "chunk").select("node", "ids").mapInArrow(_ends, "node binary, ends_sha256 string")
    above = total.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (total.join(above, "parent", "left").join(ends, "node", "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))))


def conversation_trie(turns: DataFrame, group: int = GROUP, shared_turns: int = SHARED, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns`` (see ``trie_nodes``).

    Turns are ordered by ``turn`` (null first), equal ones by role and then by text; a null role or text counts as empty; repeated rows are turns one
    by one; rows with a null conversation id are no conversation; an empty table
    gives an empty result.  Other columns are not read.
    """
    return trie_nodes(rebuilt(turns, group, shared_turns, conv_id, turn, role, text), shard_bytes)


def layout_counts(keys: Iterable[bytes]) -> dict[int, int]:
    """Nodes of each layout in the tree of ``keys`` (distinct)."""
    root, out = Inner(b""), {4: 0, 16: 0, 48: 0, 256: 0}
    for i, key in enumerate(keys):
        insert(root, key, i)
    todo = [root]
    while todo:
        node = todo.pop()
        out[node.size] += 1
        todo += [k for _, k in node.items()]
    return out
