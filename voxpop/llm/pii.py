"""Personal data: base patterns and a skip-chain conditional random field.

Nodes are the tokens (runs without white space) that hold a digit or ``@``; all
other tokens are outside by definition.  A node's potential is a multinomial
logistic model of its shape.  Neighbouring nodes share a chain potential, and
every token shares a skip potential with the last earlier one of equal core
(outer punctuation and case aside) or equal digits, however far apart.  Loopy
max-normalised sum-product messages give each token's marginals; a confident
token outside the base spans adds a span.

The base spans of all documents are the training labels.  Shapes are bit sets,
so training needs only the counts of (shape, label) and of label pairs on the
two kinds of edges; those counts are sums over every document.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxpop.llm.textkit import apart, slices, small_batches

KINDS = ("email", "ip", "card", "phone")
N = len(KINDS) + 1  # label 0: outside
# FIXED VALUES: the base patterns, written so that they never backtrack
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

HOT = re.compile(r"[0-9@]")
BLANK = re.compile(r"[\x20\x09-\x0D]")
GAP = re.compile(r"[\x20\x09-\x0D]+")
OUTER = "!\"#$%&'()*,./:;<=>?[\\]^_`{|}~"
NUMERIC = re.compile(r"\+?[0-9().-]+")
BITS = 16


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order of start, then kind."""
    out = []
    end, at = 0, t.find("@")
    while at >= 0:
        m = DOMAIN.match(t, at)
        if m:
            a = at
            while a > end and t[a - 1] in LOCAL:
                a -= 1
            if a < at:
                end = m.end()
                out.append((a, 0, end))
        at = t.find("@", max(at + 1, end))
    for m in DOTTED.finditer(t):
        parts = m.group().split(".")
        a = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            b = a + sum(map(len, four)) + 3
            if all(map(_byte, four)):
                out.append((a, 1, b))
            a = b + 1
    for m in CARD.finditer(t):
        if m.end() - m.start() >= 14:
            d = only_digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in t:
        for m in PHONE.finditer(t):
            if 10 <= len(only_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def tokens(t: str) -> list[tuple[int, int]]:
    """Bounds of the tokens that hold a digit or ``@``."""
    out, end = [], 0
    m = HOT.search(t)
    while m:
        a = m.start()
        while a > end and not BLANK.match(t, a - 1):
            a -= 1
        stop = BLANK.search(t, m.end())
        end = stop.start() if stop else len(t)
        out.append((a, end))
        m = HOT.search(t, end)
    return out


class Graph:
    """One document's nodes, shapes and edges."""

    def __init__(self, t: str):
        self.spans = base_spans(t)
        self.tokens = tokens(t)
        self.cores = [(t[a:b]).strip(OUTER).lower() for a, b in self.tokens]
        n = len(self.tokens)
        self.labels = np.zeros(n, np.int64)
        k = 0
        starts = [a for a, _ in self.tokens]
        for a, kind, b in self.spans:
            k = max(0, int(np.searchsorted(starts, a, side="right")) - 1)
            while k < n and self.tokens[k][0] < b:
                if self.tokens[k][1] > a and not self.labels[k]:
                    self.labels[k] = kind + 1
                k += 1
        # a gap of white space only makes two nodes neighbours
        self.chain = [(i, i + 1) for i in range(n - 1) if self.tokens[i + 1][0] - self.tokens[i][1] <= 64
                      and GAP.fullmatch(t, self.tokens[i][1], self.tokens[i + 1][0])]
        self.skip = []
        last: dict[str, int] = {}
        for i, core in enumerate(self.cores):
            digits = only_digits(core)
            for key in {core, "#" + digits if len(digits) >= 6 else ""} - {""}:
                if key in last and last[key] < i:
                    self.skip.append((last[key], i))
                last[key] = i
        self.skip = sorted(set(self.skip))
        self.shapes = self._shapes(t)

    def _shapes(self, t: str) -> np.ndarray:
        n = len(self.tokens)
        numeric = [bool(NUMERIC.fullmatch(t[a:b].strip(OUTER.replace("(", "").replace(")", "")) or "x")) for a, b in self.tokens]
        own = [only_digits(c) for c in self.cores]
        card = [numeric[i] and "." not in self.cores[i] and 14 <= len(own[i]) <= 19 and luhn(own[i]) for i in range(n)]
        four = [numeric[i] and c.count(".") == 3 and all(p.isdigit() and _byte(p) for p in c.split(".")) for i, c in enumerate(self.cores)]
        joined = set(self.chain)
        group, begin = np.zeros(n, np.int64), 0
        for i in range(n):  # neighbouring numeric tokens; a "+", a card or an address begins anew
            alone = card[i] or four[i] or t[self.tokens[i][0]] == "+" or (i and (card[i - 1] or four[i - 1]))
            if alone or not (i and numeric[i] and numeric[i - 1] and (i - 1, i) in joined):
                begin = i
            group[i] = begin
        digits: dict[int, str] = {}
        for i in range(n):
            digits[group[i]] = digits.get(group[i], "") + own[i]
        out = np.zeros(n, np.int64)
        for i, core in enumerate(self.cores):
            g = digits[group[i]]
            at = core.find("@")
            bits = (at >= 0, at > 0 and "." in core[at:], bool(at > 0 and DOMAIN.fullmatch(core, at) and set(core[:at]) <= LOCAL),
                    core.count(".") == 3 and numeric[i], four[i], t[self.tokens[group[i]][0]] == "+", numeric[i], card[i], len(own[i]) >= 7, len(own[i]) >= 14,
                    t[self.tokens[group[i]][0]] == "+" and 10 <= len(g) <= 15, 14 <= len(g) <= 19 and luhn(g), len(g) > 19,
                    any(c.isalpha() for c in core), "-" in core or "(" in core, len(g) >= 10)
            out[i] = sum(1 << k for k, x in enumerate(bits) if x)
        return out


def _counts(text: str):
    schema = pa.schema([("what", pa.int32()), ("x", pa.int64()), ("y", pa.int32()), ("n", pa.int64())])

    def part(batches):
        total: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for x in slices(batch, text):
                for t in x.column(text).to_pylist():
                    if not t or not HOT.search(t):
                        continue
                    g = Graph(t)
                    lab = g.labels.tolist()
                    for s, y in zip(g.shapes.tolist(), lab):
                        total[0, s, y] = total.get((0, s, y), 0) + 1
                    for what, edges in ((1, g.chain), (2, g.skip)):
                        for i, j in edges:
                            total[what, lab[i], lab[j]] = total.get((what, lab[i], lab[j]), 0) + 1
        rows = list(total.items())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.int32()), pa.array([k[1] for k, _ in rows], pa.int64()),
                                          pa.array([k[2] for k, _ in rows], pa.int32()), pa.array([n for _, n in rows], pa.int64())], schema=schema)
    return part


def _vector(shapes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(shapes), 1)), (shapes[:, None] >> np.arange(BITS)) & 1], axis=1)


class Model:
    """Node weights by regularised logistic regression, edge potentials as the
    smoothed log ratio of label pairs to independence."""

    def __init__(self, rows: list[tuple[int, int, int, int]], ridge: float = 1e-4, steps: int = 2000):
        node = [(x, y, n) for what, x, y, n in rows if what == 0]
        shapes = sorted({x for x, _, _ in node})
        count = np.zeros((len(shapes), N))
        where = {s: i for i, s in enumerate(shapes)}
        for x, y, n in node:
            count[where[x], y] += n
        x = _vector(np.array(shapes, np.int64))
        self.w = np.zeros((BITS + 1, N))
        weight = count / max(1.0, count.sum())
        step = np.zeros_like(self.w)
        for _ in range(steps if len(shapes) else 0):  # gradient steps with momentum; the sums are over shapes, not tokens
            z = x @ self.w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            step = 0.9 * step - 0.5 * (x.T @ (weight.sum(axis=1, keepdims=True) * p - weight) + ridge * self.w)
            self.w += step
        self.edges = []
        for what in (1, 2):
            c = 0.5 + 4.5 * np.eye(N) * (what == 2)  # prior: equal tokens agree
            for k, a, b, n in rows:
                if k == what:
                    c[a, b] += n / 2
                    c[b, a] += n / 2
            c /= c.sum()
            self.edges.append(np.clip(np.log(c / np.outer(c.sum(axis=1), c.sum(axis=0))), -4, 4))

    def marginals(self, g: Graph, rounds: int = 12, damp: float = 0.3) -> np.ndarray:
        z = _vector(g.shapes) @ self.w
        node = z - np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) - z.max(axis=1, keepdims=True)
        pairs = [(i, j, k) for k, edges in enumerate((g.chain, g.skip)) for i, j in edges]
        belief = node
        if pairs:
            e = np.array([(i, j, k) for i, j, k in pairs] + [(j, i, k) for i, j, k in pairs])
            src, dst, pot = e[:, 0], e[:, 1], np.stack(self.edges)[e[:, 2]]
            back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
            msg = np.zeros((len(e), N))
            for _ in range(rounds):
                belief = node.copy()
                np.add.at(belief, dst, msg)
                x = (belief[src] - msg[back])[:, :, None] + pot
                top = x.max(axis=1)
                new = top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                msg = damp * msg + (1 - damp) * new
            belief = node.copy()
            np.add.at(belief, dst, msg)
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def added_spans(t: str, g: Graph, p: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """Runs of neighbouring confident tokens of one kind outside every base span."""
    free = np.ones(len(g.tokens), bool)
    for i, (a, b) in enumerate(g.tokens):
        free[i] = not g.labels[i]
    label = np.where(free & (p.max(axis=1) >= least), p.argmax(axis=1), 0)
    joined = set(g.chain)
    out: list[list[int]] = []
    for i, y in enumerate(label.tolist()):
        if not y:
            continue
        a, b = g.tokens[i]
        core = t[a:b]
        a += len(core) - len(core.lstrip(OUTER))
        b -= len(core) - len(core.rstrip(OUTER))
        if a >= b:
            continue
        if out and out[-1][1] == y - 1 and (i - 1, i) in joined and out[-1][3] == i - 1:
            out[-1][2], out[-1][3] = b, i
        else:
            out.append([a, y - 1, b, i])
    return [(a, k, b) for a, k, b, _ in out]


def _tag(text: str, model, least: float, schema: pa.Schema):
    def part(batches):
        m = model.value
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
        for batch in batches:
            for x in slices(batch, text):
                base, extra = [], []
                for t in x.column(text).to_pylist():
                    b, e = [], []
                    if t and HOT.search(t):
                        g = Graph(t)
                        b = g.spans
                        e = added_spans(t, g, m.marginals(g), least)
                    for spans, to in ((b, base), (e, extra)):
                        to.append([{"start": s, "kind": KINDS[k], "end": z} for s, k, z in spans])
                cols = [*x.columns, pa.array(base, kind), pa.array(extra, kind)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)
    return part


def find_pii(docs: DataFrame, text: str = "text", least: float = 0.8) -> DataFrame:
    """``docs`` with ``__base`` and ``__added``: arrays of (start, kind, end) in code
    points, end exclusive, by start and kind.  ``least``: the marginal from which a
    token outside the base spans is added.

    A null or empty text has no spans; repeated rows are tagged each; an empty
    table gives an empty one and a model without added spans.  Other columns
    pass through; one called like a result column gets underscores behind its name.
    """
    docs = apart(docs, "__base", "__added")
    small_batches(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    counts = (docs.select(text).mapInArrow(_counts(text), "what int, x long, y int, n long")
              .groupBy("what", "x", "y").agg(F.sum("n").alias("n")).collect())  # at most 2^16 shapes by 5 labels
    model = docs.sparkSession.sparkContext.broadcast(Model(sorted(tuple(r) for r in counts)))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("__base", span), T.StructField("__added", span)])
    return docs.mapInArrow(_tag(text, model, least, to_arrow_schema(schema)), schema)
