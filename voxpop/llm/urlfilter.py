"""URL filter: a bit-parallel wildcard automaton (Shift-And).

All glob rules are packed into one bit vector of 64-bit words, a bit for each
pattern character.  A step reads one byte of every URL of a batch at once:
shift the state left, let in the first bits, keep the bits whose character
fits, and keep the bits that sit in front of a wildcard.  So all patterns run
over all URLs with a few array operations a byte.

Patterns: ``*`` any run without ``/``, ``**`` any run, other characters stand
for themselves; a pattern fits a whole canonical URL (host + path).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U = np.uint64


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains, from a path prefix on."""
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        return [f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"]


# FIXED VALUES: the host and path rules, then the words that the method's own
# globs look for in a host label.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
BAD_WORDS = ("adult", "casino", "pills", "bets", "spam", "porn", "xxx", "viagra", "payday", "torrent")
GLOBS = tuple(f"*{w}*" for w in BAD_WORDS) + tuple(f"*{w}*/**" for w in BAD_WORDS)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + F.lit(3))
    has = F.coalesce(at > 0, F.lit(False))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.when(has, host).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


class ShiftAnd:
    """The packed patterns; ``match`` gives one boolean row per text."""

    def __init__(self, patterns: list[str]):
        self.chars: list[int] = []    # byte that each bit stands for
        stars: dict[int, str] = {}    # bit -> kind of wildcard behind it
        first, self.last = [], []
        for pat in patterns:
            first.append(len(self.chars))
            self.chars.append(-1)     # a start bit, set before the first byte
            raw = pat.encode()
            i = 0
            while i < len(raw):
                if raw[i:i + 1] == b"*":
                    wide = raw[i:i + 2] == b"**"
                    bit = len(self.chars) - 1
                    stars[bit] = "**" if wide or stars.get(bit) == "**" else "*"
                    i += 2 if wide else 1
                else:
                    self.chars.append(raw[i])
                    i += 1
            self.last.append(len(self.chars) - 1)
        self.words = (len(self.chars) + 63) // 64
        self.start = self._bits(first)
        self.fits = np.zeros((256, self.words), U)
        self.stays = np.zeros((256, self.words), U)
        for c in range(256):
            self.fits[c] = self._bits([i for i, x in enumerate(self.chars) if x == c])
            self.stays[c] = self._bits([i for i, k in stars.items() if k == "**" or c != ord("/")])

    def _bits(self, at: list[int]) -> np.ndarray:
        out = np.zeros(self.words, U)
        for i in at:
            out[i // 64] |= U(1) << U(i % 64)
        return out

    def match(self, texts: list[bytes]) -> np.ndarray:
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lens = np.array([len(texts[i]) for i in order], np.int64)
        flat = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
        begin = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
        state = np.tile(self.start, (len(texts), 1))
        live = len(texts)
        for k in range(int(lens[0]) if len(lens) else 0):
            live = int(np.searchsorted(-lens[:live], -k, side="left"))  # texts longer than k bytes
            c = flat[begin[:live] + k]
            d = state[:live]
            up = d << U(1)
            up[:, 1:] |= d[:, :-1] >> U(63)
            state[:live] = (up & self.fits[c]) | (d & self.stays[c])
        out = np.zeros((len(texts), len(self.last)), bool)
        for p, bit in enumerate(self.last):
            out[order, p] = (state[:, bit // 64] >> U(bit % 64)) & U(1) == 1
        return out


def _judge(rules: tuple[Rule, ...], globs: tuple[str, ...], otherwise: str):
    patterns = [g for r in rules for g in r.globs()] + list(globs)
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("globs", pa.list_(pa.string()))])
    # the longest rule wins; equal length: the first listed
    rank = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))

    def part(batches):
        machine = ShiftAnd(patterns)
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            hit = machine.match([(h + p).encode() for h, p in zip(hosts, paths)])
            rule, verdict, which = [], [], []
            for row in hit:
                r = next((i for i in rank if row[2 * i] or row[2 * i + 1]), None)
                own = [g for g, x in zip(globs, row[2 * len(rules):]) if x]
                rule.append(None if r is None else rules[r].name)
                verdict.append(rules[r].verdict if r is not None else "block" if own else otherwise)
                which.append(own)
            yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(which, pa.list_(pa.string()))], schema=schema)

    return part


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES,
               globs: tuple[str, ...] = GLOBS, otherwise: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (the longest that fits, else null),
    ``verdict`` (the rule's; else block where a glob fits, else ``otherwise``)
    and ``globs`` (those that fit).

    One row per row of ``pages``, repeated rows included; a null URL or one
    without ``://`` has an empty host and path, fits no rule and gets
    ``otherwise``; an empty table gives an empty one.
    """
    host, path = host_path(F.col(url))
    return (pages.select(F.col(page_id).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
            .mapInArrow(_judge(rules, globs, otherwise), "page_id long, host string, path string, rule string, verdict string, globs array<string>"))
