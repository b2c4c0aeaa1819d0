"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
The probability of a word is the sum over all its segmentations into pieces
(forward algorithm); a text's is the product over its words.  Piece
probabilities are learned by expectation-maximisation: the forward-backward
algorithm counts each piece by its share of a word's segmentations.

Words are runs of letters of any length, lower-cased, with the vocabulary's word
mark in front.  Short ones are summed many at a time, those of more than
``SHORT`` letters one by one in logarithms: the same sum without underflow.
Learned from about ``sample`` training rows (a documented bound), chosen by a hash
of the id, with as equal a share for each language as its rows allow; every text
is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxpop.llm.textkit import saved, slices, small_batches

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
WORD = re.compile(r"[^\W\d_]+")
SHORT = 30
UNKNOWN = 1e-7
NONE = "und"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def pieces_of(path: str) -> list[str]:
    """The vocabulary's ordinary pieces (no control or byte pieces)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return sorted({sp.id_to_piece(i) for i in range(sp.get_piece_size())
                   if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))})


class Segments:
    """Where pieces occur in words."""

    def __init__(self, pieces: list[str]):
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.starts = {p[:k] for p in pieces for k in range(1, len(p) + 1)}
        self.n = len(pieces)

    def hits(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Columns (word, from, to, piece) of every occurrence, and the words' lengths."""
        ids, starts, unknown = self.ids.get, self.starts, self.n
        out, size = [], []
        for k, w in enumerate(words):
            s = MARK + w
            n = len(s)
            size.append(n)
            for i in range(n):
                j = i + 1
                piece = ids(s[i], unknown)
                out.append((k, i, j, piece))
                while j < n:
                    j += 1
                    sub = s[i:j]
                    if sub not in starts:
                        break
                    piece = ids(sub)
                    if piece is not None:
                        out.append((k, i, j, piece))
        return np.array(out, np.int32).reshape(-1, 4).T, np.array(size, np.int32)


    def at(self, s: str, i: int) -> list[tuple[int, int]]:
        """(end, piece) of every piece of ``s`` that starts at ``i``."""
        out, j = [(i + 1, self.ids.get(s[i], self.n))], i + 1
        while j < len(s):
            j += 1
            sub = s[i:j]
            if sub not in self.starts:
                break
            if sub in self.ids:
                out.append((j, self.ids[sub]))
        return out


def long_forward(seg: Segments, word: str, logs: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of every prefix of a word of any length: [length, language]."""
    s = MARK + word
    alpha = np.full((len(s) + 1, logs.shape[1]), -np.inf)
    alpha[0] = 0
    for i in range(len(s)):
        for j, piece in seg.at(s, i):
            alpha[j] = np.logaddexp(alpha[j], alpha[i] + logs[piece])
    return alpha


def long_expected(seg: Segments, word: str, logs: np.ndarray, times: np.ndarray) -> dict[int, np.ndarray]:
    """Expected counts by piece of a word of any length that occurs ``times`` [language]."""
    s = MARK + word
    alpha, beta = long_forward(seg, word, logs), np.full((len(s) + 1, logs.shape[1]), -np.inf)
    beta[-1] = 0
    out: dict[int, np.ndarray] = {}
    for i in range(len(s) - 1, -1, -1):
        for j, piece in seg.at(s, i):
            after = logs[piece] + beta[j]
            beta[i] = np.logaddexp(beta[i], after)
            out[piece] = out.get(piece, 0) + np.exp(alpha[i] + after - alpha[-1]) * times
    return out


def log_totals(seg: Segments, words: list[str], prob: np.ndarray, chunk: int = 10_000) -> np.ndarray:
    """Logarithm of each word's probability, summed over all segmentations: [word, language]."""
    out = np.zeros((len(words), prob.shape[1]))
    short = [k for k, w in enumerate(words) if len(w) <= SHORT]
    for i in range(0, len(short), chunk):
        at = short[i:i + chunk]
        hits, size = seg.hits([words[k] for k in at])
        out[at] = np.log(forward(hits, size, prob)[np.arange(len(at)), size])
    logs = np.log(prob)
    for k, w in enumerate(words):
        if len(w) > SHORT:
            out[k] = long_forward(seg, w, logs)[-1]
    return out


def forward(hits: np.ndarray, size: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Probability of every prefix: [word, length, language]."""
    word, a, b, piece = hits
    alpha = np.zeros((len(size), int(size.max(initial=0)) + 1, prob.shape[1]))
    alpha[:, 0] = 1
    order = np.argsort(b, kind="stable")
    cut = np.searchsorted(b[order], np.arange(alpha.shape[1] + 1))
    for j in range(1, alpha.shape[1]):
        x = order[cut[j]:cut[j + 1]]
        np.add.at(alpha[:, j], word[x], alpha[word[x], a[x]] * prob[piece[x]])
    return alpha


def expected(hits: np.ndarray, size: np.ndarray, prob: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Expected piece counts [piece, language]; ``times`` [word, language]."""
    word, a, b, piece = hits
    alpha = forward(hits, size, prob)
    beta = np.zeros_like(alpha)
    beta[np.arange(len(size)), size] = 1
    order = np.argsort(a, kind="stable")
    cut = np.searchsorted(a[order], np.arange(alpha.shape[1] + 1))
    for i in range(alpha.shape[1] - 1, -1, -1):
        x = order[cut[i]:cut[i + 1]]
        np.add.at(beta[:, i], word[x], prob[piece[x]] * beta[word[x], b[x]])
    total = alpha[np.arange(len(size)), size]
    share = alpha[word, a] * prob[piece] * beta[word, b] * (times / total)[word]
    out = np.zeros_like(prob)
    np.add.at(out, piece, share)
    return out


def _word_counts(text: str, lang: str):
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def part(batches):
        for batch in batches:
            for x in slices(batch, text):
                counts: dict[str, Counter] = {}
                for c, t in zip(x.column(lang).to_pylist(), x.column(text).to_pylist()):
                    counts.setdefault(c, Counter()).update(words_of(t))
                for c, own in counts.items():
                    yield pa.RecordBatch.from_arrays([pa.array([c] * len(own), pa.string()), pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())], schema=schema)
    return part


def _expect(model, langs: list[str], chunk: int = 10_000):
    schema = pa.schema([("piece", pa.int64()), ("lang", pa.int64()), ("c", pa.float64())])

    def part(batches):
        pieces, prob = model.value
        seg = Segments(pieces)
        total, logs = np.zeros_like(prob), np.log(prob)
        for batch in batches:
            for i in range(0, batch.num_rows, chunk):
                x = batch.slice(i, chunk)
                words = x.column("word").to_pylist()
                times = np.zeros((x.num_rows, len(langs)))
                times[np.arange(x.num_rows), [langs.index(c) for c in x.column("lang").to_pylist()]] = x.column("n").to_numpy()
                short = np.array([len(w) <= SHORT for w in words], bool)
                if short.any():
                    hits, size = seg.hits([w for w, ok in zip(words, short) if ok])
                    total += expected(hits, size, prob, times[short])
                for k in np.flatnonzero(~short):
                    for piece, c in long_expected(seg, words[k], logs, times[k]).items():
                        total[piece] += c
        p, c = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(c), pa.array(total[p, c])], schema=schema)
    return part


def quotas(rows: dict[str, int], sample: int) -> dict[str, int]:
    """Rows of each language to learn from: equal parts of ``sample``; what a
    language doesn't have goes to the others."""
    out, left = {}, sample
    for k, c in enumerate(sorted(rows, key=lambda c: (rows[c], c))):
        out[c] = min(rows[c], left // (len(rows) - k))
        left -= out[c]
    return out


def fit(train: DataFrame, doc_id: str, text: str, lang: str, vocabulary: str, sample: int, rounds: int) -> dict:
    """Languages, pieces, their probabilities [piece, language] and the languages' shares."""
    spark = train.sparkSession
    pieces = pieces_of(vocabulary)
    train = train.where(F.col(lang).isNotNull()).select(F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(lang).alias("c"))
    by = {r["c"]: r["count"] for r in train.groupBy("c").count().collect()}
    langs = sorted(by)
    n = sum(by.values())
    part = {c: (q << 30) // by[c] for c, q in quotas(by, sample).items()}
    limit = F.create_map(*[F.lit(x) for c, p in part.items() for x in (c, p)])[F.col("c")] if part else F.lit(0)
    some = train.where(F.pmod(F.xxhash64("i"), F.lit(1 << 30)) < limit)
    counts = saved(some.mapInArrow(_word_counts("t", "c"), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang-words")
    prob = np.full((len(pieces) + 1, len(langs)), 1 / max(1, len(pieces)))
    prob[-1] = UNKNOWN
    for _ in range(rounds if langs else 0):
        sent = spark.sparkContext.broadcast((pieces, prob))
        got = (counts.mapInArrow(_expect(sent, langs), "piece long, lang long, c double").groupBy("piece", "lang").agg(F.sum("c").alias("c")).toArrow())
        c = np.zeros_like(prob)
        c[got["piece"].to_numpy(), got["lang"].to_numpy()] = got["c"].to_numpy()
        c = np.round(c, 6)[:-1] + 0.05
        prob[:-1] = c / c.sum(axis=0) * (1 - UNKNOWN)
    return {"langs": langs, "pieces": pieces, "prob": prob, "share": np.array([by[c] / n for c in langs])}


def _predict(text: str, model, schema: pa.Schema, most: int):
    def part(batches):
        m = model.value
        langs, seg, prior = m["langs"], Segments(m["pieces"]), np.log(m["share"]) if m["langs"] else None
        known: dict[str, int] = {}
        table = np.zeros((0, len(langs)))
        for batch in batches:
            for x in slices(batch, text, 2 << 20):
                preds, scores = [], []
                docs = [words_of(t) for t in x.column(text).to_pylist()]
                if len(known) > most:  # the memory of word scores starts anew; results don't change
                    known, table = {}, table[:0]
                new = list(dict.fromkeys(w for d in docs for w in d if w not in known)) if langs else []
                known.update(zip(new, range(len(table), len(table) + len(new))))
                table = np.concatenate([table, log_totals(seg, new, m["prob"])]) if new else table
                for d in docs:
                    if not langs or not any(c.isalpha() for w in d for c in w):
                        preds.append(NONE)
                        scores.append(0.0)
                        continue
                    s = prior + table[[known[w] for w in d]].sum(axis=0)
                    best = int(s.argmax())
                    preds.append(langs[best])
                    scores.append(float(1 / np.exp(s - s[best]).sum()))
                cols = [*x.columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)
    return part


def identify(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", vocabulary: str = VOCABULARY,
             sample: int = 6_000, rounds: int = 2, most: int = 400_000) -> DataFrame:
    """``doc_id``, ``text`` with ``__lang`` and ``__score`` (posterior probability).

    ``train`` is a condition over ``docs``; only rows of it with a language teach.
    A null text, or one without a letter, or no training rows: ``und``, score 0.
    Ties go to the language first by name; repeated rows are predicted each; an
    empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.where(train), doc_id, text, lang, vocabulary, sample, rounds))
    rows = docs.select(doc_id, text)
    schema = T.StructType([*rows.schema.fields, T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())])
    return rows.mapInArrow(_predict(text, model, to_arrow_schema(schema), most), schema)
