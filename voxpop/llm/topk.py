"""Exact top-k inner-product search by a three-phase uniform threshold.

The components are cut into ``lists`` slices.  A slice is a list in the sense
of the method: it knows a partial score of every (query, vector), and a
vector's score is the sum over the lists.

1. Every list gives each query its best partial scores; only the vectors named
   are scored in full, a share of the vectors keeps one running list of them, and
   the k-th best over all shares is a safe cutoff T: no answer scores less.  A
   vector that leads no list is not among them, however well it scores.
2. T is sent to the tasks with each query.  A vector that scores T or more
   reaches T / lists in at least one list (the uniform threshold), so each list
   gives all entries from T / lists on.
3. Entries whose upper bound (the seen partial scores plus the largest that a
   list which did not name the vector can hold, less than T / lists) is below T
   go; the remaining ones are scored exactly and ranked.

Equal vectors are searched once, as one class with its k + 1 smallest ids, so
a vector that fills a third of the table is one candidate.  Vectors and queries
meet in blocks: each task holds one share of the vectors and one block of
queries, and multiplies ``TILE`` vectors at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxpop.llm.textkit import saved

K = 20


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """``vec_id``, ``v`` (floor(scale * x) as longs); rows with a null id, a null
    vector or a null or non-finite component take no part."""
    e = F.col(embedding)
    x = (vectors.where(F.col(vec_id).isNotNull() & e.isNotNull())
         .select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(e, lambda y: y.cast("double")).alias("x"))
         .where(F.forall("x", lambda y: F.coalesce(F.abs(y) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(y))))
    return x.select("vec_id", F.transform("x", lambda y: F.floor(y * scale).cast("long")).alias("v"))


def classes(v: DataFrame, keep: int) -> DataFrame:
    """Equal vectors as one row: ``cid`` (smallest id), ``v``, ``ids`` (the ``keep``
    smallest distinct ids, rising).  The rank limit is applied before the shuffle."""
    v = v.dropDuplicates(["vec_id", "v"])
    first = Window.partitionBy("v").orderBy("vec_id")
    top = v.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= keep)
    return (top.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
            .select(F.element_at("ids", 1).alias("cid"), "v", "ids"))


def _blocks(df: DataFrame, key: str, size: int, n: int, name: str) -> DataFrame:
    """Rows in hash blocks of about ``size`` rows."""
    return df.withColumn(name, F.pmod(F.xxhash64(F.lit(name), F.col(key)), F.lit(max(1, -(-n // size)))).cast("int"))


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64)  # integers below 2^53: exact


def _parts(q: np.ndarray, x: np.ndarray, lists: int) -> list[np.ndarray]:
    cuts = np.linspace(0, q.shape[1], lists + 1).astype(int)
    return [q[:, a:b] @ x[:, a:b].T for a, b in zip(cuts[:-1], cuts[1:])]


def _by_width(left: pd.DataFrame, right: pd.DataFrame):
    """Rows of both sides with vectors of one dimension (others have no inner product)."""
    lw, rw = left["v"].map(len), right["v"].map(len)
    for w in sorted(set(lw) & set(rw)):
        if w:
            yield left[lw == w], right[rw == w]


TILE = 4096  # vectors multiplied at a time


def _tiles(x: pd.DataFrame):
    """Ids and vectors of a share, a tile at a time."""
    for a in range(0, len(x), TILE):
        yield x["cid"].to_numpy()[a:a + TILE], _matrix(x["v"].iloc[a:a + TILE])


def _rows(q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"qid": q, "cid": ids, "score": score.astype(np.int64)})


NOTHING = _rows(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def _named(q: np.ndarray, x: pd.DataFrame, k: int, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the ``k`` best full scores among the vectors that lead one of a
    share's lists, and whose they are (-1: none).  Only those are scored in full."""
    best, whose = np.full((len(q), k), -np.inf), np.full((len(q), k), -1)
    for ids, v in _tiles(x):
        parts = _parts(q, v, lists)
        m = min(k, len(ids))
        at = np.concatenate([np.argpartition(-p, m - 1, axis=1)[:, :m] for p in parts], axis=1)
        score = sum(np.take_along_axis(p, at, 1) for p in parts)
        order = np.argsort(at, axis=1, kind="stable")  # a vector that leads several lists counts once
        again = np.zeros(at.shape, bool)
        sorted_at = np.take_along_axis(at, order, 1)
        np.put_along_axis(again, order[:, 1:], sorted_at[:, 1:] == sorted_at[:, :-1], 1)
        score[again] = -np.inf
        both, names = np.concatenate([best, score], axis=1), np.concatenate([whose, np.where(again, -1, ids[at])], axis=1)
        top = np.argpartition(-both, k - 1, axis=1)[:, :k]
        best, whose = np.take_along_axis(both, top, 1), np.take_along_axis(names, top, 1)
    return best, whose


def _local_tops(k: int, lists: int):
    def group(_, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [NOTHING]
        for q, x in _by_width(queries, rows):
            best, whose = _named(_matrix(q["v"]), x, k, lists)
            some = np.isfinite(best)
            out.append(_rows(np.repeat(q["cid"].to_numpy(), k)[some.ravel()], whose[some], best[some]))
        return pd.concat(out)
    return group


def _sufficient(parts: list[np.ndarray], cutoff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) positions that a list names at the cutoff's share and whose
    upper bound reaches the cutoff."""
    t = cutoff[:, None] / len(parts) - 1e-3  # below the share: rounding only adds entries
    named = [p >= t for p in parts]
    upper = sum(np.where(m, p, t) for m, p in zip(named, parts))  # a list that does not name it holds less than t
    return np.nonzero(np.logical_or.reduce(named) & (upper >= len(parts) * t))


def _enough(lists: int):
    def group(_, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [NOTHING]
        for q, x in _by_width(queries, rows):
            who, cutoff, qs = q["cid"].to_numpy(), q["cutoff"].to_numpy(np.float64), _matrix(q["v"])
            for ids, v in _tiles(x):
                parts = _parts(qs, v, lists)
                i, j = _sufficient(parts, cutoff)
                exact = sum(p[i, j] for p in parts)
                ok = exact >= cutoff[i]
                out.append(_rows(who[i[ok]], ids[j[ok]], exact[ok]))
        return pd.concat(out)
    return group


def top_k(vectors: DataFrame, k: int = K, query_every: int = 20, scale: int = 64, lists: int = 2, vec_id: str = "vec_id",
          embedding: str = "embedding", row_block: int = 16384, query_block: int = 1024) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row whose id is
    divisible by ``query_every`` the ``k`` other rows of highest inner product
    (all, if fewer), equal scores by smaller id.

    Rows that repeat an id with the same vector count once; vectors of another
    dimension are not candidates of a query; empty vectors have none; an empty
    table gives an empty result.  Other columns are not read.
    """
    v = quantised(vectors, vec_id, embedding, scale)
    c = saved(classes(v, k + 1), "topk-classes")
    queries = saved(v.where(F.col("vec_id") % query_every == 0).select(F.col("vec_id").alias("query_id"), "v").distinct()
                    .join(c.select("v", "cid"), "v").select("query_id", "cid"), "topk-queries")
    asked = saved(c.join(queries.select("cid").distinct(), "cid", "left_semi").select("cid", "v"), "topk-asked")
    n, m = c.count(), queries.count()
    rows = _blocks(c.select("cid", "v"), "cid", row_block, n, "rb")
    qb = max(1, -(-m // query_block))
    rb = max(1, -(-n // row_block))
    rows = rows.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1))))
    asked = _blocks(asked, "cid", query_block, m, "qb")
    spread = F.explode(F.sequence(F.lit(0), F.lit(rb - 1)))
    out = "qid long, cid long, score long"
    # at most k + 1 rows a query and share
    near = (asked.withColumn("rb", spread).groupBy("rb", "qb").cogroup(rows.groupBy("rb", "qb")).applyInPandas(_local_tops(k + 1, lists), out))
    best = Window.partitionBy("qid").orderBy(F.col("score").desc(), "cid")
    # k + 1: a query's own class is among them and may have no other member
    cut = (near.distinct().withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
           .groupBy("qid").agg(F.min("score").alias("low"), F.count("*").alias("n")))
    cut = saved(cut.select("qid", F.when(F.col("n") > k, F.col("low")).otherwise(F.lit(-(1 << 62))).alias("cutoff")), "topk-cutoffs")
    told = asked.join(cut, F.col("cid") == F.col("qid")).drop("qid").withColumn("rb", spread)
    found = told.groupBy("rb", "qb").cogroup(rows.groupBy("rb", "qb")).applyInPandas(_enough(lists), out)
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    members = (found.join(c.select("cid", "ids"), "cid").join(queries.withColumnRenamed("cid", "qid"), "qid")
               .select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id"))
    final = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (members.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
