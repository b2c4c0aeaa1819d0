"""Approximate nearest neighbours by a forest of random-projection trees.

A tree splits its node along a random direction at the median of a bounded
sample; every row of the table is indexed, once in each tree, under the leaf it
falls into.  A query walks all trees with one priority queue: the next node is
the one, of any tree, whose region is nearest (the squared distances by which
the query lies on the other side of the splits above, added up), until it has
visited ``visits`` leaves.  Queries and rows meet by leaf, and candidates are
ranked by their exact distance in double precision on the original vectors.

``visits`` is not guessed: a bounded sample of the queries is answered exactly
by one scan, and the smallest number of leaves is taken that holds a share
``recall`` of those answers.  Where the data have no structure (directions
spread evenly in many dimensions) that is a large part of all leaves.

A leaf of any size is exact: it is cut into blocks of rows, and a query meets
each of them.  Equal vectors are one entry with the smallest ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxpop.llm.textkit import saved

K, QUERY_EVERY = 10, 100
TREES, LEAF_ROWS, MAX_DEPTH = 4, 1024, 12
NODE_SAMPLE = 16  # sampled rows that a node needs to be split
CHECKED = 128  # queries answered exactly to choose the visits
RECALL, SEED = 0.96, 1
ROW_BLOCK, QUERY_BLOCK = 4096, 1024


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id``, ``x`` (doubles), once each.  Rows with a null id, a null or zero
    vector or a null or non-finite component take no part."""
    e = F.col(embedding)
    return (vectors.where(F.col(vec_id).isNotNull() & e.isNotNull())
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(e, lambda y: y.cast("double")).alias("x"))
            .where(F.forall("x", lambda y: F.coalesce(F.abs(y) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(y)))
            .where(F.exists("x", lambda y: y != 0)).dropDuplicates(["vec_id", "x"]))


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors: ``cid`` (smallest id), ``dim``, ``x``, ``ids`` (the ``keep`` smallest ids)."""
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))).where(F.col("r") <= keep)
    ids = F.sort_array(F.collect_list("vec_id"))
    return rows.groupBy("x").agg(ids.alias("ids")).select(F.element_at("ids", 1).alias("cid"), F.size("x").alias("dim"), "x", "ids")


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims):
        yield int(d), batch.filter(pa.array(dims == d))


def _fit(depth: int, seed: int):
    def tree(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows.sort_values("cid")["x"].to_numpy())
        rng = np.random.default_rng([seed, int(key[0]), int(key[1])])
        out, at = [], [(1, np.arange(len(x)))]
        for _ in range(depth):
            below = []
            for node, rows_in in at:
                if len(rows_in) < NODE_SAMPLE:
                    continue
                way = rng.normal(size=x.shape[1])
                way /= np.sqrt(way @ way)
                side = x[rows_in] @ way
                middle = len(side) // 2
                cut = float(np.partition(side, [middle - 1, middle])[middle - 1:middle + 1].mean())  # between two rows, not on one
                out.append((key[0], key[1], node, way.tobytes(), cut))
                below += [(2 * node, rows_in[side <= cut]), (2 * node + 1, rows_in[side > cut])]
            at = below
        return pd.DataFrame(out, columns=["dim", "tree", "node", "way", "cut"])
    return tree


class Forest:
    """The split nodes of all trees by dimension: directions as one matrix, and
    where each (tree, node) stands in it.  Bounded by the fitting sample."""

    def __init__(self, rows: list, trees: int):
        self.trees, self.of = trees, {}
        self.rows: dict[tuple[int, int, int], int] = {}  # entries by (dim, tree, leaf)
        for dim in {r["dim"] for r in rows}:
            mine = sorted((r["tree"], r["node"], r["way"], r["cut"]) for r in rows if r["dim"] == dim)
            ways = np.stack([np.frombuffer(w, np.float64) for _, _, w, _ in mine])
            self.of[dim] = (ways, np.array([c for *_, c in mine]), {(t, n): i for i, (t, n, _, _) in enumerate(mine)})

    def leaves(self, dim: int, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        at = np.ones((len(x), self.trees), np.int64)
        ways, cuts, place = self.of.get(dim, (None, None, {}))
        for t in range(self.trees):
            go = [(1, np.arange(len(x)))] if (t, 1) in place else []
            while go:
                node, rows = go.pop()
                right = x[rows] @ ways[place[t, node]] > cuts[place[t, node]]
                for kid, part in ((2 * node, rows[~right]), (2 * node + 1, rows[right])):
                    at[part, t] = kid
                    if len(part) and (t, kid) in place:
                        go.append((kid, part))
        return at

    def search(self, dim: int, x: np.ndarray, visits: int, least: int) -> list[list[tuple[int, int]]]:
        """For each query the first ``visits`` leaves (tree, leaf) that hold rows, off one
        priority queue over all trees; more, until one tree has given ``least`` entries."""
        ways, cuts, place = self.of.get(dim, (np.empty((0, dim)), np.empty(0), {}))
        margin = x @ ways.T - cuts
        out = []
        for m in margin.tolist():
            queue, found, given = [(0.0, t, 1) for t in range(self.trees)], [], [0] * self.trees
            while queue and (len(found) < visits or max(given) < least):
                far, t, node = heapq.heappop(queue)
                i = place.get((t, node))
                if i is None:
                    n = self.rows.get((dim, t, node), 0)
                    if n:
                        found.append((t, node))
                        given[t] += n
                    continue
                off = far + m[i] * m[i]
                heapq.heappush(queue, (off if m[i] > 0 else far, t, 2 * node))
                heapq.heappush(queue, (far if m[i] > 0 else off, t, 2 * node + 1))
            out.append(found)
        return out


def grown(rows: DataFrame, n: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, max_depth: int = MAX_DEPTH, seed: int = SEED) -> Forest:
    """The forest for ``n`` entries: leaves of about ``leaf_rows`` rows, at most
    2^``max_depth`` a tree, fitted on about ``2 * NODE_SAMPLE`` sampled rows a leaf."""
    depth = int(np.clip(np.ceil(np.log2(max(1, n / leaf_rows))), 3, max_depth))
    want = 2 * NODE_SAMPLE << depth
    part = F.pmod(F.xxhash64(F.lit(seed), "cid"), F.lit(1 << 30)) < F.lit(min(1 << 30, (want << 30) // max(1, n)))
    sample = rows.where(part).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    fitted = sample.groupBy("dim", "tree").applyInPandas(_fit(depth, seed), "dim int, tree int, node long, way binary, cut double")
    return Forest(fitted.collect(), trees)  # at most trees * 2^max_depth nodes


def nearest(q: np.ndarray, x: np.ndarray, xx: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact distances of the k nearest rows (all, if fewer), ties by id;
    ``xx`` are the rows' squared lengths.

    A matrix product preselects with a margin above its rounding; the distances
    are those of the differences."""
    at = np.arange(len(ids))
    with np.errstate(all="ignore"):
        if len(ids) > k:
            qq = float(q @ q)
            rough, slack = xx - 2 * (x @ q) + qq, 1e-9 * (xx + qq)
            sure = np.where(np.isfinite(rough), rough + slack, np.inf)
            at = np.flatnonzero(~(rough - slack > np.partition(sure, k - 1)[k - 1]))
        far = np.sqrt(((x[at] - q) ** 2).sum(axis=1))
    order = np.lexsort((ids[at], far))[:k]
    return ids[at[order]], far[order]


def _squares(x: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return (x * x).sum(axis=1)


FOUND = pa.schema([("qid", pa.int64()), ("cid", pa.int64()), ("score", pa.float64())])


def _scan(asked, k: int):
    """Running best of every asked query over all rows of a task."""
    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = asked.value
        best: dict[int, list] = {i: [] for i in range(len(queries))}
        for batch in batches:
            for dim, rows in _by_dim(batch):
                x, ids = _matrix(rows.column("x")), rows.column("cid").to_numpy()
                xx = _squares(x)
                for i, (qid, q) in enumerate(queries):
                    if len(q) == dim:
                        near, far = nearest(q, x, xx, ids, k + 1)
                        best[i] = sorted([*best[i], *((d, c) for d, c in zip(far.tolist(), near.tolist()) if c != qid)])[:k]
        out = [(queries[i][0], c, d) for i, b in best.items() for d, c in b]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), FOUND)], schema=FOUND)
    return part


def visits_for(spark: SparkSession, forest: Forest, rows: DataFrame, asked: list, k: int, recall: float) -> int:
    """The least number of visited leaves that finds a share ``recall`` of the
    exact k nearest entries of the ``asked`` queries ((id, vector) pairs)."""
    best = rows.mapInArrow(_scan(spark.sparkContext.broadcast(asked), k), "qid long, cid long, score double")
    top = best.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy("score", "cid"))).where(F.col("r") <= k)
    truth = top.select("qid", "cid").join(rows.select("cid", "dim", "x"), "cid").collect()  # k rows a query
    whole = 1 << 62
    order = {qid: {leaf: i for i, leaf in enumerate(forest.search(len(q), q[None], whole, 0)[0])} for qid, q in asked}
    ranks = sorted(min(order[r["qid"]][t, int(leaf)] for t, leaf in enumerate(forest.leaves(r["dim"], np.array([r["x"]]))[0])) + 1 for r in truth)
    return ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)] if ranks else 1


def _indexed(forest):
    schema = pa.schema([("dim", pa.int32()), ("tree", pa.int32()), ("leaf", pa.int64()), ("cid", pa.int64()), ("x", pa.list_(pa.float64()))])

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        for batch in batches:
            for dim, rows in _by_dim(batch):
                at = trees.leaves(dim, _matrix(rows.column("x")))
                for t in range(trees.trees):
                    n = rows.num_rows
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, dim), pa.int32()), pa.array(np.full(n, t), pa.int32()), pa.array(at[:, t]),
                                                      rows.column("cid"), rows.column("x")], schema=schema)
    return part


def _asks(forest, visits: int, least: int):
    schema = pa.schema([("dim", pa.int32()), ("tree", pa.int32()), ("leaf", pa.int64()), ("qid", pa.int64()), ("q", pa.list_(pa.float64()))])

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _by_dim(batch):
                found = forest.value.search(dim, _matrix(rows.column("x")), visits, least)
                at = np.repeat(np.arange(len(found)), [len(f) for f in found])
                leaf = np.array([v for f in found for v in f], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), dim), pa.int32()), pa.array(leaf[:, 0], pa.int32()), pa.array(leaf[:, 1]),
                                                  rows.column("cid").take(pa.array(at)), rows.column("x").take(pa.array(at))], schema=schema)
    return part


def _rerank(k: int):
    def block(asks: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if asks.num_rows and rows.num_rows:
            x, ids = _matrix(rows.column("x").combine_chunks()), rows.column("cid").to_numpy()
            xx = _squares(x)
            for qid, q in zip(asks.column("qid").to_pylist(), _matrix(asks.column("q").combine_chunks())):
                near, far = nearest(q, x, xx, ids, k)
                out.append((np.full(len(near), qid), near, far))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
        return pa.table([pa.array(c, t.type) for c, t in zip(cols, FOUND)], schema=FOUND)
    return block


def nearest_neighbours(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, recall: float = RECALL, trees: int = TREES, leaf_rows: int = LEAF_ROWS,
                       max_depth: int = MAX_DEPTH, vec_id: str = "vec_id", embedding: str = "embedding", seed: int = SEED, visits: int | None = None,
                       row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row whose id is
    divisible by ``query_every`` the ``k`` nearest other rows found (all, if
    there are fewer candidates), by Euclidean distance, ties by smaller id.

    Rows with a null id, a null or zero vector, or null or non-finite components
    take no part; rows that repeat an id with the same vector count once;
    vectors of another dimension are no candidates of a query; an empty table
    gives an empty result.  Other columns are not read.  ``visits`` sets the
    leaves a query visits in place of the measured number.
    """
    spark = vectors.sparkSession
    v = valid(vectors, vec_id, embedding)
    c = saved(entries(v, k + 1), "ann-entries")
    rows = c.select("cid", "dim", "x")
    n = rows.count()
    named = saved(v.where(F.col("vec_id") % query_every == 0).select(F.col("vec_id").alias("query_id"), "x").join(c.select("x", "cid", "dim"), "x")
                  .select("query_id", "cid", "dim", "x"), "ann-queries")
    asked = named.dropDuplicates(["cid"]).select("cid", "dim", "x")
    forest = grown(rows, n, trees, leaf_rows, max_depth, seed)
    leaf = ["dim", "tree", "leaf"]

    def indexed() -> DataFrame:
        return rows.mapInArrow(_indexed(spark.sparkContext.broadcast(forest)), "dim int, tree int, leaf long, cid long, x array<double>")

    held = saved(indexed().groupBy(*leaf).agg(F.count("*").alias("rows")), "ann-leaves")
    forest.rows = {(r["dim"], r["tree"], r["leaf"]): r["rows"] for r in held.collect()}  # at most trees * (2^max_depth + 1) a dimension
    if visits is None:
        m = asked.count()
        part = F.pmod(F.xxhash64(F.lit(seed + 1), "cid"), F.lit(1 << 30)) < F.lit(min(1 << 30, (CHECKED << 30) // max(1, m)))
        sample = [(r["cid"], np.array(r["x"])) for r in asked.where(part).select("cid", "x").collect()]  # about CHECKED rows
        visits = visits_for(spark, forest, rows, sample, k, recall)
    asks = asked.mapInArrow(_asks(spark.sparkContext.broadcast(forest), visits, k + 1), "dim int, tree int, leaf long, qid long, q array<double>")
    asks = saved(asks, "ann-asks")
    # a leaf's blocks of rows and of queries, as many as there are leaves
    sizes = (asks.groupBy(*leaf).agg(F.count("*").alias("asks")).join(held, leaf)
             .select(*leaf, F.ceil(F.col("rows") / row_block).cast("int").alias("nr"), F.ceil(F.col("asks") / query_block).cast("int").alias("na")))
    sizes = F.broadcast(saved(sizes, "ann-sizes"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    index = indexed().join(sizes, leaf).withColumn("rb", own("cid", "nr")).withColumn("qb", every("na")).select(*leaf, "rb", "qb", "cid", "x")
    asks = asks.join(sizes, leaf).withColumn("qb", own("qid", "na")).withColumn("rb", every("nr")).select(*leaf, "rb", "qb", "qid", "q")
    group = [*leaf, "rb", "qb"]
    found = asks.groupBy(*group).cogroup(index.groupBy(*group)).applyInArrow(_rerank(k + 1), "qid long, cid long, score double")
    best = Window.partitionBy("qid").orderBy("score", "cid")
    top = found.groupBy("qid", "cid").agg(F.min("score").alias("score")).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    members = (top.select("qid", "cid", "score").join(c.select("cid", "ids"), "cid").join(named.select("query_id", F.col("cid").alias("qid")), "qid")
               .select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id"))
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return members.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
