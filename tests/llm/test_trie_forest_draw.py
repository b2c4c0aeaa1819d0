"""Prefix trie, neighbours and resampling: SQL or brute force, on the supplied
tables and on small ones with nulls, ties, repeated rows, empty tables and
clashing column names."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from voxpop.llm import forest, importance, trie
from voxpop.llm import queries as Q

SF = "/root/testdata/sf0.001"
NEW = ["op11_prefix_trie", "op13_resampling"]
TURNS = "conv_id long, turn long, role string, text string, node string, own int, shard int"
VECS = "vec_id long, embedding array<float>, cid int, rows string"
DOCS = "doc_id long, text string, score string, rank int, part long"


def _turns():
    rng = random.Random(4)
    said = ["hello there", "", None, "a  b\tc", "é x", "hello there "]
    out = []
    for c in [*range(0, 70), 100, 101, 139, 205]:
        if c in (20, 33):  # a group without its base, and a conversation of the base only
            continue
        for t in range(rng.choice([1, 2, 3, 4, 9])):
            out.append((c, None if (t == 0 and c % 7 == 0) else t, rng.choice(["user", "assistant", None]), said[0] if t == 0 else rng.choice(said)))
    out += [(0, 1, "user", "tie"), (0, 1, "user", "tie"), (0, 1, "system", "tie"), (None, 0, "user", "nobody"), (-5, 0, "user", "below zero")]
    out += [(41, t, "user", f"long {t % 5}") for t in range(20, 90)] + [(59, t, "user", "long 0") for t in range(300)]
    return [(*r, "clash", 1, 2) for r in out]


def _texts():
    rng = random.Random(9)
    words = ["the", "of", "Alpha", "beta", "GAMMA", "delta", "é", "ñu", "x1", "+1-499", "a@b.co", "end."]
    out = [None, "", "  \n", "one", " ".join(words * 3), " ".join(words * 3), " ".join(words * 400)]
    return out + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(60)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("odd"))
    put = lambda rows, schema, name: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    put(_turns(), TURNS, "conversations")
    put([(i, t, "clash", 3, 4) for i, t in enumerate(_texts())] + [(5, _texts()[5], "clash", 3, 4), (None, "null id " * 30, None, None, None)] * 3, DOCS, "documents")
    put([(1, "the of Alpha beta"), (2, None), (3, "unseen words"), (3, "unseen words")], "item_id long, text string", "benchmark")
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 8)).astype(np.float32).tolist()
    x[7], x[8], x[9], x[10] = None, [0.0] * 8, [None] + [1.0] * 7, [float("nan")] + [1.0] * 7
    x[100] = x[40] = x[41] = x[42]
    rows = [(i, v, 1, "clash") for i, v in enumerate(x)] + [(1000 + i, x[300], 1, "clash") for i in range(40)]
    rows += [(2000, [1.0, 2.0], 1, ""), (2001, [1.0, 3.0], 1, ""), (None, x[1], 1, ""), (200, x[200], 1, ""), (3100, [1e200] * 8, 1, "")]
    put(rows, "vec_id long, embedding array<double>, cid int, rows string", "embeddings")
    return d


def _strict(rows, names=None):
    return sorted((tuple(v for _, v in sorted((r.asDict() if names is None else dict(zip(names, r))).items())) for r in rows), key=str)


@pytest.mark.parametrize("name", NEW)
@pytest.mark.parametrize("where", ["sf", "odd"])
def test_query_equals_sql(spark, odd, name, where):
    d = SF if where == "sf" else odd
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet{'' if where == 'sf' else '/*.parquet'}')")
    cur = con.execute(Q.ORACLE[name])
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    got = _strict(Q.QUERIES[name](spark, d).collect())
    assert len(got) > 10 and got == _strict(want, names)


def test_empty_tables(spark, odd):
    table = lambda t: spark.read.parquet(f"{odd}/{t}.parquet").limit(0)
    assert trie.conversation_trie(table("conversations")).count() == 0
    assert forest.nearest_neighbours(table("embeddings")).count() == 0
    assert importance.resample(table("documents"), table("benchmark")).count() == 0
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    assert importance.resample(docs, table("benchmark")).count() == docs.count()


@pytest.mark.parametrize("shard_bytes", [200, 1500])
def test_shards_do_not_change_the_trie(spark, odd, shard_bytes):
    turns = spark.read.parquet(f"{odd}/conversations.parquet")
    cols = [c for c in trie.conversation_trie(turns).columns]
    one, many = (_strict(trie.conversation_trie(turns.repartition(p), shard_bytes=b).select(*cols).collect()) for p, b in ((1, 1 << 30), (7, shard_bytes)))
    assert one == many


def test_prefix_of_a_key_at_a_shard_border(spark):
    """Keys that are prefixes of one another, each in a shard of its own."""
    convs = [(i, [(f"{t:032x}", 1) for t in range(n)]) for i, n in enumerate([0, 1, 2, 3, 3, 8, 5])]
    df = spark.createDataFrame(convs, "conv_id long, turns array<struct<id:string,words:int>>")
    rows = {r["depth"]: r for r in trie.trie_nodes(df, shard_bytes=1).collect()}
    assert [rows[d]["n_convs"] for d in range(9)] == [7, 6, 5, 4, 2, 2, 1, 1, 1]
    assert [rows[d]["n_leaves"] for d in range(9)] == [1] * 9
    assert [rows[d]["n_children"] for d in range(9)] == [1] * 8 + [0]
    assert rows[0]["saved_tokens"] == 5 + 4 + 3 + 1 + 1 and rows[4]["saved_tokens"] == 2


def test_every_layout_and_path_split():
    rng = random.Random(1)
    keys = sorted({bytes([rng.choice(range(256)) for _ in range(rng.choice([2, 4, 6]))]) for _ in range(4000)})
    keys += [bytes([b]) * 3 for b in range(5)]
    keys = list(dict.fromkeys(keys))
    root = trie.Inner(b"")
    for i, k in enumerate(keys):
        trie.insert(root, k, i)

    def entries(node, at):
        at += node.path
        if node.entry is not None:
            yield at, node.entry
        for byte, kid in node.items():
            assert kid.path[0] == byte and node.get(byte) is kid
            yield from entries(kid, at)

    assert list(entries(root, b"")) == sorted((k, i) for i, k in enumerate(keys))  # in byte order
    assert trie.layout_counts(keys)[256] >= 1
    wide = trie.layout_counts([bytes([0, b]) for b in range(40)] + [bytes([1, b]) for b in range(10)] + [bytes([2])])
    assert wide[48] == 1 and wide[16] == 1


def _exact(rows, query, k):
    q = np.array(rows[query])
    with np.errstate(all="ignore"):
        far = sorted((float(np.sqrt(((np.array(v) - q) ** 2).sum())), i) for i, v in rows.items() if i != query and len(v) == len(q))
    return far[:k]


def _usable(spark, d):
    good = lambda v: v is not None and None not in v and np.isfinite(v).all() and np.any(v)
    return {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{d}/embeddings.parquet").collect() if r["vec_id"] is not None and good(r["embedding"])}


@pytest.mark.parametrize("where", ["sf", "odd", "sf0.01", "sf0.1"])
def test_neighbours_recall_ranks_and_exact_scores(spark, odd, where):
    d = {"sf": SF, "odd": odd}.get(where, f"/root/testdata/{where}")
    rows, found = _usable(spark, d), {}
    for r in Q.QUERIES["op12_neighbours"](spark, d).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    hit = total = 0
    for q in (i for i in rows if i % 100 == 0):
        want, got = _exact(rows, q, 10), sorted(found.pop(q, []))
        assert [r for r, _, _ in got] == list(range(1, len(want) + 1))
        assert [g[1:] for g in got] == sorted(g[1:] for g in got)
        for _, score, i in got:
            with np.errstate(all="ignore"):
                assert score == pytest.approx(float(np.sqrt(((np.array(rows[i]) - np.array(rows[q])) ** 2).sum())), rel=1e-14)
        hit += len({i for _, i in want} & {i for _, _, i in got})
        total += len(want)
    assert not found and hit >= 0.9 * total


def test_all_leaves_give_the_exact_answer_in_blocks_of_any_size(spark, odd):
    rows = _usable(spark, odd)
    vectors = spark.read.parquet(f"{odd}/embeddings.parquet")
    out = forest.nearest_neighbours(vectors.repartition(5), visits=1 << 40, leaf_rows=20, row_block=7, query_block=2).collect()
    got = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    for q in (i for i in rows if i % 100 == 0):
        assert got.get(q, []) == [(pytest.approx(s, rel=1e-14), i) for s, i in _exact(rows, q, 10)]


def test_search_order_is_one_queue_over_all_trees():
    rng = np.random.default_rng(0)
    ways = [(t, n, rng.normal(size=3)) for t in range(2) for n in range(1, 8)]
    f = forest.Forest([{"dim": 3, "tree": t, "node": n, "way": w.tobytes(), "cut": 0.1} for t, n, w in ways], 2)
    f.rows = {(3, t, leaf): 1 for t in range(2) for leaf in range(8, 16)}
    q = rng.normal(size=(4, 3))
    for one, found in zip(q, f.search(3, q, 1 << 30, 0)):
        def cost(t, leaf):
            c, node = 0.0, leaf
            while node > 1:
                m = next(float(one @ w) for tt, n, w in ways if (tt, n) == (t, node // 2)) - 0.1
                c += m * m if (m > 0) != (node % 2 == 1) else 0.0
                node //= 2
            return c
        costs = [cost(t, leaf) for t, leaf in found]
        assert len(found) == 16 and costs == sorted(costs)
    assert [len(x) for x in f.search(3, q, 1, 3)] == [len(x) for x in f.search(3, q, 1, 3)] and all(len(x) >= 3 for x in f.search(3, q, 1, 3))


@pytest.mark.parametrize("k", [1, 2, 37, 150, 299, 300])
def test_kth_key_equals_a_sort(spark, k):
    rng = random.Random(k)
    keys = [(rng.randint(-5, 5), rng.choice([None, *range(40)])) for _ in range(200)] + [(3, 7)] * 100
    df = spark.createDataFrame(keys, "score long, doc_id long").repartition(6)
    want = sorted(keys, key=lambda r: (-r[0], r[1] is not None, r[1] or 0))[k - 1]
    assert importance.kth_key(df, k, pivots=3) == want


def test_draw_ranks_repeated_rows_one_by_one_in_ranges(spark):
    rng = random.Random(2)
    rows = [(i % 60, 30, 90, 5, rng.choice([1, 2, 3]) if i < 60 else 3) for i in range(200)] + [(1000, 3, 6, 99, 99)]
    df = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    out = importance.draw(df.repartition(4), share=(1, 2), min_words=20, range_rows=13).collect()
    assert len(out) == 201
    order = sorted(r[:5] for r in rows[:200])
    order = sorted(order, key=lambda r: (-r[4], r[0]))
    drawn = sorted((r for r in out if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 101))
    assert [(r["score"], r["doc_id"]) for r in drawn] == [(r[4], r[0]) for r in order[:100]]


def test_drawn_rows_keep_their_columns(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    ranked = importance.resample(docs, spark.read.parquet(f"{odd}/benchmark.parquet"), share=(1, 2), min_words=5)
    kept = importance.drawn(docs, ranked)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in ranked.where("rank is not null").collect()}
    assert {r["doc_id"] for r in kept.collect()} == ids and 5 < len(ids)


def test_same_result_for_any_partitioning(spark, odd):
    docs, bench = spark.read.parquet(f"{odd}/documents.parquet"), spark.read.parquet(f"{odd}/benchmark.parquet")
    a, b = (_strict(importance.resample(docs.repartition(p), bench).collect()) for p in (1, 13))
    assert a == b
    assert docs.where(F.col("doc_id") == 5).count() == 4
