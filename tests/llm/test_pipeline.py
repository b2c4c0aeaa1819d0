"""The pipeline against a brute-force version of its stages, and every stage on
odd rows, empty tables and clashing column names."""

import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_operators import SF, _brute_groups, edge, empty  # noqa: F401
from voxpop.llm import decontam, linedup
from voxpop.llm import queries as Q

SPACE = " \t\n\x0b\x0c\r"
LOWER = {u: u + 32 for u in range(65, 91)}


def _without_repeats(texts):
    key = lambda line: line.strip(SPACE).translate(LOWER)
    first, held = {}, {}
    for i in sorted(texts):
        for k in {key(x) for x in (texts[i] or "").split("\n")}:
            first.setdefault(k, i)
            held[k] = held.get(k, 0) + 1
    gone = lambda k, i: len(k) >= linedup.MIN_CHARS and held[k] > 1 and first[k] != i
    return {i: None if t is None else "\n".join(x for x in t.split("\n") if not gone(key(x), i)) for i, t in texts.items()}


def _without_items(texts, items, window=decontam.WINDOW):
    spans = lambda t: list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER)))
    wins = set()
    for t in items:
        w = [m.group() for m in spans(t)]
        n = min(len(w), window)
        wins |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set()
    out = {}
    for i, t in texts.items():
        found = spans(t)
        w = [m.group() for m in found]
        hit = set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
        if len(hit) > 0.5 * len(w):
            continue
        for k in sorted(hit, reverse=True):  # a word, and what stands before a hit neighbour
            end = found[k + 1].start() if k + 1 in hit else found[k].end()
            t = t[:found[k].start()] + t[end:]
        out[i] = t
    return out


@pytest.mark.parametrize("where", ["sf", "edge"])
def test_pipeline_equals_brute_force(spark, edge, where):  # noqa: F811
    d = SF if where == "sf" else edge
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    good = {r["doc_id"] for r in Q.QUERIES["op9_quality"](spark, d).where("predicted = 1").collect()}
    texts = _without_repeats({i: docs[i]["text"] for i in good})
    texts = {i: texts[i] for i, (_, comp) in _brute_groups(texts).items() if comp == i}
    texts = _without_items(texts, items)
    documents = pd.DataFrame([(i, t, docs[i]["lang"], docs[i]["source"]) for i, t in texts.items()], columns=["doc_id", "text", "lang", "source"])
    con = duckdb.connect()
    con.register("documents", documents)
    want = sorted(con.execute(f"SELECT doc_id, epoch, take_tokens, n_tokens FROM ({Q.ORACLE['op1_mixing']}) m").fetchall())
    rows = P.run(spark, d).collect()
    assert sorted((r["doc_id"], r["epoch"], r["take_tokens"], r["n_tokens"]) for r in rows) == want and want
    for r in rows:
        i, words = r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]])
        assert r["text"] == (texts[i] if r["take_tokens"] == r["n_tokens"] else " ".join(words[:r["take_tokens"]]))
        assert r["n_chars"] == len(texts[i]) and (r["lang"], r["source"]) == (docs[i]["lang"], docs[i]["source"])


@pytest.mark.parametrize("name,stage", P.STAGES, ids=[n for n, _ in P.STAGES])
def test_stage_on_odd_rows(spark, edge, name, stage):  # noqa: F811
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    odd = docs.unionByName(docs.limit(9)).unionByName(docs.limit(9).withColumn("doc_id", F.lit(None).cast("long")))
    out = stage(spark, odd, edge)
    assert out.columns[:len(docs.columns)] == docs.columns
    assert (name == "mix") == (out.columns != docs.columns)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    if name == "line_dedup":
        assert len(ids) == odd.count()
    if name == "near_dedup":  # one row an id; rows without one stay
        named = [i for i in ids if i is not None]
        assert len(set(named)) == len(named) and len(ids) - len(named) == 9
    assert set(ids) <= {r["doc_id"] for r in odd.select("doc_id").collect()}


@pytest.mark.parametrize("stage", [s for _, s in P.STAGES] + [None], ids=[n for n, _ in P.STAGES] + ["all"])
def test_stage_on_empty_tables(spark, empty, stage):  # noqa: F811
    docs = spark.read.parquet(f"{empty}/documents.parquet")
    out = P.run(spark, empty) if stage is None else stage(spark, docs, empty)
    assert out.count() == 0


@pytest.mark.parametrize("name,stage", P.STAGES, ids=[n for n, _ in P.STAGES])
def test_stage_keeps_clashing_columns(spark, edge, name, stage):  # noqa: F811
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    extra = ["__score", "__n_lines", "__n_dropped", "__n_words", "__n_hit", "__spans", "__items", "__gone", "__row", "__n", "__take", "__epoch", "__edge", "__drops"]
    more = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in extra})
    got, want = stage(spark, more, edge), stage(spark, docs, edge)
    assert sorted(got.columns) == sorted([*want.columns, *extra])
    for r in got.collect():
        assert all(r[c] == f"{c}{r['doc_id']}" for c in extra)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
