"""The ten operators: SQL or brute force on small fixtures with nulls, empty and
long texts, ties, repeated rows, empty tables and clashing column names."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.oracle_runner import canon
from voxpop.llm import decontam, graph, langid, linedup, mixing, neardup, ngram_lm, pii, quality, topk, urlfilter
from voxpop.llm import queries as Q

SF = "/root/testdata/sf0.001"
LATER = ("op11_", "op12_", "op13_")  # tested in test_trie_forest_draw.py
DOCS = "doc_id long, text string, lang string, source string, n_chars long, __doc string, key int"
VECS = "vec_id long, embedding array<float>, label int"


def _texts():
    rng = random.Random(3)
    words = ["the", "of", "Alpha", "beta", "GAMMA", "delta", "é", "ñu", "x1", "+1 (499) 555-6503", "a@b.co", "10.0.0.1", "end."]
    base = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(6)]
    out = [None, "", "\n\n", "   ", "one", "Repeated line here\nunique zebra one", "repeated LINE here  \nother stuff", base[0], base[0],
           base[0].replace("delta", "delto", 1), base[1] + "\n" + "shared passage of many words " * 4, base[2] + "\n" + "shared passage of many words " * 4,
           " ".join(base) * 40, "\t12 Repeated line here\n", "Repeated line here", base[3] + " 4111 1111 1111 1111 " + base[4]]
    return out + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 200))) for _ in range(30)]


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("edge"))
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "src0", "src5", "src9"][i % 4], None if t is None else len(t), "clash", i) for i, t in enumerate(_texts())]
    _write(spark.createDataFrame(rows, DOCS), d, "documents")
    items = [(1, rows[7][1][:120]), (2, None), (3, ""), (4, "the of alpha"), (5, rows[12][1][:900]), (6, rows[7][1][:120])]
    _write(spark.createDataFrame(items, "item_id long, text string"), d, "benchmark")
    urls = [None, "", "no scheme", "http://", "https://WWW.Example.com/en/1?x#y", "http://a.example.com/en/", "http://example.com/fr/", "http://b.net/es/2", "http://net/fr/",
            "https://casino-win.example.org/de/1", "http://Evil.org", "http://x.org/y.com/z", "http://notexample.com/en/1", "http://a.b.com", "ftp://é.com/ü?q"]
    _write(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls * 2)], "page_id long, url string, html string"), d, "pages")
    rng = random.Random(5)
    vecs = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(6)], 0) for i in range(70)]
    vecs[3], vecs[20], vecs[41] = (3, None, 0), (20, [0.1, None, 0.0, 0.0, 0.0, 0.0], 0), (41, [float("nan")] + [0.0] * 5, 0)
    vecs += [(100 + i, [0.5] * 6, 1) for i in range(40)]
    _write(spark.createDataFrame(vecs, VECS), d, "embeddings")
    _write(spark.createDataFrame([(i, None if i == 9 else i % 2, 0) for i in range(0, 40, 3)], "doc_id long, quality int, toxic int"), d, "labels")
    return d


@pytest.fixture(scope="session")
def empty(spark, edge, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "benchmark", "pages", "embeddings", "labels"):
        _write(spark.read.parquet(f"{edge}/{t}.parquet").limit(0), d, t)
    return d


def _write(df, d, name):
    df.coalesce(1).write.parquet(f"{d}/{name}.parquet")


def _glob(d, t):
    return f"{d}/{t}.parquet" if d == SF else f"{d}/{t}.parquet/*.parquet"


@pytest.mark.parametrize("name", sorted(n for n in Q.ORACLE if not n.startswith(LATER)))
@pytest.mark.parametrize("where", ["sf", "edge"])
def test_query_equals_sql(spark, edge, name, where):
    d = SF if where == "sf" else edge
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{_glob(d, t)}')")
    assert canon(Q.QUERIES[name](spark, d).toPandas()) == canon(con.execute(Q.ORACLE[name]).df())


@pytest.mark.parametrize("name", sorted(n for n in Q.QUERIES if not n.startswith(LATER)))
def test_empty_tables(spark, empty, name):
    assert Q.QUERIES[name](spark, empty).count() == 0


def _words(t):
    return (t or "").encode().lower().split()


def _docs(spark, d):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}


def test_base_score_equals_brute_force(spark, edge):
    words = {i: [*_words(t), None] for i, t in _docs(spark, edge).items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    c = collections.Counter(w for i, x in words.items() if not held[i] for w in x)
    n, v = sum(c.values()), len(c)
    rows = Q.QUERIES["op2_lm_scoring"](spark, edge).collect()
    assert len(rows) == len(words)
    for r in rows:
        x = words[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(x), sum(c[w] > 0 for w in x), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x), rel_tol=1e-12)
        assert r["score"] < 0


def test_words_beyond_the_head_keep_exact_counts(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet").select("doc_id", "text")
    a, b = ({r["doc_id"]: (r["__n_known"], round(r["__base"], 9)) for r in ngram_lm.score_texts(docs, F.lit(True), max_head=m).collect()} for m in (1 << 20, 2))
    assert a == b


def test_a_small_filter_keeps_its_bound_and_the_base_score(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet").select("doc_id", "text")
    full, small = ({r["doc_id"]: r for r in ngram_lm.score_texts(docs, F.lit(True), max_bits=m).collect()} for m in (1 << 30, 1 << 9))
    for i, r in full.items():
        assert (r["__n_known"], r["__n_tokens"]) == (small[i]["__n_known"], small[i]["__n_tokens"])
        assert math.isclose(r["__base"], small[i]["__base"], rel_tol=1e-12) and math.isfinite(small[i]["__score"])
    stats = [{"lv": lv, "k": 1 << (10 - lv), "n": 1 << 10, "bigram": b} for b in (0, 1) for lv in range(10)]
    for room in (0, 5, 100, 1000, 10**6):
        of, first = ngram_lm._fitting(stats, 0, 0, room)
        assert ngram_lm._inserted(of) <= room and (first == 0) == (room == 10**6)


def test_score_keeps_every_count_and_any_number_of_groups(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    words = {i: [*_words(t), None] for i, t in _docs(spark, SF).items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    grams = [collections.Counter(g for i, x in words.items() if not held[i] for g in f(x)) for f in (list, lambda x: zip([0, *x], x))]
    n, v, rows = sum(grams[0].values()), len(grams[0]), sum(not h for h in held.values())
    bits = 64 * sum(k.bit_length() for c in grams for k in c.values())
    assert list(grams[1].values()).count(1) > len(grams[1]) // 2
    levels = [collections.defaultdict(list) for _ in grams]
    for c, lv in zip(grams, levels):
        for k in c.values():
            lv[k.bit_length()].append(k)
    mean = [{k: sum(x) / len(x) for k, x in lv.items()} | {0: 0.0} for lv in levels]
    count = lambda kind, g: mean[kind][grams[kind][g].bit_length()]
    train = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    # 64 bits an insertion: hardly any false positive; few bits of filter at a time: several passes
    whole, parts = ({r["doc_id"]: r["__score"] for r in ngram_lm.score_texts(docs, train, bits=64, **k).collect()}
                    for k in ({"per_shard": 1 << 13}, {"per_shard": 1 << 13, "max_bits": bits // 3}))
    far = 0
    for i, x in words.items():
        score = 0.0
        for a, b in zip([0, *x], x):
            c, prev = count(0, b), count(0, a) if a != 0 else rows
            score += math.log10(0.6 * (c + 1) / (n + v + 1) + 0.4 * min(1.0, count(1, (a, b)) / max(prev, 1.0)))
        assert math.isclose(parts[i], whole[i], rel_tol=1e-12)
        far += not math.isclose(whole[i], score, rel_tol=1e-9)
    assert len(whole) == len(parts) == len(words) and far <= len(words) // 20


def _brute_groups(texts):
    def shingles(t):
        w = _words(t)
        return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            i = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * i >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def _chain_docs():
    """Copies of copies, each with one more change: far ends are not similar, the chain links them."""
    rng = random.Random(9)
    w = [f"w{rng.randint(0, 400)}" for _ in range(80)]
    out = {}
    for i in range(40):
        out[i] = " ".join(w)
        w = list(w)
        w[rng.randrange(80)] = f"n{i}"
    passage = " ".join(f"p{k}" for k in range(40))
    for i in range(40, 90):
        out[i] = passage + " " + " ".join(f"u{i}_{k}" for k in range(rng.randint(10, 60)))
    return out | {90: None, 91: "", 92: "a b", 93: "A  b", 94: "a c"}


@pytest.mark.parametrize("rare", [1, 8])
def test_near_duplicates_equal_brute_force(spark, rare):
    texts = _chain_docs()
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, comp string").repartition(5)
    got = {r["doc"]: (r["n"], r["comp"]) for r in neardup.near_duplicates(df, rare=rare).collect()}
    assert got == _brute_groups(texts)


def test_near_duplicates_on_fixture_and_repeated_rows(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in Q.QUERIES["op3_near_dedup"](spark, edge).collect()}
    assert got == _brute_groups(_docs(spark, edge))
    twice = neardup.near_duplicates(docs.unionByName(docs).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long"))))
    assert {r["doc"]: (r["n"], r["comp"]) for r in twice.collect()} == got


def test_components(spark):
    edges = [(9, 3), (3, 7), (7, 1), (20, 21), (21, 22), (5, 5)] + [(100, 100 + i) for i in range(1, 50)]
    got = {r["id"]: r["comp"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {9: 1, 3: 1, 7: 1, 1: 1, 20: 20, 21: 20, 22: 20} | {100 + i: 100 for i in range(50)}


def test_line_dedup_full_filter_and_odd_rows(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    odd = docs.limit(12).unionByName(docs.limit(12)).unionByName(docs.limit(8).withColumn("doc_id", F.lit(None).cast("long")))
    out = linedup.dedup_lines(odd)
    assert out.columns == [*docs.columns, "__n_lines", "__n_dropped"] and out.count() == odd.count()
    assert out.where("doc_id is null and __n_dropped > 0").count() == 0
    # a filter that holds everything only makes more suspects
    a, b = (sorted(map(str, linedup.dedup_lines(docs, max_bits=m, bits_per_line=16).collect())) for m in (1 << 30, 1 << 16))
    assert a == b


def test_decontamination_removes_spans_and_uses_several_automata(spark, edge):
    docs, items = (spark.read.parquet(f"{edge}/{t}.parquet") for t in ("documents", "benchmark"))
    one, many = (decontam.match_items(docs, items, max_words=m).orderBy("doc_id").collect() for m in (10**6, 1))
    assert one == many
    clean = decontam.decontaminate(docs, items, max_coverage=1.0)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in one:
        assert (left[r["doc_id"]] == r["text"]) == (r["__n_hit"] == 0)
    assert decontam.decontaminate(docs, items, max_coverage=0.5).count() < docs.count()


def test_shift_and_equals_regular_expressions():
    rng = random.Random(2)
    pats = ["*a*", "ab**", "*.b/**", "a*b/c", "**", "*", "a" * 70 + "**", "**ba"]
    texts = ["".join(rng.choice("ab./c") for _ in range(rng.randint(0, 12))).encode() for _ in range(400)] + [b"a" * 75, b""]
    got = urlfilter.ShiftAnd(pats).match(texts)
    for p, pat in enumerate(pats):
        want = re.compile(re.escape(pat).replace(r"\*\*", "(?s:.*)").replace(r"\*", "[^/]*"))
        assert [bool(want.fullmatch(t.decode())) for t in texts] == got[:, p].tolist(), pat


def _luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def _base(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_pii_base_spans_equal_the_patterns(spark, edge):
    rng = random.Random(1)
    for _ in range(5000):
        t = "".join(rng.choice("0123456789..--  ++@@ab().\n") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(t) == _base(t)
    texts = _docs(spark, edge)
    for r in Q.QUERIES["op8_pii"](spark, edge).collect():
        b = _base(texts[r["doc_id"]] or "")
        listed = [f"{pii.KINDS[k]}:{x}:{y}" for x, k, y in b]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == i for _, k, _ in b) for i in range(4)]
        assert set(listed) <= set(r["spans"].split(",")) | {""}


def test_pii_field_adds_what_the_patterns_miss(spark):
    rows = [(i, f"call +1 ({200 + i}) 555-{1000 + i} now\nor pay 4111111111111111 to x{i}@y.example.com from 10.0.0.{i}") for i in range(60)]
    rows.append((99, "call +1 (314) 555-6532 4663622617512349 now"))  # run together: neither pattern fits
    rows.append((100, "License, Version 2.0. chapter 3, year 1999, password=9e5d262097869d7f87"))
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["__added"]] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[99] == [("phone", 5, 22), ("card", 23, 39)] and got[100] == []


def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    q = Q.QUERIES["op9_quality"](spark, sf).where("held_out").join(lab, "doc_id")
    assert q.where("predicted = quality").count() >= 0.97 * q.count() > 0
    langs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    x = Q.QUERIES["op6_language_id"](spark, sf).where("held_out").join(langs, "doc_id")
    assert x.where("lang_pred = lang").count() >= 0.95 * x.count() > 0


def test_language_of_texts_without_letters(spark, edge):
    texts = _docs(spark, edge)
    for r in Q.QUERIES["op6_language_id"](spark, edge).collect():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[r["doc_id"]] or ""))
        assert 0 <= r["score"] <= 1


def test_forward_sums_all_segmentations():
    import numpy as np
    pieces = [langid.MARK, "a", "b", "ab", langid.MARK + "a", "ba"]
    seg = langid.Segments(sorted(pieces))
    p = {x: 0.1 + 0.05 * i for i, x in enumerate(sorted(pieces))}
    prob = np.array([[p[x]] for x in sorted(pieces)] + [[1e-7]])

    def total(s):
        return 1.0 if not s else sum(p.get(s[:k], 1e-7 if k == 1 else 0) * total(s[k:]) for k in range(1, len(s) + 1))
    words = ["abab", "b", "zab"]
    hits, size = seg.hits(words)
    got = langid.forward(hits, size, prob)[np.arange(3), size, 0]
    assert np.allclose(got, [total(langid.MARK + w) for w in words])


@pytest.mark.parametrize("letters", [31, 75, 400])
def test_a_long_run_is_summed_over_all_its_segmentations(letters):
    """Against exact fractions, over the whole run; beyond a double's range in logarithms."""
    from fractions import Fraction

    import numpy as np
    rng = random.Random(letters)
    pieces = sorted([langid.MARK, "a", "b", "ab", langid.MARK + "a", "ba", "aba", "bbbb"])
    seg = langid.Segments(pieces)
    prob = np.array([[0.01 + 0.02 * i, 0.2 / (i + 1)] for i in range(len(pieces))] + [[1e-7, 1e-7]])
    word = "".join(rng.choice("aaabbbz") for _ in range(letters))
    s = langid.MARK + word
    for lang in (0, 1):
        exact = [Fraction(1)] + [Fraction(0)] * len(s)
        p = {x: Fraction(prob[i, lang]) for i, x in enumerate(pieces)}
        for j in range(1, len(s) + 1):
            exact[j] = sum(exact[i] * p.get(s[i:j], Fraction(prob[-1, lang]) if j - i == 1 else 0) for i in range(max(0, j - 4), j))
        want = math.log(exact[-1].numerator) - math.log(exact[-1].denominator)
        assert math.isclose(langid.log_totals(seg, [word, "ab"], prob)[0, lang], want, rel_tol=1e-12)
    times = np.array([2.0, 3.0])
    counts = langid.long_expected(seg, word, np.log(prob), times)
    covered = sum(c * (len(pieces[i]) if i < len(pieces) else 1) for i, c in counts.items())
    assert np.allclose(covered, times * len(s))  # every letter is in one piece of a segmentation
    if letters == 31:
        hits, size = seg.hits([word])
        total = langid.expected(hits, size, prob, times[None])
        assert all(np.allclose(total[i], counts.get(i, 0)) for i in range(len(total)))


def test_words_are_whole_runs_and_rare_languages_keep_their_part():
    assert langid.words_of("あ" * 75 + " x1 y") == ["あ" * 75, "x", "y"]
    assert langid.quotas({"a": 10, "b": 5000, "c": 1_000_000}, 6000) == {"a": 10, "b": 2995, "c": 2995}
    assert langid.quotas({"a": 3}, 6000) == {"a": 3} and langid.quotas({}, 10) == {}


def test_the_cut_is_the_quantile_of_all_labelled_rows(spark):
    import numpy as np
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["word", "other", "#$%", "A", "end."][: 5 if i % 4 else 2]) for _ in range(rng.randint(3, 60)))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i, _ in rows[:600]], "doc_id long, quality int")
    model = quality.fit(docs, labels, sample=60)
    raw = np.array([model.raw(quality.features(t)[None])[0] for _, t in rows[:600]])
    bad = sum(i % 4 == 0 for i in range(600)) / 600
    assert math.isclose(model.cut, float(np.quantile(raw, bad)), rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(model.scale, float(raw.std()), rel_tol=1e-9)
    few = quality.fit(docs, labels, sample=60, pairs=50)
    assert not np.allclose(few.w, model.w)


def test_pairwise_model_without_labels_and_with_one_class(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    labels = spark.read.parquet(f"{edge}/labels.parquet")
    for some in (labels.limit(0), labels.withColumn("quality", F.lit(1))):
        out = quality.score(docs, quality.fit(docs, some)).select("__score").distinct().collect()
        assert [r[0] for r in out] == [0.5]


def test_top_k_over_small_blocks_and_repeated_rows(spark, edge):
    v = spark.read.parquet(f"{edge}/embeddings.parquet")
    a = sorted(map(tuple, topk.top_k(v).collect()))
    assert a == sorted(map(tuple, topk.top_k(v.unionByName(v.limit(30)), row_block=16, query_block=2, lists=3).collect()))


def test_top_k_needs_the_entries_beyond_the_named_ones(spark):
    """The best vector leads neither list: only the phases after the cutoff find it."""
    import numpy as np
    import pandas as pd
    k, vecs = 3, {0: [8, 8], 1: [5, 5]}
    vecs |= {10 + i: [9 - i, -9] for i in range(4)} | {20 + i: [-9, 9 - i] for i in range(4)}
    x = pd.DataFrame({"cid": [i for i in vecs if i], "v": [v for i, v in vecs.items() if i]})
    best, whose = topk._named(np.array([[8.0, 8.0]]), x, k, 2)
    assert 1 not in whose and 80 not in best
    i, j = topk._sufficient(topk._parts(np.array([[8.0, 8.0]]), topk._matrix(x["v"]), 2), best.min(axis=1))
    assert 1 in x["cid"].to_numpy()[j]
    df = spark.createDataFrame([(i, [c / 64 for c in v]) for i, v in vecs.items()], "vec_id long, embedding array<double>")
    assert topk.top_k(df, k=k, query_every=1000).first()[:] == (0, 1, 1, 80)


def test_top_k_names_a_vector_once_over_tiles(spark, monkeypatch):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(4)
    x = pd.DataFrame({"cid": np.arange(500), "v": list(rng.integers(-30, 30, (500, 8)))})
    q = rng.integers(-30, 30, (20, 8)).astype(float)
    monkeypatch.setattr(topk, "TILE", 64)
    best, whose = topk._named(q, x, 6, 3)
    full = q @ topk._matrix(x["v"]).T
    for r in range(20):
        assert len(set(whose[r])) == 6 and np.array_equal(full[r, whose[r]], best[r])
    few, none = topk._named(q, x[:2], 6, 3)
    assert np.isfinite(few).sum() == 40


def test_mix_totals_follow_the_budget(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    total = docs.select(mixing.n_words("text").alias("n")).agg(F.sum("n")).first()[0]
    m = mixing.mix(docs, Q.mix_levels(), Q.MIX_WEIGHTS, (3, 2), 4)
    taken = m.agg(F.sum("__take")).first()[0]
    assert 0 <= total * 3 // 2 - taken <= 40  # whole tokens per node: rounded down once a node
    cut = mixing.prefix(m).where("__take < __n").select(mixing.n_words("text").alias("n"), "__take").collect()
    assert all(r["n"] == r["__take"] for r in cut)


def _repeated_rows():
    """Null ids, one id on many rows of equal and of other lengths, and rows equal in every column."""
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    rows = [(None, text(5)) for _ in range(60)] + [(7, text(rng.choice([4, 4, 6]))) for _ in range(80)] + [(9, "one two three")] * 70
    return rows + [(i, text(rng.randint(1, 9))) for i in range(20, 60)]


def _draw(df, budget, epochs, ranked):
    m = mixing.mix(df, {"all": F.lit("x")}, {}, budget, epochs, ranked=ranked)
    return sorted(tuple(map(str, r)) for r in m.collect())


@pytest.mark.parametrize("budget", [(1, 5), (1, 2), (3, 4), (7, 5)])
def test_mix_draws_the_same_rows_however_they_arrive(spark, budget):
    rows = _repeated_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = _draw(df.repartition(1), budget, 2, 4096)
    total = sum(len(t.split()) for _, t in rows)
    assert sum(int(r[3]) for r in want) == total * budget[0] // budget[1]
    for parts, ranked in ((7, 4096), (31, 3), (1, 1)):
        mixed = list(rows)
        random.Random(parts).shuffle(mixed)
        assert _draw(spark.createDataFrame(mixed, "doc_id long, text string").repartition(parts), budget, 2, ranked) == want


OWN = {"line_dedup": linedup.RESULT, "decontaminate": decontam.RESULT, "pii": ("__base", "__added"), "quality": ("__score",), "mix": ("__epoch", "__take", "__n"),
       "lm": ngram_lm.RESULT}
WORK = ("__row", "__doc", "__text", "__drops", "__spans", "__levels", "__tail", "__times", "__known", "tk", "tb", "__ident", "__whole", "__edge", "__need", "__open",
        "__order", "__content", "__seen", "__copy", "__level_a", "__level_a_p", "__rest", "__b", "__cap", "__w", "__key", "__bucket", "doc", "comp", "first", "last", "n", "h", "h1", "id")


@pytest.mark.parametrize("name", sorted(OWN))
def test_clashing_columns_pass_through(spark, edge, name):
    """Every working name comes back as it was, a result's name with underscores behind."""
    plain = spark.read.parquet(f"{edge}/documents.parquet").select("doc_id", "text")
    items, labels = (spark.read.parquet(f"{edge}/{t}.parquet") for t in ("benchmark", "labels"))
    extra = [c for c in dict.fromkeys([*WORK, *OWN[name], OWN[name][0].upper() + "_"])]
    docs = plain.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in extra})
    run = {"line_dedup": linedup.dedup_lines, "decontaminate": lambda d: decontam.match_items(d, items), "pii": pii.find_pii,
           "quality": lambda d: quality.score(d, quality.fit(d, labels)), "mix": lambda d: mixing.mix(d, {"a": F.col("doc_id") % 2}, {}),
           "lm": lambda d: ngram_lm.score_texts(d, F.col("__row").isNotNull() if "__row" in d.columns else F.lit(True))}[name]
    got, want = run(docs), run(plain)
    own = [c for c in want.columns if c not in docs.columns or c in OWN[name]]
    assert set(want.columns) <= set(got.columns) and len(got.columns) == len(want.columns) + len(extra)
    show = lambda df: sorted(map(str, df.select("doc_id", *own).collect()))
    assert show(got) == show(want)
    for r in got.collect():
        row = r.asDict()
        for c in extra:
            at = c if c not in OWN[name] else next(k for k in row if k.lower().startswith(c.lower() + "_") and k not in extra)
            assert row[at] == f"{c}{row['doc_id']}", (c, at)
