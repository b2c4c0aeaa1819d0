"""The named queries of the operators and, where SQL can express them, their
DuckDB oracles.  Each query applies its operator to the whole table and derives
the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm import decontam, forest, importance, langid, linedup, mixing, neardup, ngram_lm, pii, quality, topk, trie, urlfilter
from voxpop.llm.textkit import remainder, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# op1: the production tree, weights, budget and epochs
DOMAIN = "CASE WHEN source IS NULL THEN NULL WHEN right(source, 1) IN ('0', '1', '2', '3', '4') THEN 'web' WHEN right(source, 1) IN ('5', '6', '7') THEN 'books' ELSE 'other' END"
MIX_WEIGHTS = {"domain": {"web": 5, "books": 3, "other": 2}, "lang": {"en": 6, "de": 2, "fr": 2}, "source": {"src0": 2}}
# the budget fills leaves and whole languages: their siblings, then the siblings of their parents take the rest
MIX_BUDGET, MIX_EPOCHS, MIX_SEED = (3, 2), 2, 7


def mix_levels() -> dict:
    return {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}


def _mix_sql() -> str:
    names = list(MIX_WEIGHTS)
    weight = {c: "CASE " + " ".join(f"WHEN {c} = '{k}' THEN {v}" for k, v in w.items()) + " ELSE 1 END" for c, w in MIX_WEIGHTS.items()}
    ctes = [f"""d AS (SELECT doc_id, lang, source, {DOMAIN} AS domain,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n FROM documents)""",
            "t AS (SELECT * FROM d WHERE n > 0)",
            f"l AS (SELECT {', '.join(names)}, CAST(sum(n) AS BIGINT) AS tok FROM t GROUP BY ALL)",
            f"n0 AS (SELECT least(CAST(sum(tok) AS BIGINT) * {MIX_BUDGET[0]} // {MIX_BUDGET[1]}, CAST(sum(tok) AS BIGINT) * {MIX_EPOCHS}) AS b FROM l)"]
    for i, c in enumerate(names):
        keys, up = ", ".join(names[:i + 1]), names[:i]
        on = " AND ".join(f"k.{u} IS NOT DISTINCT FROM p.{u}" for u in up) or "TRUE"
        by = "PARTITION BY " + (", ".join(up) or "1")
        ctes += [f"k{i} AS (SELECT {keys}, CAST(sum(tok) AS BIGINT) AS tok, CAST(sum(tok) AS BIGINT) * {MIX_EPOCHS} AS cap, {weight[c]} AS w FROM l GROUP BY ALL)",
                 f"j{i} AS (SELECT k.*, p.b AS pb FROM k{i} k JOIN n{i} p ON {on})",
                 f"""o{i} AS (SELECT *, coalesce(sum(cap) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
                     sum(w) OVER (s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS frm FROM j{i}
                     WINDOW s AS ({by} ORDER BY CAST(cap AS DOUBLE) / w, {c} NULLS FIRST))""",
                 f"f{i} AS (SELECT *, cap * frm <= w * (pb - bef) AS f FROM o{i})",
                 f"g{i} AS (SELECT *, pb - sum(CASE WHEN f THEN cap ELSE 0 END) OVER ({by}) AS rest, sum(CASE WHEN f THEN 0 ELSE w END) OVER ({by}) AS opn FROM f{i})",
                 f"n{i + 1} AS (SELECT {keys}, tok, CAST(CASE WHEN f THEN cap ELSE w * rest // opn END AS BIGINT) AS b FROM g{i})"]
    on = " AND ".join(f"t.{c} IS NOT DISTINCT FROM p.{c}" for c in names)
    ctes += [f"m AS (SELECT t.*, p.b // p.tok AS e, p.b % p.tok AS r FROM t JOIN n{len(names)} p ON {on})",
             f"q AS (SELECT *, sum(n) OVER (PARTITION BY {', '.join(names)} ORDER BY md5('{MIX_SEED}:' || e || ':' || doc_id), doc_id, n) - n AS bef FROM m)"]
    cols = "doc_id, domain, lang, source"
    return f"""WITH {', '.join(ctes)}
SELECT {cols}, unnest(range(0, CAST(e AS BIGINT))) AS epoch, n AS take_tokens, n AS n_tokens FROM m
UNION ALL SELECT {cols}, e, CAST(least(n, r - bef) AS BIGINT), n FROM q WHERE bef < r"""


@query("op1_mixing", _mix_sql())
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", mixing.n_words("text").alias("n_tokens"))
    m = mixing.mix(docs, mix_levels(), MIX_WEIGHTS, MIX_BUDGET, MIX_EPOCHS, MIX_SEED, n_tokens=F.col("n_tokens"))
    return m.select("doc_id", F.expr(DOMAIN).alias("domain"), "lang", "source", F.col("__epoch").alias("epoch"), F.col("__take").alias("take_tokens"), "n_tokens")


@query("op2_lm_scoring")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (remainder("doc_id", 7) == 2).alias("held_out"))
    out = ngram_lm.score_texts(docs, ~F.col("held_out"))
    return out.select("doc_id", "held_out", *[F.col(f"__{c}").alias(c) for c in ("n_tokens", "n_known", "train_tokens")],
                      F.col("__base").alias("base_score"), F.col("__score").alias("score"))


@query("op3_near_dedup")
def op3(spark, sf_dir):
    d = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return d.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), (F.col("doc") == F.col("comp")).alias("kept"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % (UPPER, LOWER)


@query("op4_decontamination", f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM (
    SELECT item_id, w, least(len(w), {decontam.WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {decontam.WINDOW}) + 2)) AS i FROM b WHERE len(w) > 0) x),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n) x),
hit AS (SELECT o.doc_id, o.i, o.n, win.item_id FROM occ o JOIN win ON win.n = o.n AND win.g = o.g),
pos AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit) y) z GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) y GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = decontam.match_items(docs, table(spark, sf_dir, "benchmark"))
    return hit.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"), F.size("__items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"), (F.col("__n_hit") > 0).alias("contaminated"))


def _url_sql() -> str:
    rules = ", ".join(f"({i}, '{r.verdict}', '{r.host}', '{r.path}')" for i, r in enumerate(urlfilter.RULES))
    bad = " OR ".join(f"contains(host, '{w}')" for w in urlfilter.BAD_WORDS)
    return f"""WITH u AS (SELECT page_id, CASE WHEN coalesce(instr(url, '://'), 0) > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
r(k, v, rh, rp) AS (VALUES {rules}),
f AS (SELECT page_id, arg_min(rh || rp, (-length(rh || rp), k)) AS rule, arg_min(v, (-length(rh || rp), k)) AS v FROM h, r
      WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT h.page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN v WHEN {bad} THEN 'block' ELSE 'allow' END AS verdict FROM h LEFT JOIN f USING (page_id)"""


@query("op5_url_filter", _url_sql())
def op5(spark, sf_dir):
    return urlfilter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op6_language_id")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.identify(docs, remainder("doc_id", 5) != 0)
    return out.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


_STRIP = r"translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '%s', '%s')" % (UPPER, LOWER)


@query("op7_line_dedup", f"""WITH l AS (SELECT doc_id, line, k, {_STRIP} AS key FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM documents) x),
r AS (SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= {linedup.MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT l.*, coalesce(l.doc_id <> r.first, FALSE) AS gone FROM l LEFT JOIN r ON l.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id""")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linedup.dedup_lines(docs)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])
    keyed = F.transform(spans, lambda x: F.struct(x["start"].alias("a"), F.array_position(kinds, x["kind"]).alias("k"), x["end"].alias("b"), x["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: F.concat_ws(":", x["kind"], x["a"].cast("string"), x["b"].cast("string"))), ",")


@query("op8_pii")
def op8(spark, sf_dir):
    out = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of_kind = lambda k: F.size(F.filter("__base", lambda x: x["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{k}") for k in pii.KINDS]
    return out.select("doc_id", *counts, F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"), _listed(F.concat("__base", "__added")).alias("spans"))


CUT = 0.3


@query("op9_quality")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs.where(remainder("doc_id", 5) != 0), table(spark, sf_dir, "labels"), cut_score=CUT)
    out = quality.score(docs, model).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), F.col("__score").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


@query("op10_top_k", f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, v AS qv FROM v WHERE vec_id % 20 = 0),
s AS (SELECT query_id, vec_id, CAST(list_inner_product(qv, v) AS BIGINT) AS score FROM q, v WHERE vec_id <> query_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {topk.K}""")
def op10(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def _crc_sql(digits: str) -> str:
    """crc32 of the bytes whose hex digits are given, half a byte at a time."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    half = lambda x: f"xor(({x}) >> 4, ({table}::BIGINT[])[(({x}) & 15) + 1])"
    octets = f"list_transform(range(0, length({digits}) // 2), lambda i: CAST('0x' || substr({digits}, 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, b: {half(half('xor(c, b)'))}), 4294967295)"


def _resample_sql() -> str:
    grams = " UNION ALL ".join(f"SELECT id, array_to_string(list_slice(w, i, i + {n}), ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - {n} + 1)) AS i FROM {{0}} WHERE len(w) > {n}) x" for n in range(3))
    return f"""WITH d AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS id, {_WORDS} AS w FROM benchmark),
fd AS ({grams.format('d')}), fb AS ({grams.format('b')}),
hexed AS MATERIALIZED (SELECT g, hex(encode(g)) AS x FROM (SELECT g FROM fd UNION SELECT g FROM fb) y),
crc AS MATERIALIZED (SELECT g, {_crc_sql('x')} % 10000 AS bucket FROM hexed),
s AS (SELECT bucket, CAST(count(*) AS BIGINT) AS n FROM fd JOIN crc USING (g) GROUP BY bucket),
t AS (SELECT bucket, CAST(count(*) AS BIGINT) AS n FROM fb JOIN crc USING (g) GROUP BY bucket),
gain AS (SELECT k.bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM s) + 10000 AS DOUBLE)
    / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM range(10000) k(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
w AS (SELECT id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM fd JOIN crc USING (g) JOIN gain USING (bucket) GROUP BY id),
r AS (SELECT d.id, doc_id, len(w) AS words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM d LEFT JOIN w ON d.id = w.id),
o AS (SELECT id, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM r WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= 5 * (SELECT count(*) FROM o) // 100 THEN CAST(k AS BIGINT) END AS rank FROM r LEFT JOIN o USING (id)"""


@query("op13_resampling", _resample_sql())
def op13(spark, sf_dir):
    out = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def _trie_sql() -> str:
    return f"""WITH c AS (SELECT conv_id, {_crc_sql('hex(encode(CAST(conv_id AS VARCHAR)))')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL) x),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
    md5(coalesce(role, '')) || md5(coalesce(text, '')) AS id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations),
r AS (SELECT c.conv_id, 0 AS own, k, id, words FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 WHERE k <= h
    UNION ALL SELECT c.conv_id, 1, k, id, words FROM c JOIN t ON t.conv_id = c.conv_id WHERE k > h),
p AS (SELECT conv_id, row_number() OVER o AS depth, words, string_agg(id, '') OVER o AS node FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY own, k ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words FROM p GROUP BY node, depth),
kids AS (SELECT left(node, -64) AS node, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
up AS (SELECT left(node, 64 * i) AS node, sum(CAST(NOT EXISTS (SELECT 1 FROM kids WHERE kids.node = x.node) AS BIGINT)) AS leaves, sum((n_convs - 1) * words) AS saved
    FROM (SELECT node, n_convs, words, unnest(range(0, depth + 1)) AS i FROM n) x GROUP BY 1),
e AS (SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, arg_max(node, depth) AS node FROM p GROUP BY conv_id) x GROUP BY node)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children, CAST(up.leaves AS BIGINT) AS n_leaves,
    CAST(up.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n LEFT JOIN n u ON n.depth > 0 AND u.node = left(n.node, -64) LEFT JOIN kids ON kids.node = n.node JOIN up ON up.node = n.node LEFT JOIN e ON e.node = n.node"""


@query("op11_prefix_trie", _trie_sql())
def op11(spark, sf_dir):
    out = trie.conversation_trie(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@query("op12_neighbours")
def op12(spark, sf_dir):
    return forest.nearest_neighbours(table(spark, sf_dir, "embeddings"))
