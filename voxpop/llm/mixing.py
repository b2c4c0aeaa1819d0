"""Mixing sources to target weights, with DataFrame functions only.

The labels of ``levels`` (domain, language, source) form a tree.  Every node
has an integer weight among its siblings and, bottom-up, a capacity: its
tokens times ``max_epochs``.  Budgets flow top-down; among siblings a child
gets its weight's share, a child that cannot fill its share gets its capacity,
and what it lacks is dealt among its siblings by weight.  Only when all
children of a node are full is the node itself short, so its own siblings (the
ancestors' level) take over the rest.

A leaf's budget is whole epochs of all its documents plus a prefix, in tokens,
of one more epoch in seeded order.  The order is a string of digits: the seeded
key, the document's tokens, a hash of its columns.  The prefix is found from
token sums by leading digits, 4,096 buckets a leaf at first; the boundary bucket
is cut by further digits until it holds few enough rows to rank.  Buckets below
the boundary are taken whole, so no leaf - however large, and whatever ids
repeat in it - is sorted or gathered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxpop.llm.textkit import moved, saved

WORDS = r"[^\x20\x09-\x0D]+"
WIDE = "decimal(38,0)"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def _weight(name: str, weights: Mapping[str, int], default: int) -> Column:
    w = F.lit(default)
    for value, x in weights.items():
        w = F.when(F.col(name) == F.lit(value), F.lit(x)).otherwise(w)
    return w.cast("long")


def _share(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Budgets of siblings: ``__cap``, ``__w`` and the parent's ``__b`` -> ``__budget``."""
    by = Window.partitionBy(*[F.col(c) for c in parent]) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy((F.col("__cap").cast("double") / F.col("__w")).asc(), F.col(name).asc_nulls_first())
    wide = lambda c: F.col(c).cast(WIDE)
    x = (children
         .withColumn("__before", F.coalesce(F.sum("__cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("__from", F.sum("__w").over(order.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("__full", wide("__cap") * wide("__from") <= wide("__w") * (wide("__b") - wide("__before")))
         .withColumn("__rest", F.col("__b") - F.sum(F.when(F.col("__full"), F.col("__cap")).otherwise(0)).over(by))
         .withColumn("__open", F.sum(F.when(F.col("__full"), 0).otherwise(F.col("__w"))).over(by)))
    part = F.expr("cast(cast(__w as decimal(19,0)) * cast(__rest as decimal(19,0)) div __open as long)")
    return x.withColumn("__budget", F.when(F.col("__full"), F.col("__cap")).otherwise(part))


def budgets(tokens: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], budget: tuple[int, int],
            max_epochs: int, default_weight: int = 1) -> DataFrame:
    """One row per leaf: ``levels``, ``__tokens``, ``__budget``.

    ``tokens`` has the levels and ``__n``; ``budget`` is a fraction (numerator,
    denominator) of all tokens.  A null label is a label of its own.  A node of
    weight 0 gets nothing."""
    leaves = tokens.groupBy(*levels).agg(F.sum("__n").alias("__tokens"))
    live = F.lit(True)
    for c in levels:
        live = live & (_weight(c, weights.get(c, {}), default_weight) > 0)
    leaves = saved(leaves.where("__tokens > 0").where(live), "mix-leaves")
    num, den = budget
    node = leaves.agg(F.least(F.expr(f"cast(cast(coalesce(sum(__tokens), 0) as decimal(38,0)) * {int(num)} div {int(den)} as long)"),
                              F.coalesce(F.sum("__tokens"), F.lit(0)) * max_epochs).alias("__b"))
    for d, name in enumerate(levels):
        kids = leaves.groupBy(*levels[:d + 1]).agg((F.sum("__tokens") * max_epochs).alias("__cap"), F.sum("__tokens").alias("__tokens"))
        kids = kids.withColumn("__w", _weight(name, weights.get(name, {}), default_weight))
        if d:
            up = node.select(*[F.col(c).alias(f"__up_{c}") for c in levels[:d]], F.col("__budget").alias("__b"))
            cond = F.lit(True)
            for c in levels[:d]:
                cond = cond & kids[c].eqNullSafe(up[f"__up_{c}"])
            kids = kids.join(up, cond).drop(*[f"__up_{c}" for c in levels[:d]])
        else:
            total = node.select("__b")
            kids = kids.withColumn("__b", total.scalar())
        node = _share(kids, levels[:d], name).select(*levels[:d + 1], "__tokens", "__cap", "__budget")
    return node.select(*levels, "__tokens", "__budget")


# Positions in a row's order: 32 digits of the seeded key, 12 of its tokens, 32 of
# its content.  The boundary is refined from one step to the next.
KEY, SIZE, FULL = 32, 12, 76
STEPS = (3, 6, 9, KEY, KEY + SIZE, KEY + SIZE + 3, KEY + SIZE + 6, KEY + SIZE + 9, FULL)
RANKED = 4096  # rows of a leaf that one task ranks


def _order(seed: int, content: Column | None = None) -> Column:
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__whole").cast("string"), F.col("__ident")))
    size = F.lpad(F.col("__n").cast("string"), SIZE, "0")
    return F.concat(key, size) if content is None else F.concat(key, size, content)


def _boundaries(narrow: DataFrame, rows: DataFrame, content: Column, plan: DataFrame, names: Sequence[str], seed: int, ranked: int) -> tuple[DataFrame, int]:
    """``plan`` with ``__edge``, the leading digits of the order at which a leaf's last
    epoch ends, and ``__need``, the tokens to take among the rows that begin so.
    Digits are added where more than ``ranked`` rows begin so.  Also the number of
    digits looked at."""
    mine = [F.col(c).eqNullSafe(F.col(f"{c}_p")) for c in names]
    state = plan.select(*[F.col(c).alias(f"{c}_p") for c in names], "__whole", F.when(F.col("__rest") > 0, F.lit("")).alias("__edge"),
                        F.col("__rest").alias("__need"), (F.col("__rest") > 0).alias("__open"))
    for upto in STEPS:
        rows_of = narrow if upto <= KEY + SIZE else rows
        order = _order(seed) if upto <= KEY + SIZE else _order(seed, content)
        part = rows_of.join(state.where("__open"), _all(mine)).withColumn("__order", order).where("startswith(__order, __edge)")
        sums = (part.groupBy(*[f"{c}_p" for c in names], "__whole", "__need", F.substring("__order", 1, upto).alias("__edge"))
                .agg(F.sum("__n").alias("__sum"), F.count("*").alias("__rows")))
        upward = Window.partitionBy(*[f"{c}_p" for c in names]).orderBy("__edge")
        edge = (sums.withColumn("__cum", F.sum("__sum").over(upward)).where("__cum >= __need and __cum - __sum < __need")
                .select(*[f"{c}_p" for c in names], "__whole", "__edge", F.expr("__need - __cum + __sum").alias("__need"), (F.col("__rows") > ranked).alias("__open")))
        state = saved(state.where("not __open").unionByName(edge), "mix-edges")
        if state.where("__open").isEmpty():
            break
    return state.drop("__open"), upto


def mix(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]], budget: tuple[int, int] = (1, 2),
        max_epochs: int = 4, seed: int = 7, doc_id: str = "doc_id", n_tokens: Column | None = None, ranked: int = RANKED) -> DataFrame:
    """Rows of ``docs`` drawn to the target weights, once per epoch in which they
    are drawn, with ``__epoch`` and ``__take`` (how many of the document's
    leading tokens belong to the mix; fewer than all only for the last one of a
    leaf's last epoch) and ``__n`` (its tokens).

    ``levels`` maps level names, root first, to expressions over ``docs``.
    Documents without tokens (null or empty text) are never drawn; null labels
    are labels of their own; rows sharing an id are drawn one after the other
    in order of length, then of a hash of all their columns, so the rows drawn
    do not depend on partitions; a row without an id is ordered by that hash in
    the id's place; rows equal in all columns are drawn as often as their number
    says.  An empty table gives an empty mix.  All columns of ``docs`` pass
    through; one called like a result column gets underscores behind its name.
    """
    names, fresh = [f"__level_{k}" for k in levels], ("__epoch", "__take", "__n")
    away = moved(docs.columns, [*fresh, *names, *[f"{c}_p" for c in names], "__ident", "__whole", "__edge", "__need", "__open", "__order", "__content", "__seen", "__copy"])
    content = lambda cols: F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols])))
    ident = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("null:"), content(docs.columns)))
    mine = [F.col(f"`{c}`").alias(away.get(c, c)) for c in docs.columns]
    rows = docs.select(*mine, ident.alias("__ident"), (n_words("text") if n_tokens is None else n_tokens.cast("long")).alias("__n"),
                       *[v.alias(c) for c, v in zip(names, levels.values())]).where("__n > 0")
    tie = content([away.get(c, c) for c in docs.columns])
    narrow = saved(rows.select("__ident", "__n", *names), "mix-tokens")
    plan = saved(budgets(narrow, names, {f"__level_{k}": v for k, v in weights.items()}, budget, max_epochs)
                 .withColumn("__whole", F.expr("__budget div __tokens")).withColumn("__rest", F.expr("__budget % __tokens"))
                 .where("__budget > 0"), "mix-plan")
    plan, digits = _boundaries(narrow, rows, tie, plan, names, seed, ranked)
    drawn = rows.join(plan, _all([F.col(c).eqNullSafe(F.col(f"{c}_p")) for c in names]))
    deep = F.length("__edge") > KEY + SIZE  # never of a leaf without a last epoch in part: its edge is null
    drawn = drawn.withColumn("__order", F.when(deep, _order(seed, tie)).when(F.col("__edge").isNotNull(), _order(seed)))
    # the whole epochs and, below the boundary, one more: one scan
    whole = (drawn.withColumn("__epoch", F.expr("__whole + if(substring(__order, 1, length(__edge)) < __edge, 1L, 0L)")).where("__epoch > 0")
             .withColumn("__epoch", F.explode(F.expr("sequence(0L, __epoch - 1)"))).withColumn("__take", F.col("__n")))
    at = drawn.where("startswith(__order, __edge)").withColumn("__epoch", F.col("__whole"))
    run = Window.partitionBy(*names).orderBy("__order", "__content").rowsBetween(Window.unboundedPreceding, -1)
    few = (at.where(F.length("__edge") < FULL).withColumn("__content", tie).withColumn("__seen", F.coalesce(F.sum("__n").over(run), F.lit(0)))
           .where("__seen < __need").withColumn("__take", F.least(F.col("__n"), F.col("__need") - F.col("__seen"))))
    cols = [*[F.col(f"`{away.get(c, c)}`").alias(away[c] if c.lower() in fresh else c) for c in docs.columns], *fresh]
    out = whole.select(*cols).unionByName(few.select(*cols))
    if digits == FULL:  # more than ``ranked`` rows equal in every column: one of them, as often as the need says
        same = (at.where(F.length("__edge") == FULL).dropDuplicates(names).withColumn("__copy", F.explode(F.expr("sequence(0L, (__need - 1) div __n)")))
                .withColumn("__take", F.expr("least(__n, __need - __copy * __n)")))
        out = out.unionByName(same.select(*cols))
    return out


def _all(conds: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def prefix(mixed: DataFrame, text: str = "text") -> DataFrame:
    """``mixed`` with the text of a document that is drawn in part cut to its
    leading ``__take`` tokens, joined by one space."""
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(WORDS), F.lit(0)), F.lit(1), F.col("__take").cast("int")), " ")
    return mixed.withColumn(text, F.when(F.col("__take") < F.col("__n"), cut).otherwise(F.col(text)))
