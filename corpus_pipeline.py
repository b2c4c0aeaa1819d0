"""The training-corpus pipeline: five stages over ``documents``, each one of the
operators of ``voxpop.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``; the last adds ``epoch``, ``take_tokens``
and ``n_tokens``.  Null texts, repeated rows, extra columns and empty tables are
treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm import decontam, linedup, mixing, neardup, quality
from voxpop.llm.queries import CUT, MIX_BUDGET, MIX_EPOCHS, MIX_SEED, MIX_WEIGHTS, mix_levels
from voxpop.llm.textkit import apart, remainder, restored, saved, table


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below its cut go."""
    model = quality.fit(docs.where(remainder("doc_id", 5) != 0), table(spark, sf_dir, "labels"), cut_score=CUT)
    kept = quality.score(docs, model).where(F.col("__score") >= CUT).drop("__score")
    return restored(kept, docs.columns, "__score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat across documents stay in the first of them only."""
    return _measured(restored(linedup.dedup_lines(docs).drop(*linedup.RESULT), docs.columns, *linedup.RESULT))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.  Of
    rows that repeat an id the one with the greatest text (that which the operator
    compares) stays, equal texts by their other columns; rows with a null id are
    no documents to it and stay all."""
    groups = neardup.near_duplicates(docs)
    gone = saved(groups.where("doc <> comp").select(F.col("doc").alias("__gone")), "near-gone")
    if not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
        one = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.struct("text", *rest)).alias("__row"))
        named = one.select("doc_id", "__row.*").select(*docs.columns)
        docs = named.unionByName(docs.where("doc_id is null"))
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go."""
    return _measured(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The leaves' token prefixes at the target weights, with their texts.  A column
    of ``docs`` called like an added one gets underscores behind its name."""
    docs = apart(docs, "epoch", "take_tokens", "n_tokens")
    mixed = mixing.mix(docs, mix_levels(), MIX_WEIGHTS, MIX_BUDGET, MIX_EPOCHS, MIX_SEED)
    added = {"__epoch": "epoch", "__take": "take_tokens", "__n": "n_tokens"}
    return restored(mixing.prefix(mixed).withColumnsRenamed(added), docs.columns, *added)


STAGES = [("quality", quality_filter), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("mix", mix_sources)]

# a trained classifier decides the first stage, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
