"""Registry of the named report queries and their oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` built from the library
operators over the supplied tables.  Doubles are rounded to 6 decimals in the
report (float sums are not bit-identical across engines); the oracle SQL
rounds the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6


def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), DIGITS).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def rounded(sql: str, doubles: str | list[str]) -> str:
    """Wrap oracle SQL so the named double columns are rounded like ``finish``."""
    names = doubles.split() if isinstance(doubles, str) else list(doubles)
    if not names:
        return sql
    rep = ", ".join(f'round("{c}", {DIGITS}) AS "{c}"' for c in names)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"


def register(name: str, sql: str | None = None, doubles: str | list[str] = ""):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: finish(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = rounded(sql, doubles)
        return fn
    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from voxpop.plans import q_io, q_model, q_profile, q_stats, q_summary  # noqa: F401
