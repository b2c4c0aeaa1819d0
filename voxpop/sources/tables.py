"""Sources and sinks: the supplied TPC-H-ish tables, the order-level base
derived from them, and CSV/Parquet readers/writers for the analysis tables.

The base (one row per order) is derived with joins, one aggregation and one
window.  Plan notes, per stage:

* ``orders ⟕ lineitem`` is joined on the order key and aggregated on the same
  key, so the aggregation reuses the join's hash partitioning (no 2nd shuffle).
* The 30-day repurchase flag needs "next order of the same customer".  A
  window partitioned by customer would put a hot customer (a third of all
  orders) into one task; instead orders are first reduced to one row per
  (customer, day) — at most the number of distinct days per customer — and
  the window runs over that.
* The region comes from ``customer ⋈ nation ⋈ region`` and is attached to
  that (customer, day) table, which the window has already hash-partitioned
  by customer: only the customer table moves, and a hot customer contributes
  one row per day, not one per order.  Nation and region are the fixed
  25/5-row dimensions, broadcast only after a size check.
* The order rows then meet the (customer, day) rows in ONE join on both keys;
  hashing on (customer, day) spreads a hot customer over many tasks, so no
  fact-sized shuffle is keyed on the customer alone.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxpop.schema import ORDERS_NPS_SCHEMA, BASE_COLUMNS
from voxpop.session import checkpoint_root

# broadcast a dimension only when its row count is below this bound
BROADCAST_MAX_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only behind a checked size bound (a bounded count job)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    geo = nation.join(broadcast_if_small(region), nation.n_regionkey == region.r_regionkey)
    geo = geo.select(F.col("n_nationkey"), F.col("r_name"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (cust.join(broadcast_if_small(geo), cust.c_nationkey == geo.n_nationkey, "left")
            .select(F.col("c_custkey"), F.col("r_name")))


def derive_orders_nps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-level satisfaction base from orders/lineitem/customer/nation/region."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linenumber", "l_shipdate")

    qty = F.col("l_quantity").cast("bigint")
    cents = lambda rate: F.floor(F.col("l_extendedprice") * F.col(rate) * 100).cast("bigint")
    has_line = F.col("l_orderkey").isNotNull()

    per_order = (
        o.join(li, o.o_orderkey == li.l_orderkey, "left")
        .groupBy("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        .agg(
            F.sum(qty).alias("_qty"),
            F.sum(cents("l_discount")).alias("_disc_cents"),
            F.sum(cents("l_tax")).alias("_tax_cents"),
            F.max(qty).alias("_max_qty"),
            F.sum(F.when(F.col("l_shipdate") > F.col("o_orderdate"), 1).when(has_line, 0)).alias("_late"),
            F.sum(F.when(F.col("l_discount") >= 0.07, 1).when(has_line, 0)).alias("_disc_lines"),
            F.sum("l_linenumber").alias("_lines"),
            F.sum(F.when(F.col("l_returnflag") == "R", 1).when(has_line, 0)).alias("_returns"),
        )
    )

    # next order day per customer, over one row per (customer, day)
    day = (o.groupBy("o_custkey", "o_orderdate")
           .agg(F.max("o_orderkey").alias("_day_max_key")))
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate")
    day = day.withColumn("_next_day", F.lead("o_orderdate").over(w))
    day = (day.join(customer_regions(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "left")
           .drop("c_custkey"))

    b = per_order.join(day, ["o_custkey", "o_orderdate"], "left")

    z = lambda c: F.coalesce(c, F.lit(0))
    delay = z(F.col("_late")).cast("int")
    complaints = z(F.col("_returns")).cast("int")
    contacts = z(F.col("_disc_lines")).cast("int")
    key = F.col("o_orderkey")

    def clipped_score(expr):
        return (F.greatest(F.lit(0), F.least(F.lit(100), expr)) / F.lit(10.0))

    repeat = ((key < F.col("_day_max_key"))
              | (F.col("_next_day") <= F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")))

    out = b.select(
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        (F.lit(18) + F.col("o_custkey") % 58).cast("int").alias("customer_age"),
        F.col("r_name").alias("customer_region"),
        ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("int")
        .alias("customer_tenure_months"),
        key.cast("bigint").alias("order_id"),
        F.col("o_totalprice").cast("double").alias("order_value"),
        z(F.col("_qty")).cast("int").alias("items_quantity"),
        (z(F.col("_disc_cents")) / F.lit(100.0)).alias("discount_value"),
        (F.lit(1) + key % 12).cast("int").alias("payment_installments"),
        z(F.lit(1) + F.col("_max_qty") % 20).cast("int").alias("delivery_time_days"),
        delay.alias("delivery_delay_days"),
        (z(F.col("_tax_cents")) / F.lit(100.0)).alias("freight_value"),
        (F.lit(1) + key % 3).cast("int").alias("delivery_attempts"),
        contacts.alias("customer_service_contacts"),
        z(F.col("_lines") % 15).cast("int").alias("resolution_time_days"),
        clipped_score(F.lit(105) - 12 * delay - 9 * complaints - 6 * contacts
                      + (key * 7919) % 31 - 15).alias("nps_score"),
        F.coalesce(repeat, F.lit(False)).cast("int").alias("repeat_purchase_30d"),
        complaints.alias("complaints_count"),
        clipped_score(F.lit(100) - 6 * delay - 5 * complaints
                      + (key * 7817) % 41 - 20).alias("csat_internal_score"),
    )
    return out.select(*BASE_COLUMNS)


BASE_TABLES = ["orders", "lineitem", "customer", "nation", "region"]
_BASE_CACHE: dict[tuple[str, str], str] = {}


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, length and modification time of every file at or under ``path``."""
    fs, jpath = _file_system(spark, path)
    found, it = [], fs.listFiles(jpath, True)
    while it.hasNext():
        f = it.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def load_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived base, written once per application under the shared
    checkpoint folder and read back as Parquet (filter pushdown, column
    pruning, lineage cut, survives executor loss).  Input files that have been
    rewritten since (name, length or time) give a new base, in a fresh folder."""
    sf_dir = os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir
    state = [f for t in BASE_TABLES for f in _files(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")]
    key = (spark.sparkContext.applicationId, hashlib.sha256(repr(state).encode()).hexdigest())
    path = _BASE_CACHE.get(key)
    if path is None:
        path = f"{checkpoint_root(spark)}/voxpop_base/{key[0]}/{uuid.uuid4().hex}/orders_nps"
        derive_orders_nps(spark, sf_dir).write.parquet(path)
        _BASE_CACHE[key] = path
    return spark.read.schema(ORDERS_NPS_SCHEMA).parquet(path)


# ---------------------------------------------------------------------------
# IO1 - IO6
# ---------------------------------------------------------------------------

def read_orders(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """IO1: base table with the declared schema (no inference).

    CSV columns are taken by their header names, in any order; a missing column
    is an error.  Integers may be written as ``3`` or ``3.0``; text that is no
    number becomes NULL and is counted by ``unparsed_orders``."""
    if fmt == "csv":
        raw = _orders_text(spark, path)
        df = raw.select(*[_parsed(f).alias(f.name) for f in ORDERS_NPS_SCHEMA.fields])
    else:
        df = spark.read.schema(ORDERS_NPS_SCHEMA).format(fmt).load(path)
    return _without_nan(df)


def _without_nan(df: DataFrame) -> DataFrame:
    """NaN is ordered above every number in Spark; treat it as missing."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double"))
                           for c, t in df.dtypes if t == "double"})


def _orders_text(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    missing = [c for c in BASE_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return raw


def _parsed(field) -> Column:
    return _parsed_text(field, F.col(field.name))


def _parsed_text(field, text: Column) -> Column:
    kind = field.dataType.simpleString()
    if kind in ("string", "double"):
        return text if kind == "string" else text.try_cast("double")
    # as written first: large keys lose digits on the way through DOUBLE
    return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))


def _unparsed(field, text: Column) -> Column:
    """A value is there, but no number."""
    return _parsed_text(field, text).isNull() & (F.trim(text) != "") & (F.lower(F.trim(text)) != "nan")


def unparsed_orders(spark: SparkSession, path: str) -> DataFrame:
    """One row: per column, how many non-blank CSV values are no number."""
    raw = _orders_text(spark, path)
    return raw.agg(*[F.count(F.when(_unparsed(f, F.col(f.name)), 1)).alias(f.name) for f in ORDERS_NPS_SCHEMA.fields])


def _text_parsed(names: list[str], line: str) -> Column:
    """The texts of a CSV line as columns; ``_bad`` holds the line when its number
    of fields differs.  A generator: the line is parsed once, however often its
    columns are named later (a struct would be parsed anew for each of them)."""
    schema = ", ".join(f"`{c}` string" for c in names) + ", _bad string"
    return F.inline(F.array(F.from_csv(F.col(line), F.lit(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})))


def read_orders_checked(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """IO1 with a quarantine: the clean orders, and ``file``, ``line`` (from 1),
    ``column``, ``text``, ``record`` of every fault.

    A record with too few or too many fields is one fault (``column`` NULL,
    ``text`` the record); a value that does not parse is one for its column.  Every
    line but headers and blank ones is either clean or quarantined.  ``columns``
    names the fields of files without a header.  Line numbers come from one count
    a file split, not from a sort."""
    columns = columns or _orders_text(spark, path).columns
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.input_file_block_start().alias("_block"),
                                         F.monotonically_increasing_id().alias("_id"))
    blocks = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = F.sum("_lines").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))  # one row a split
    blocks = blocks.withColumn("_before", F.coalesce(before, F.lit(0))).withColumnsRenamed({"file": "_f", "_block": "_b"})
    names = [f"_c{i}" for i in range(len(columns))]
    text = {c.lower(): F.col(n) for c, n in zip(columns, names)}
    rows = lines.where(F.trim("value") != "").select("*", _text_parsed(names, "value"))
    header = F.lit(True)
    for c, n in zip(columns, names):
        header = header & F.col(n).eqNullSafe(F.lit(c))
    rows = rows.where(~header)
    wrong = [F.when(_unparsed(f, text[f.name]), F.struct(F.lit(f.name).alias("column"), text[f.name].alias("text"))) for f in ORDERS_NPS_SCHEMA.fields]
    whole = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.col("value").alias("text")))
    rows = rows.withColumn("_faults", F.when(F.col("_bad").isNotNull(), whole).otherwise(F.filter(F.array(*wrong), lambda x: x.isNotNull())))
    clean = rows.where(F.size("_faults") == 0).select(*[_parsed_text(f, text[f.name]).alias(f.name) for f in ORDERS_NPS_SCHEMA.fields])
    at = (F.col("file") == F.col("_f")) & (F.col("_block") == F.col("_b"))
    faults = rows.where(F.size("_faults") > 0).join(blocks, at).select(
        "file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line"), F.explode("_faults").alias("_x"), F.col("value").alias("record"))
    return _without_nan(clean), faults.select("file", "line", "_x.column", "_x.text", "record")


def _file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def read_processed(spark: SparkSession, path_v2: str, path_v1: str, fmt: str = "parquet",
                   version: str = "v2") -> DataFrame:
    """IO2: processed base; if absent, read the V1 base, apply the version
    filter and re-derive the features."""
    from voxpop.operators.features import processed, version_filter
    if _exists(spark, path_v2):
        return spark.read.format(fmt).option("header", True).option("inferSchema", fmt == "csv").load(path_v2)
    return processed(version_filter(read_orders(spark, path_v1, fmt), version))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """IO3 / IO4 sink."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_comparison(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> str:
    """IO4: publishes the report tables (overview, regression, classification,
    correlations) together and returns the folder of this version.

    The tables go to a folder of their own; a manifest that names them is put in
    place last, by one rename.  A reader (``published``) sees all tables of one
    publication or those of the one before it, also when a write fails half way."""
    spark = next(iter(tables.values())).sparkSession
    folder, name = folder.rstrip("/"), f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    version = f"{folder}/version-{name}"
    for table, df in tables.items():
        write_table(df, f"{version}/{table}", fmt)
    fs, ready = _file_system(spark, f"{folder}/_manifests/{name}.json")
    _, draft = _file_system(spark, f"{version}/_manifest.json")
    out = fs.create(draft)
    out.write(bytearray(json.dumps({"version": version, "format": fmt, "tables": sorted(tables)}).encode()))
    out.close()
    fs.mkdirs(ready.getParent())
    if not fs.rename(draft, ready):
        raise OSError(f"the manifest could not be put in place: {ready}")
    return version


def published(spark: SparkSession, folder: str) -> dict[str, str]:
    """Paths of the tables of the latest publication, by name; empty before the first."""
    fs, manifests = _file_system(spark, f"{folder.rstrip('/')}/_manifests")
    if not fs.exists(manifests):
        return {}
    latest = max((f.getPath().toString() for f in fs.listStatus(manifests)), default=None)
    if latest is None:
        return {}
    found = json.loads(spark.read.text(latest, wholetext=True).first()[0])
    return {t: f"{found['version']}/{t}" for t in found["tables"]}


def metric_table(metrics: DataFrame, shown: dict[str, str], metric: str, order: list[str]) -> DataFrame:
    """``metrica``, ``v1``, ``v2`` (texts): the ``shown`` metrics of the model of
    each version that is best by ``metric``, then the models' names as
    ``modelo_v1`` and ``modelo_v2``.  ``metrics``: model, metric, value, version."""
    from voxpop.ml.evaluate import best_model
    best = None
    for v in ("v1", "v2"):
        one = best_model(metrics.where(F.col("version") == v), metric, order).select(F.col("model").alias("_m"), F.lit(v).alias("_v"))
        best = one if best is None else best.unionByName(one)
    won = metrics.join(best, (F.col("model") == F.col("_m")) & (F.col("version") == F.col("_v")))
    names = F.create_map(*[x for m, s in shown.items() for x in (F.lit(m), F.lit(s))])
    numbers = won.where(F.col("metric").isin(list(shown))).groupBy(names[F.col("metric")].alias("metrica")).agg(
        *[F.max(F.when(F.col("version") == v, F.col("value"))).cast("string").alias(v) for v in ("v1", "v2")])
    texts = best.select(F.concat(F.lit("modelo_"), "_v").alias("metrica"), *[F.when(F.col("_v") == v, F.col("_m")).otherwise("").alias(v) for v in ("v1", "v2")])
    return numbers.unionByName(texts)


def read_metric_table(spark: SparkSession, path: str) -> DataFrame:
    """IO5: ``metrica,v1,v2`` where ``modelo*`` rows hold text and the others
    numbers: text columns kept, numbers parsed with try_cast."""
    df = spark.read.option("header", True).csv(path)
    first = df.columns[0]
    is_text = F.lower(F.col(first)).startswith("modelo")
    out = df.withColumnRenamed(first, "metrica")
    for c in df.columns[1:]:
        out = out.withColumn(f"{c}_num", F.when(~is_text, F.expr(f"try_cast(`{c}` AS DOUBLE)")))
        out = out.withColumn(f"{c}_text", F.when(is_text, F.col(c)))
    return out.drop(*df.columns[1:]).withColumn("is_text", is_text)


def save_model(model, path: str) -> None:
    """IO6."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
