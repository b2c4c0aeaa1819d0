"""IO1-IO6: declared-schema CSV read, processed-base fallback, report tables, metric table,
model persistence."""

import tempfile

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from voxpop.sources import tables as IO


def test_csv_roundtrip_and_fallback(spark):
    d = tempfile.mkdtemp(prefix="voxpop-io-")
    base = IO.load_base(spark, "/root/testdata/sf0.001")
    IO.write_table(base, d + "/v1", "csv")
    back = IO.read_orders(spark, d + "/v1", "csv")
    assert back.count() == base.count() and back.schema == base.schema
    v2 = IO.read_processed(spark, d + "/missing_v2", d + "/v1", fmt="csv", version="v2")
    assert "classificacao_nps" in v2.columns and v2.filter("nps_score = 0").count() == 0


def test_metric_table_text_and_numbers(spark):
    d = tempfile.mkdtemp(prefix="voxpop-io-")
    with open(d + "/m.csv", "w") as fh:
        fh.write("metrica,v1,v2\nmae,1.19,1.17\nmodelo_melhor,Linear,Forest\nr2,0.64,0.56\n")
    rows = {r["metrica"]: r for r in IO.read_metric_table(spark, d + "/m.csv").collect()}
    assert rows["mae"]["v1_num"] == 1.19 and rows["modelo_melhor"]["v2_text"] == "Forest"
    assert rows["modelo_melhor"]["v1_num"] is None and rows["modelo_melhor"]["is_text"]


def test_model_save_load(spark):
    d = tempfile.mkdtemp(prefix="voxpop-io-")
    df = IO.load_base(spark, "/root/testdata/sf0.001")
    m = Pipeline(stages=[VectorAssembler(inputCols=["order_value"], outputCol="v"),
                         StandardScaler(inputCol="v", outputCol="s")]).fit(df)
    IO.save_model(m, d + "/model")
    assert IO.load_model(d + "/model").transform(df).count() == df.count()


def test_write_comparison_tables_round_trip(spark):
    from voxpop.operators import stats as ST
    from voxpop.schema import CORR_FULL
    d = tempfile.mkdtemp(prefix="voxpop-io-")
    base = IO.load_base(spark, "/root/testdata/sf0.001")
    tables = {"visao_geral": ST.version_overview(base), "correlacoes": ST.corr_change(base, CORR_FULL)}
    IO.write_comparison(tables, d)
    for name, df in tables.items():
        back = spark.read.option("header", True).schema(df.schema).csv(IO.published(spark, d)[name])
        assert back.count() == df.count() > 0
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_scale_conf_sizes_partitions():
    from voxpop.session import scale_conf
    c = scale_conf(100 * 2 ** 40, 8000)            # 100 TiB on 1,000 executors x 8 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600
    assert scale_conf(10 * 2 ** 30, 8000)["spark.sql.shuffle.partitions"] == "16000"
    assert scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"


def test_csv_is_read_by_header_name_and_counts_what_does_not_parse(spark, tmp_path):
    import pytest
    base = IO.load_base(spark, "/root/testdata/sf0.001").limit(20)
    turned = base.select(*reversed(base.columns)).withColumn("items_quantity", F.col("items_quantity").cast("double"))
    turned.write.option("header", True).csv(str(tmp_path / "turned"))
    back = IO.read_orders(spark, str(tmp_path / "turned"))
    assert back.columns == base.columns
    assert back.exceptAll(base).count() == 0 and base.exceptAll(back).count() == 0
    assert sum(IO.unparsed_orders(spark, str(tmp_path / "turned")).first()) == 0
    base.withColumn("customer_age", F.lit("old")).write.option("header", True).csv(str(tmp_path / "text"))
    assert IO.unparsed_orders(spark, str(tmp_path / "text")).first()["customer_age"] == 20
    base.drop("nps_score").write.option("header", True).csv(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="nps_score"):
        IO.read_orders(spark, str(tmp_path / "short"))


def test_quarantine_names_file_line_and_column(spark, tmp_path):
    base = IO.load_base(spark, "/root/testdata/sf0.001").limit(30)
    rows = [",".join("" if v is None else str(v) for v in r) for r in base.collect()]
    at = base.columns.index("order_value")
    swap = lambda line, v: ",".join([*line.split(",")[:at], v, *line.split(",")[at + 1:]])
    head = ",".join(base.columns)
    lines = [head, rows[0], rows[1] + ",extra", "", swap(rows[2], "cheap"), rows[3].rsplit(",", 3)[0], swap(rows[4], "NaN"), swap(rows[5], "")]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([head, *rows[6:], "not an order"]) + "\n")
    clean, faults = IO.read_orders_checked(spark, str(tmp_path))
    got = {(r["file"].rsplit("/", 1)[1], r["line"], r["column"], r["text"]) for r in faults.collect()}
    assert got == {("a.csv", 3, None, lines[2]), ("a.csv", 5, "order_value", "cheap"), ("a.csv", 6, None, lines[5]), ("b.csv", len(rows[6:]) + 2, None, "not an order")}
    assert clean.schema == base.schema and clean.count() + len(got) == 30 + 1
    kept = {r["order_id"]: r for r in clean.collect()}
    empty = [kept[int(x.split(",")[base.columns.index("order_id")])]["order_value"] for x in (rows[4], rows[5])]
    assert empty == [None, None]


def test_line_numbers_over_several_splits_of_a_file(spark, tmp_path):
    base = IO.load_base(spark, "/root/testdata/sf0.001")
    rows = [",".join("" if v is None else str(v) for v in r) for r in base.collect()]
    bad = [7, 500, 501, 1400]
    for i in bad:
        rows[i] = f"fault {i}"
    (tmp_path / "all.csv").write_text("\n".join([",".join(base.columns), *rows]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        clean, faults = IO.read_orders_checked(spark, str(tmp_path))
        assert sorted((r["line"], r["text"]) for r in faults.collect()) == [(i + 2, f"fault {i}") for i in bad]
        assert clean.count() == len(rows) - len(bad)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_readers_see_whole_publications_only(spark, tmp_path):
    import pytest
    folder = str(tmp_path / "reports")
    one, two = spark.range(3).toDF("a"), spark.range(5).toDF("a")
    assert IO.published(spark, folder) == {}
    IO.write_comparison({"x": one, "y": one}, folder)
    first = IO.published(spark, folder)
    assert set(first) == {"x", "y"} and spark.read.option("header", True).csv(first["y"]).count() == 3
    broken = two.select(F.raise_error(F.lit("half way")).cast("long").alias("a"))
    with pytest.raises(Exception, match="half way"):
        IO.write_comparison({"x": two, "y": broken}, folder)
    assert IO.published(spark, folder) == first
    IO.write_comparison({"x": two, "y": two}, folder)
    assert all(spark.read.option("header", True).csv(p).count() == 5 for p in IO.published(spark, folder).values())


def test_rewritten_inputs_give_a_new_base(spark, tmp_path):
    import os
    import shutil

    import pyarrow.parquet as pq
    d = str(tmp_path / "sf")
    shutil.copytree("/root/testdata/sf0.001", d)
    before = IO.load_base(spark, d).count()
    os.chmod(f"{d}/orders.parquet", 0o644)
    pq.write_table(pq.read_table("/root/testdata/sf0.001/orders.parquet").slice(0, 100), f"{d}/orders.parquet")
    assert before == 1500 and IO.load_base(spark, d).count() == 100


def test_checked_read_parses_a_line_once(spark, tmp_path):
    base = IO.load_base(spark, "/root/testdata/sf0.001").limit(5)
    base.write.option("header", True).csv(str(tmp_path / "orders"))
    for df in IO.read_orders_checked(spark, str(tmp_path / "orders")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_csv") == 1


def test_checked_read_takes_the_names_given_in_any_case(spark, tmp_path):
    base = IO.load_base(spark, "/root/testdata/sf0.001").limit(5)
    first = [*reversed(base.columns)]
    base.select(*first).write.csv(str(tmp_path / "bare"))
    clean, faults = IO.read_orders_checked(spark, str(tmp_path / "bare"), [c.upper() for c in first])
    assert clean.exceptAll(base).count() == 0 and clean.count() == 5 and faults.count() == 0
