"""The stateless projections run unchanged on a stream."""

import tempfile

from voxpop.sources.tables import load_base
from voxpop.streaming.stream import processed_stream, read_orders_stream


def test_processed_stream_matches_batch(spark):
    out = tempfile.mkdtemp(prefix="voxpop-stream-src-")
    load_base(spark, "/root/testdata/sf0.001").write.mode("overwrite").parquet(out + "/in")
    q = (processed_stream(read_orders_stream(spark, out + "/in")).writeStream.format("memory")
         .queryName("vx_processed").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    n = spark.sql("SELECT count(*) AS n, sum(eh_detrator) AS d FROM vx_processed").first()
    assert n["n"] == 1500 and n["d"] > 0
