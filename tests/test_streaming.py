"""Event-time dedup (expiry, late rows, bounded state) and the bucketed sink's pruning."""

import datetime as dt

from pyspark.sql.types import _parse_datatype_string

from offerlens.session import scratch_path
from offerlens.streaming import ingest


def test_watermark_forgets_ids(spark):
    base = scratch_path(spark, "watermark")
    schema = "job_id STRING, seen TIMESTAMP, arrival INT"
    arrivals = {1992: [("a", 1992), ("b", 1992), ("c", 1992)], 1993: [("a", 1993), ("x", 1993)], 1994: [("b", 1994), ("x", 1994)],
                1995: [("c", 1995), ("late", 1992), ("x", 1995)], 1996: [("a", 1996), ("x", 1996), ("x", 1996)], 1997: [("late", 1997)], 1998: [("x", 1998)]}
    states = []
    for year, rows in arrivals.items():
        data = [(k, dt.datetime(y, 1, 1), year) for k, y in rows]
        spark.createDataFrame(data, schema).write.mode("append").parquet(f"{base}/source")
        states.append(ingest.stream_dedup(spark, f"{base}/source", _parse_datatype_string(schema), f"{base}/sink", f"{base}/ckpt", "job_id", ("seen", "300 days")))
    got = sorted((r.arrival, r.job_id) for r in spark.read.parquet(f"{base}/sink").collect())
    assert got == [(1992, "a"), (1992, "b"), (1992, "c"), (1993, "x"), (1995, "c"), (1996, "a"), (1996, "x"), (1997, "late")]
    # without expiry the state would hold all five ids; with it, only those of the last span
    assert sum(x["removed"] for x in states) >= 5 and states[-1]["rows"] <= 2


def test_batch_opens_only_its_folders(spark, capsys):
    schema = _parse_datatype_string("job_id STRING, offer_id BIGINT, title STRING, scraped_at TIMESTAMP")
    sink, t = scratch_path(spark, "buckets"), dt.datetime(2020, 1, 1)
    spark.createDataFrame([], ingest._sink_schema(schema)).write.partitionBy("id_bucket", "batch_id").parquet(sink)
    merge = ingest._merge_batch(sink, schema, "job_id", ["scraped_at", "offer_id"], "title")
    many = spark.createDataFrame([(f"job{i}", i, "x", t) for i in range(500)], schema)
    merge(many, 0)
    merge(spark.createDataFrame([("job7", 1, "y", t), ("new", 2, "y", t), (None, 3, "y", t)], schema), 1)
    stored = spark.read.schema(ingest._sink_schema(schema)).parquet(sink)
    assert stored.count() == 502 and stored.select("id_bucket").distinct().count() > 40
    opened = [r[0] for r in many.where("job_id = 'job7'").select(ingest.id_bucket("job_id")).collect()]
    found = ingest.seen_ids(stored, "job_id", opened, 2)
    found.explain()
    filters = capsys.readouterr().out.split("PartitionFilters: [")[1].split("]")[0]
    assert "id_bucket#" in filters and f"= {opened[0]}" in filters
    assert found.count() < 60
