"""Streams give what the batch operators give."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from flowquarry import queries, schemas, tables
from flowquarry.operators import dedup, enrich, rollup
from flowquarry.sources import flows, lines, logs
from flowquarry.streaming import jobs


def held(load):
    return jobs.Refreshed(load, timedelta(hours=1))


def test_ingest_equals_batch_over_several_triggers(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    messages = flows.generated(spark, 600).select("value")
    first = messages.unionAll(messages.limit(50)).unionAll(spark.createDataFrame([("{broken",)], "value string"))
    dims = jobs.Dimensions(tenants=held(queries.tenant_table), threats=held(queries.threat_table), city=held(lambda s: queries.geo_tables(s)[0]), asn=held(lambda s: queries.geo_tables(s)[1]))
    for part in (first, messages.limit(100).unionAll(flows.generated(spark, 700).orderBy(F.desc(F.col("key").cast("int"))).limit(100).select("value"))):
        part.coalesce(1).write.mode("append").text(inbox)
        stream = spark.readStream.schema("value string").text(inbox)
        assert jobs.ingest(stream, out, dims, str(tmp_path / "check"), once=True).awaitTermination(180)
    stored = spark.read.parquet(f"{out}/flows")
    good, _ = flows.decode(flows.generated(spark, 700).select("value"))
    city, asn = queries.geo_tables(spark)
    want = schemas.shaped(enrich.enriched(dedup.first_in_ttl(enrich.flat(good)), queries.tenant_table(spark), queries.threat_table(spark), city, asn), schemas.FLOWS)
    columns = [f.name for f in schemas.FLOWS]
    assert stored.count() == 700 and stored.select(columns).exceptAll(want.select(columns)).isEmpty()
    merged = rollup.merged(spark.read.parquet(f"{out}/flows_1m"))
    assert merged.exceptAll(rollup.rollup(want, "minute")).isEmpty() and merged.count() == rollup.rollup(want, "minute").count()
    assert spark.read.parquet(f"{out}/rejected").count() == 1
    # Retention sees what was written: days come before batches.
    days = {str(r[0]) for r in stored.select("event_date").distinct().collect()}
    assert tables.expired_days(spark, f"{out}/flows", date(2100, 1, 1)) == sorted(f"event_date={d}" for d in days)
    assert tables.expire(spark, f"{out}/flows", date(2100, 1, 1)) == len(days)
    assert tables.expire(spark, f"{out}/flows_1m", date(2100, 1, 1)) == len(days)


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    rows = spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2)], "d string, v int").select(F.col("d").cast("date").alias("event_date"), "v")
    for number, df in ((0, rows), (1, rows), (1, rows.where("v = 2").withColumn("v", F.lit(5)))):
        stored = tables.write_batch(df, str(tmp_path / "t"), number)
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 1, 2, 5]
    assert tables.write_batch(rows.limit(0), str(tmp_path / "t"), 7) is None and stored.count() == 2


def test_state_is_dropped(spark, tmp_path):
    """A key that is seen again after its state's end is new, though its time is the same."""
    import time

    rows = spark.range(40).select(F.lit("2026-01-01 00:00:00").cast("timestamp").alias("timestamp"), F.col("id").cast("string").alias("k"))
    (tmp_path / "in").mkdir()
    stream = dedup.first_in_ttl_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), ["k"], "timestamp", 1, 1)
    counts = []
    q = stream.writeStream.foreachBatch(lambda df, n: counts.append(df.count())).option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="1 second").start()

    def await_rows(n):
        until = time.monotonic() + 60
        while sum(counts) < n and time.monotonic() < until:
            time.sleep(0.2)
        assert sum(counts) == n

    try:
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        await_rows(40)
        time.sleep(4)
        rows.where("k = '1'").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        await_rows(41)
    finally:
        q.stop()


def test_live_names(spark, tmp_path):
    from flowquarry.streaming import live

    at = "2026-01-01 10:00:0{}"
    rows = [(at.format(1), "10.0.0.1", 5, "old.example", "A", "192.0.2.1", 5), (at.format(3), "10.0.0.1", 5, "a.example", "A", "192.0.2.1", 90000), (at.format(3), "10.0.0.1", 5, "b.example", "A", "192.0.2.1", 120), (at.format(2), "10.0.0.1", 5, "late.example", "A", "192.0.2.1", 300), (at.format(1), "10.0.0.2", 5, "x.example", "A", "", 0)]
    df = spark.createDataFrame(rows, "t string, client_ip string, client_port int, qname string, qtype string, answer_ip string, ttl long").select(F.col("t").cast("timestamp").alias("event_time"), "client_ip", "client_port", "qname", "qtype", "answer_ip", "ttl")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = live.live_names(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), expire=False)
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert (row.client_ip, row.qname, str(row.event_time), str(row.deadline)) == ("10.0.0.1", "b.example", "2026-01-01 10:00:03", "2026-01-01 10:02:03")


def test_growing_files_feed_a_table(spark, tmp_path):
    folder, table = tmp_path / "logs", str(tmp_path / "dns")
    one = "01-Feb-2026 09:15:00.123 client 10.0.0.5#4444 (a.example): query: {} IN A +E(0)K (10.0.0.1)\n"
    scan = lambda: jobs.follow_growing(spark, lines.Tail(str(folder)), logs.dns_text_events, schemas.DNS_EVENTS, table, str(tmp_path / "offsets.json"))
    assert scan() == 0  # no folder yet
    folder.mkdir()
    (folder / "a.log").write_text(one.format("a.example") + one.format("b.example")[:30])
    assert scan() == 1
    (folder / "a.log").write_text(one.format("a.example") + one.format("b.example"))
    assert scan() == 1 and scan() == 0
    assert {r.qname for r in spark.read.parquet(table).collect()} == {"a.example", "b.example"}


def test_refreshed_table_outlives_its_source(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "src"))
    dim = jobs.Refreshed(lambda s: s.read.parquet(str(tmp_path / "src")), timedelta(hours=1), folder=str(tmp_path / "held"))
    held_ = dim.get(spark)
    import shutil

    shutil.rmtree(tmp_path / "src")
    assert held_.count() == 3


def test_log_follower_appends_events(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("01-Feb-2026 09:15:00.123 client 10.0.0.5#40333 (a.example): query: a.example IN A +E(0)K (10.0.0.1)\nnoise\n")
    table = str(tmp_path / "dns")
    for _ in range(2):  # the second run has nothing new
        jobs.follow_logs(spark, str(tmp_path / "in"), logs.dns_text_events, schemas.DNS_EVENTS, table, str(tmp_path / "check"), once=True).awaitTermination(60)
    rows = spark.read.parquet(table).collect()
    assert len(rows) == 1 and rows[0].qname == "a.example"


def test_minute_windows(spark, tmp_path):
    df = queries.flows(spark, "/root/testdata/sf0.001").select("timestamp", *rollup.KEYS, "bytes", "packets")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.minute_windows(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got, want = spark.read.parquet(str(tmp_path / "out")), rollup.rollup(df, "minute")
    assert got.select(want.columns).exceptAll(want).isEmpty() and want.count() - got.count() <= 20  # the last minutes are held back


def test_refresh_keeps_the_last_good_table(spark):
    calls, now = [], [0.0]

    def load(session):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("gone")
        return session.range(len(calls))

    dim = jobs.Refreshed(load, timedelta(seconds=10), clock=lambda: now[0])
    assert dim.get(spark).count() == 1
    now[0] = 11
    assert dim.get(spark).count() == 1 and len(calls) == 2
    now[0] = 22
    assert dim.get(spark).count() == 3
    with pytest.raises(OSError):
        jobs.Refreshed(lambda s: (_ for _ in ()).throw(OSError()), timedelta(1)).get(spark)


def test_counted(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([("a", "", 1, 0, 1), ("", "", 0, 0, 0)], "src_mac_token string, dst_mac_token string, is_threat_src int, is_threat_dst int, is_sampled int")
    seen = Observation("x")
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 2 and jobs.counted(df).count() == 2
