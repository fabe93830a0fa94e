"""Operators against plain-Python folds and known cases."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowquarry import queries, schemas, tables
from flowquarry.functions import net
from flowquarry.operators import dedup, enrich, rollup, temporal
from flowquarry.plans import capture, dashboards, forensic
from flowquarry.sources import dimensions, flows, lines

T0 = datetime(2026, 1, 1)


def at(s):
    return T0 + timedelta(seconds=s)


def fold(events, key, when, horizon):
    """Replay of a key's events, instant by instant: an opening set replaces the candidates, a close removes its entity."""
    mine = sorted((e for e in events if e[0] == key and e[3] <= when), key=lambda e: e[3])
    held, deadline = set(), None
    for moment, group in itertools.groupby(mine, key=lambda e: e[3]):
        group = list(group)
        opening = {(e[1], e[2]) for e in group if e[4]}
        if opening:
            held, deadline = opening, moment + horizon
        gone = {e[1] for e in group if not e[4]}
        held = {c for c in held if c[0] not in gone}
    if not held or when > deadline:
        return "", False
    if len(held) > 1:
        return "", True
    return next(iter(held))[1], False


@pytest.mark.parametrize("seed", [1, 2])
def test_as_of_equals_replay(spark, seed):
    rnd = random.Random(seed)
    events = [(f"k{rnd.randint(0, 30)}", f"e{rnd.randint(0, 2)}", f"v{rnd.randint(0, 2)}", at(rnd.randint(0, 40)), rnd.random() < 0.65) for _ in range(700)]
    asks = [(i, f"k{rnd.randint(0, 32)}", at(rnd.randint(-3, 60))) for i in range(900)]
    horizon = timedelta(seconds=9)
    rnd.shuffle(events)
    df = spark.createDataFrame(events + events[:50], "key string, entity string, candidate string, t timestamp, opening boolean")
    bound = temporal.intervals(df, "key", "entity", "candidate", "t", F.col("opening"), ~F.col("opening"), horizon)
    q = spark.createDataFrame(asks, "id int, key string, asked timestamp")
    for r in temporal.as_of(q, "key", "asked", bound, "value", "several").collect():
        assert (r.value, r.several) == fold(events, r.key, r.asked, horizon), (r.key, r.asked)


def test_lease_cases(spark):
    """Numbered cases of one instant's events, in any order: the answer and whether it is ambiguous."""
    cases = [
        ([(10, "A", 0)], 5, ("A", False)), ([(10, "A", 0), (12, "A", 3)], 5, ("", False)), ([(10, "A", 0), (10, "B", 0)], 5, ("", True)), ([(10, "A", 0), (12, "A", 0)], 5, ("", False)),
        ([(10, "A", 0), (10, "B", 0), (12, "A", 0)], 5, ("B", False)), ([(10, "A", 0), (10, "B", 3)], 5, ("B", False)), ([(10, "A", 0), (12, "B", 3)], 5, ("A", False)), ([(10, "A", 0)], 100, ("A", False)), ([(10, "A", 0)], 101, ("", False)),
        ([(10, "A", 0), (11, "A", 50)], 120, ("A", False)), ([(10, "A", 0), (10, "B", 0)], 101, ("", False)), ([(10, "", 0)], 5, ("", False)), ([(12, "A", 0)], 5, ("", False)), ([(10, "A", 0), (10, "B", 0), (12, "A", 4)], 4, ("B", False)),
    ]
    events, asks = [], []
    for i, (group, when, _) in enumerate(cases):
        for order in itertools.permutations(group):
            key = f"{i}.{len(asks)}"
            events += [(at(s), kind, key, mac, "") for kind, mac, s in order]
            asks.append((key, at(when), i))
    leases = temporal.lease_intervals(spark.createDataFrame(events, schemas.DHCP_EVENTS), timedelta(seconds=100))
    for r in temporal.as_of(spark.createDataFrame(asks, "ip string, t timestamp, i int"), "ip", "t", leases, "mac", "several").collect():
        assert (r.mac, r.several) == cases[r.i][2], cases[r.i]


def test_dns_as_of(spark):
    events = [(at(0), "c", 1, "a.example", "A", "x", 300, False), (at(100), "c", 1, "b.example", "A", "x", 5, False), (at(100), "c", 1, "aa.example", "A", "x", 900, False), (at(0), "d", 1, "u.example", "A", "x", 0, True), (at(0), "e", 1, "cap.example", "A", "x", 99999, False), (at(0), "c", 1, "n.example", "A", "", 300, False)]
    asks = [("c", "x", at(99), "a.example"), ("c", "x", at(100), "b.example"), ("c", "x", at(160), "b.example"), ("c", "x", at(161), ""), ("d", "x", at(600), "u.example"), ("d", "x", at(601), ""), ("e", "x", at(3600), "cap.example"), ("e", "x", at(3601), ""), ("c", "", at(5), ""), ("c", "x", at(-1), "")]
    found = temporal.dns_as_of(spark.createDataFrame(asks, "c string, a string, t timestamp, want string"), "c", "a", "t", spark.createDataFrame(events, schemas.DNS_FLIGHT), "name")
    for r in found.collect():
        assert r.name == r.want


def test_ttl_dedup_equals_loop(spark):
    rnd = random.Random(5)
    rows = [(i, f"k{rnd.randint(0, 9)}", at(rnd.randint(0, 2000))) for i in range(1500)]
    want, last = set(), {}
    for i, k, t in sorted(rows, key=lambda r: (r[2], r[0])):
        if k not in last or t - last[k] > timedelta(seconds=60):
            want.add(i)
            last[k] = t
    got = {r.id for r in dedup.first_in_ttl(spark.createDataFrame(rows, "id int, k string, timestamp timestamp"), ["k"], order=["id"]).collect()}
    assert got == want


def test_sampling(spark):
    rows = [(100, 2, 1000), (100, 2, 4096), (50, 1, 256), (100, 2, 1), (100, 2, 0), (2**62, 1, 8)]
    df = spark.createDataFrame(rows, "bytes long, packets long, sampling_rate long")
    assert [(r.is_sampled, r.expanded_bytes, r.expanded_packets) for r in enrich.with_sampling(df).collect()] == [(1, 100_000, 2000), (1, 409_600, 8192), (1, 12_800, 256), (0, 0, 0), (0, 0, 0), (1, None, 8)]


def test_tenants_threats_geo(spark, tmp_path):
    (tmp_path / "t.yaml").write_text("tenants:\n- {id: 1, name: big, subnets: [10.1.0.0/16, nonsense]}\n- {id: 2, name: small, subnets: [10.1.2.9/24]}\n- {id: 3, name: last, subnets: [10.1.2.0/24]}\n")
    (tmp_path / "threat.csv").write_text("# comment\n\n192.0.2.1,80,now,worm\n192.0.2.2\n192.0.2.1,80,now,late\n192.0.2.3,1,2,\r\n")
    tenants, threats = dimensions.tenants(spark, str(tmp_path / "t.yaml")), dimensions.threats(spark, str(tmp_path / "threat.csv"))
    assert {r.ip: r.label for r in threats.collect()} == {"192.0.2.1": "late", "192.0.2.2": "botnet_c2", "192.0.2.3": ""}
    df = spark.createDataFrame([("10.1.2.3", "192.0.2.3"), ("10.1.9.9", "192.0.2.1"), ("192.0.2.3", "192.0.2.2"), ("bad", "8.8.8.8"), ("", "9.9.9.9")], "src_ip string, dst_ip string")
    assert [(r.tenant_id, r.tenant_name) for r in enrich.with_tenant(df, tenants, "src_ip", "").collect()] == [(3, "last"), (1, "big"), (0, ""), (0, ""), (0, "")]
    assert [(r.is_threat_src, r.is_threat_dst, r.threat_label) for r in enrich.with_threats(df, threats).collect()] == [(0, 1, ""), (0, 1, "late"), (1, 1, "botnet_c2"), (0, 0, ""), (0, 0, "")]
    ranges = spark.createDataFrame([("8.0.0.0", "8.255.255.255", "US", "", 1.0, 2.0, 7, "Org"), ("9.9.9.0", "9.9.9.255", "", "", 0.0, 0.0, 8, "Q9")], "a string, b string, country string, city string, lat double, lon double, asn long, org string")
    city, asn = dimensions.ranges(ranges, "a", "b", ["country", "city", "lat", "lon"]), dimensions.ranges(ranges, "a", "b", ["asn", "org"])
    out = enrich.with_geo(enrich.with_geo(df, city, asn, "src"), city, asn, "dst")
    assert [(r.src_country, r.dst_country, r.dst_asn) for r in out.collect()] == [("private", "", 0), ("private", "", 0), ("", "", 0), ("private", "US", 7), ("private", "unknown", 8)]


def test_ipv6_tenants_and_geo(spark, tmp_path):
    (tmp_path / "t.yaml").write_text("tenants:\n- {id: 1, name: all, subnets: ['2001:db8::/32', 10.0.0.0/8]}\n- {id: 2, name: odd, subnets: ['2001:db8:4::1/46']}\n- {id: 3, name: one, subnets: ['2001:db8:5::/48', 'fe80::zz/10']}\n")
    tenants = dimensions.tenants(spark, str(tmp_path / "t.yaml"))
    ips = ["2001:DB8::1", "2001:db8:7:ffff::", "2001:db8:5:1::9", "2001:db8:8::", "2001:db9::", "::ffff:10.1.1.1", "10.1.1.1", "::ffff:a01:101", "fe80::1", "", None]
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i int, src_ip string")
    got = [r.tenant_id for r in enrich.with_tenant(df, tenants, "src_ip", "").orderBy("i").collect()]
    assert got == [1, 2, 3, 1, 0, 1, 1, 1, 0, 0, 0]
    ranges = spark.createDataFrame([("10.0.0.0", "20.0.0.0", "XX", "", 0.0, 0.0, 1, "O"), ("2001:db8::", "2001:db8:5:ffff:ffff:ffff:ffff:ffff", "SG", "c", 1.5, 2.5, 5, "S"), ("2001:db8:8::", "2001:db8:8::", "", "", 0.0, 0.0, 6, "T"), ("20.0.0.9", "x", "", "", 0.0, 0.0, 6, "T")], "a string, b string, country string, city string, lat double, lon double, asn long, org string")
    where, who = ["country", "city", "lat", "lon"], ["asn", "org"]
    tables = [f(ranges, "a", "b", values) for f in (dimensions.ranges, dimensions.networks6) for values in (where, who)]
    out = enrich.with_geo(df, tables[0], tables[1], "src", *tables[2:]).orderBy("i").collect()
    assert [(r.src_country, r.src_asn) for r in out] == [("SG", 5), ("", 0), ("SG", 5), ("unknown", 6), ("", 0), ("private", 0), ("private", 0), ("private", 0), ("", 0), ("private", 0), ("private", 0)]
    assert out[2].src_city == "c" and out[2].src_lat == 1.5


def test_questions_without_a_key_meet_nothing_and_stay(spark):
    """Nine tenths of the questions have no key: they are answered with nothing and land in no common task."""

    dhcp = spark.createDataFrame([("2026-01-01 00:30:00", 10, "10.0.0.1", "m1", ""), ("2026-01-01 00:30:00", 10, "", "m9", "")], "event_time string, event_id int, ip string, mac_token string, host_token string").withColumn("event_time", F.col("event_time").cast("timestamp"))
    asked = spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, "10.0.0.1").when(F.col("id") % 10 < 5, "").alias("ip"), F.expr("timestamp '2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id as int))").alias("t"))
    found = temporal.as_of(asked, "ip", "t", temporal.lease_intervals(dhcp), "mac", "several")
    rows = {r.id: r.mac for r in found.collect()}
    assert len(rows) == 5000 and all((rows[i] == "m1") == (i % 10 == 0 and 30 <= i <= 30 + 24 * 60) for i in rows)  # a minute each, up to the horizon
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = temporal.as_of(asked, "ip", "t", temporal.lease_intervals(dhcp), "mac", "several")
        sizes = [r["count"] for r in plan.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert "Window" not in plan._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
        assert sum(sizes) == 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_range_join_equals_brute_force(spark):
    rnd = random.Random(4)
    cuts = sorted(rnd.sample(range(2**32), 400))
    ranges = [(a, b, i) for i, (a, b) in enumerate(zip(cuts[::2], cuts[1::2], strict=True))]
    points = [rnd.randrange(2**32) for _ in range(800)] + [a for a, *_ in ranges[:50]] + [b for _, b, _ in ranges[:50]]
    text = lambda n: ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    df = spark.createDataFrame([(text(p), p) for p in points], "ip string, p long")
    for r in enrich.with_range(net.parsed(df, "ip", "x"), spark.createDataFrame(ranges, "first long, last long, v int"), "x_n", ["v"], "r_", 8).collect():
        assert r.r_v == next((v for a, b, v in ranges if a <= r.p <= b), None)


def test_decode_rejects_and_defaults(spark):
    rows = ['{"src_addr":"a","bytes":18446744073709551615,"extra":1}', "{", '{"src_port":"text"}', "", "{}"]
    good, bad = flows.decode(spark.createDataFrame([(x,) for x in rows], "value string"))
    assert bad.count() == 3
    one = good.where("src_addr = 'a'").first()
    assert int(one.bytes) == 2**64 - 1 and one.dst_addr == "" and one.src_port == 0


def test_generator_has_distinct_keys(spark):
    good, bad = flows.decode(flows.generated(spark, 5000).select("value"))
    flat = enrich.flat(good)
    assert bad.isEmpty() and dedup.first_in_ttl(flat).count() == 5000
    assert flat.select("timestamp").first().timestamp.microsecond == 0


def test_tables(spark, tmp_path):
    rows = spark.createDataFrame([(at(0), 10, "a", "m", ""), (at(0) + timedelta(milliseconds=500), 10, "a", "m", ""), (at(200_000), 11, "a", "m", "")], schemas.DHCP_EVENTS)
    path = str(tmp_path / "dhcp")
    tables.append(rows, schemas.DHCP_EVENTS, path, "event_time")
    stored = spark.read.parquet(path)
    assert tables.as_set(stored).count() == 2
    some = tables.between(stored, "event_time", "2026-01-01 00:00:00", "2026-01-01 12:00:00")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters")[1][:200] and some.count() == 2
    assert tables.expire(spark, path, (T0 + timedelta(days=122)).date()) == 1
    assert spark.read.parquet(path).count() == 1
    sizes = tables.file_sizes(spark.read.parquet(path), "dhcp").first()
    assert sizes.row_count == 1 and sizes.bytes_on_disk > 0
    files = [r.p for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("p")).distinct().collect()]
    assert "ip" in {r.column for r in tables.column_sizes(spark, files).collect()}
    assert [r.x for r in spark.createDataFrame([(0,), (1536,), (5 << 30,)], "v long").select(tables.readable_size(F.col("v")).alias("x")).collect()] == ["0.00 B", "1.50 KiB", "5.00 GiB"]


def test_tail(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.log").write_bytes(b"one\r\n\ntwo\npart")
    tail = lines.Tail(str(tmp_path))
    assert [x for _, x in tail.scan()] == ["one", "two"]
    with (tmp_path / "a.log").open("ab") as f:
        f.write(b"ial\nlast\n")
    assert [x for _, x in tail.scan()] == ["partial", "last"] and list(tail.scan()) == []
    (tmp_path / "a.log").write_bytes(b"new\n")
    assert [x for _, x in tail.scan()] == ["new"] and len(tail.truncated) == 1


def test_questions():
    ok = dict(start="2026-01-01", end="2026-01-02T00:00:00+07:00")
    assert forensic.question(service="Meta", **ok).dst_asns == (32934,) and forensic.question(dst_ip="1.1.1.1", **ok).end.hour == 17
    centre = forensic.question(dst_org="x", around="2026-01-01 12:00:00", window=timedelta(minutes=30))
    assert (centre.end - centre.start) == timedelta(minutes=30)
    for bad in (dict(ok), dict(ok, dst_ip="x"), dict(ok, dst_ip="1.1.1.1", dst_org="y"), dict(dst_ip="1.1.1.1"), dict(ok, dst_ip="1.1.1.1", around="2026-01-01"), dict(ok, service="nope"), dict(ok, dst_asn=1, src_ip="z"), dict(ok, dst_asn=1, limit=0), dict(ok, who=True), dict(ok, who=True, qname="."), dict(ok, who=True, qname="a", dst_ip="1.1.1.1"), dict(ok, who=True, dst_org="a"), dict(dst_asn=1, start="2026-01-02", end="2026-01-01"), dict(dst_asn=1, around="soon")):
        with pytest.raises(forensic.FilterError):
            forensic.question(**bad)


def test_hostile_text_is_a_literal(spark):
    df = spark.createDataFrame([("x' OR 1=1 --", "a.b"), ("y", "ab")], "dst_org string, q string")
    assert df.where(forensic.org_contains("dst_org", "' or 1=1")).count() == 1 and df.where(forensic.under_domain("q", "b")).count() == 1


def test_render(spark):
    rows = spark.createDataFrame([("c", "", "u", True, False), ("d", "", "", False, False)], "client_ip string, mac_token string, user_token string, mac_ambiguous boolean, user_ambiguous boolean")
    text = forensic.render(rows)
    assert "ambiguous at that time" in text and "unknown at that time" in text and '"mac_ambiguous": true' in forensic.render(rows, as_json=True)


def test_capture_report(spark):
    from test_parsers import PACKETS
    from test_parsers import lines as text_lines

    df = text_lines(spark, PACKETS)
    r = capture.counters(df, "2026-03-01", "UTC", "10.0.0.3").first()
    assert (r.packets, r.queries, r.client_queries, r.responses, r.nxdomain, r.events, r.query_only, r.fallback, r.answers_a, r.answers_aaaa, r.errors) == (12, 5, 4, 4, 1, 7, 3, 1, 2, 1, 1)
    assert "10.9.8.21" not in capture.report(df, "2026-03-01", "UTC", "10.0.0.3")


def test_privacy_no_raw_identifier_leaves(spark):
    from flowquarry.functions.identifiers import Identity
    from flowquarry.sources import logs
    from test_parsers import lines as text_lines
    from test_parsers import radius

    hashed = Identity("hashed", b"k")
    rows = logs.radius_events(text_lines(spark, radius("1")), hashed).collect() + logs.dhcp_events(text_lines(spark, "10,01/02/26,03:04:05,Assign,10.0.0.5,Host.example.com,AABBCCDDEEFF,"), hashed).collect()
    text = str(rows).lower()
    assert "ann" not in text and "aabbccddeeff" not in text and "host.example" not in text


def test_rollups_add_up(spark):
    df = queries.flows(spark, "/root/testdata/sf0.001")
    hours = rollup.rollup(df, "hour")
    assert hours.exceptAll(rollup.coarser(rollup.rollup(df, "minute"), "hour")).isEmpty()
    assert dashboards.tenant_traffic(df).count() == 4
