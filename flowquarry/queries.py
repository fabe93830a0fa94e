"""The registered queries of the engine, on flows, leases, sessions and DNS events drawn from ``events``.

The driver's tables hold no network data, so ``events`` is projected: each row is a flow, sign-ups
and views open a lease (a session) and errors close it, views are DNS answers. Each query has the
same rows as a DuckDB statement in ORACLES, which spells the projection in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import identifiers, net
from .operators import dedup, enrich, rollup, temporal
from .plans import capture, dashboards, forensic
from .sources import dimensions, logs
from .sources import flows as flow_source

Query = Callable[[SparkSession, str], DataFrame]

#: Tenants' networks: id, name, network.
TENANTS = ((1, "campus", "10.0.0.0/16"), (2, "labs", "10.0.2.0/23"), (3, "dorm", "10.0.3.128/25"), (4, "servers", "203.0.113.0/27"), (5, "edge", "203.0.113.8/29"))
#: Threat list: address, label.
THREATS = (("203.0.113.5", "botnet"), ("10.0.1.17", "scanner"), ("203.0.113.9", ""))
#: Ranges of addresses: first, last, country, city, lat, lon, asn, organisation.
GEO = (
    ("203.0.113.0", "203.0.113.7", "TH", "Bangkok", 13.75, 100.5, 64500, "Org A"),
    ("203.0.113.8", "203.0.113.15", "SG", "Singapore", 1.25, 103.75, 64501, "Org B"),
    ("203.0.113.16", "203.0.113.23", "", "", 0.0, 0.0, 64502, "Org C"),
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows as they come: event_id, timestamp, addresses, ports, volumes, rate."""
    user, event = F.col("user_id"), F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("long")
    return events(spark, sf_dir).select(
        "event_id", F.col("ts").alias("timestamp"), F.concat(F.lit("10.0."), user % 8, F.lit("."), user % 250).alias("src_ip"), F.concat(F.lit("203.0.113."), event % 32).alias("dst_ip"),
        (1024 + user % 500).alias("src_port"), k.alias("dst_port"), F.col("event_type").alias("protocol"), F.round(F.col("value") * 100).cast("long").alias("bytes"), (1 + event % 9).alias("packets"), (k % 4).alias("sampling_rate"),
        F.lit("10.0.0.1").alias("exporter_ip"), F.lit("NETFLOW_V9").alias("flow_type"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with cheap stand-ins for looked-up columns."""
    n = F.col("event_id")
    country = lambda c: F.element_at(F.array(*[F.lit(x) for x in ("TH", "SG", "US", "")]), (c % 4 + 1).cast("int"))
    return raw_flows(spark, sf_dir).withColumns({
        "tenant_id": n % 5, "tenant_name": F.when(n % 5 == 0, "").otherwise(F.concat(F.lit("t"), n % 5)), "dst_tenant_name": F.when(n % 3 == 0, "").otherwise(F.concat(F.lit("t"), n % 3)),
        "src_country": country(n), "dst_country": country(n + F.col("dst_port")), "dst_asn": F.when(n % 7 == 0, 0).otherwise(15160 + n % 12), "dst_org": F.concat(F.lit("Org "), n % 12),
    })


def tenant_table(spark: SparkSession, networks: tuple = TENANTS) -> DataFrame:
    return spark.createDataFrame(dimensions.tenant_rows(list(networks)), dimensions.TENANTS)


def threat_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(THREATS), "ip string, label string")


def geo_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    df = spark.createDataFrame(list(GEO), "a string, b string, country string, city string, lat double, lon double, asn long, org string")
    number = [net.v4_number(F.col("a")).alias("first"), net.v4_number(F.col("b")).alias("last")]
    return df.select(*number, "country", "city", "lat", "lon"), df.select(*number, "asn", "org")


def dhcp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leases: coarse times and few devices, so that ties, handovers and releases occur."""
    kind = F.when(F.col("event_type") == "signup", 10).when(F.col("event_type") == "view", 11).when(F.col("event_type") == "error", 12)
    k = F.get_json_object("props", "$.k").cast("long")
    return events(spark, sf_dir).where(kind.isNotNull()).select(F.date_trunc("day", "ts").alias("event_time"), kind.alias("event_id"), F.concat(F.lit("10.0.0."), k).alias("ip"), F.concat(F.lit("m"), F.col("user_id") % 5).alias("mac_token"), F.lit("").alias("host_token"))


def radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "Start").when(F.col("event_type") == "view", "Interim-Update").when(F.col("event_type") == "error", "Stop")
    k = F.get_json_object("props", "$.k").cast("long")
    return events(spark, sf_dir).where(kind.isNotNull()).select(F.date_trunc("day", "ts").alias("event_time"), kind.alias("acct_status"), F.concat(F.lit("s"), F.col("user_id") % 7).alias("session_id"), F.concat(F.lit("u"), F.col("user_id") % 3).alias("user_token"), F.concat(F.lit("m"), k % 20).alias("mac_token"), F.lit("10.0.0.1").alias("nas_ip"))


def dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DNS events: views answer, purchases only ask."""
    k = F.get_json_object("props", "$.k").cast("long")
    answered = F.col("event_type") == "view"
    return events(spark, sf_dir).where(F.col("event_type").isin("view", "purchase")).select(
        F.date_trunc("second", "ts").alias("event_time"), F.concat(F.lit("10.0.0."), k).alias("client_ip"), (1024 + F.col("user_id") % 500).cast("int").alias("client_port"),
        F.concat(F.lit("h"), F.col("user_id") % 20, F.lit(".example.com")).alias("qname"), F.when(F.col("event_id") % 3 == 0, "AAAA").otherwise("A").alias("qtype"),
        F.when(answered, F.concat(F.lit("203.0.113."), F.col("event_id") % 4)).otherwise("").alias("answer_ip"), F.when(answered, k * 60).otherwise(0).alias("ttl"),
    )


def _ntz(df: DataFrame) -> DataFrame:
    """Times as the driver's tables have them."""
    return df.select(*[F.col(f"`{n}`").cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(f"`{n}`") for n, t in df.dtypes])


WINDOW = dict(start="2024-01-05 00:00:00", end="2024-01-20 12:00:00")

_FLOWS = """
WITH ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
raw AS (
  SELECT event_id, ts AS timestamp, '10.0.' || (user_id % 8) || '.' || (user_id % 250) AS src_ip, '203.0.113.' || (event_id % 32) AS dst_ip,
    1024 + user_id % 500 AS src_port, k AS dst_port, event_type AS protocol, CAST(round(value * 100) AS BIGINT) AS bytes, 1 + event_id % 9 AS packets, k % 4 AS sampling_rate,
    '10.0.0.1' AS exporter_ip, 'NETFLOW_V9' AS flow_type FROM ev
), flows AS (
  SELECT *, event_id % 5 AS tenant_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE 't' || (event_id % 5) END AS tenant_name, CASE WHEN event_id % 3 = 0 THEN '' ELSE 't' || (event_id % 3) END AS dst_tenant_name,
    ['TH', 'SG', 'US', ''][event_id % 4 + 1] AS src_country, ['TH', 'SG', 'US', ''][(event_id + dst_port) % 4 + 1] AS dst_country, CASE WHEN event_id % 7 = 0 THEN 0 ELSE 15160 + event_id % 12 END AS dst_asn, 'Org ' || (event_id % 12) AS dst_org FROM raw
), dhcp AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS event_time, CASE event_type WHEN 'signup' THEN 10 WHEN 'view' THEN 11 ELSE 12 END AS event_id, '10.0.0.' || k AS ip, 'm' || (user_id % 5) AS mac_token FROM ev WHERE event_type IN ('signup', 'view', 'error')
), radius AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS event_time, CASE event_type WHEN 'signup' THEN 'Start' WHEN 'view' THEN 'Interim-Update' ELSE 'Stop' END AS acct_status, 's' || (user_id % 7) AS session_id, 'u' || (user_id % 3) AS user_token, 'm' || (k % 20) AS mac_token FROM ev WHERE event_type IN ('signup', 'view', 'error')
), dns AS (
  SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_time, '10.0.0.' || k AS client_ip, CAST(1024 + user_id % 500 AS INTEGER) AS client_port, 'h' || (user_id % 20) || '.example.com' AS qname, CASE WHEN event_id % 3 = 0 THEN 'AAAA' ELSE 'A' END AS qtype,
    CASE WHEN event_type = 'view' THEN '203.0.113.' || (event_id % 4) ELSE '' END AS answer_ip, CASE WHEN event_type = 'view' THEN k * 60 ELSE 0 END AS ttl FROM ev WHERE event_type IN ('view', 'purchase')
)"""

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str | None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that follows the projection."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = lambda spark, sf_dir: _ntz(function(spark, sf_dir))
        if oracle is not None:
            ORACLES[function.__name__] = f"{_FLOWS}\n{oracle}" if not oracle.lstrip().startswith("WITH RECURSIVE") else f"{_FLOWS.replace('WITH ev', 'WITH RECURSIVE ev', 1)}, {oracle.lstrip().removeprefix('WITH RECURSIVE ')}"
        return function

    return register


_FLOW_LIST = "timestamp, src_ip, src_port, dst_ip, dst_port, protocol, bytes, dst_asn, dst_org, exporter_ip, tenant_name"
_BETWEEN = "BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'"


@_query(f"SELECT {_FLOW_LIST} FROM flows WHERE timestamp {_BETWEEN} AND dst_ip = '203.0.113.5' ORDER BY ALL LIMIT 200")
def flows_by_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forensic.flows_to(flows(spark, sf_dir), forensic.question(dst_ip="203.0.113.5", limit=200, **WINDOW))


@_query(f"SELECT {_FLOW_LIST} FROM flows WHERE timestamp {_BETWEEN} AND dst_asn IN (15169) AND src_ip = '10.0.3.3' ORDER BY ALL LIMIT 1000")
def service_asn_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forensic.flows_to(flows(spark, sf_dir), forensic.question(service=" Google ", src_ip="10.0.3.3", **WINDOW))


@_query(f"SELECT {_FLOW_LIST} FROM flows WHERE timestamp BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 06:00:00' AND contains(lower(dst_org), 'rg 1') ORDER BY ALL LIMIT 500")
def org_substring_around(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forensic.flows_to(flows(spark, sf_dir), forensic.question(dst_org="RG 1", around="2024-01-11 06:00:00", window=timedelta(days=2), limit=500))


@_query("SELECT event_id, CAST(sampling_rate > 1 AS INTEGER) AS is_sampled, CASE WHEN sampling_rate > 1 THEN bytes * sampling_rate ELSE 0 END AS expanded_bytes, CASE WHEN sampling_rate > 1 THEN packets * sampling_rate ELSE 0 END AS expanded_packets FROM raw")
def sampling_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_sampling(raw_flows(spark, sf_dir)).select("event_id", "is_sampled", "expanded_bytes", "expanded_packets")


_NETS = ", ".join(f"({i}, '{name}', {a}, {b}, {length})" for i, name, network in TENANTS for a, b, length in [net.cidr(network)])
_NUMBER = "(CAST(split_part({0}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({0}, '.', 2) AS BIGINT) * 65536 + CAST(split_part({0}, '.', 3) AS BIGINT) * 256 + CAST(split_part({0}, '.', 4) AS BIGINT))"
_LPM = f"""
SELECT event_id, coalesce(arg_max(s.i, s.len), 0) AS tenant_id, coalesce(arg_max(s.name, s.len), '') AS tenant_name, coalesce(arg_max(d.i, d.len), 0) AS dst_tenant_id, coalesce(arg_max(d.name, d.len), '') AS dst_tenant_name, any_value(bytes) AS bytes
FROM raw LEFT JOIN net s ON {_NUMBER.format('src_ip')} BETWEEN s.a AND s.b LEFT JOIN net d ON {_NUMBER.format('dst_ip')} BETWEEN d.a AND d.b GROUP BY event_id"""


def _with_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = enrich.with_tenant(raw_flows(spark, sf_dir), tenant_table(spark), "src_ip", "")
    return enrich.with_tenant(both, tenant_table(spark), "dst_ip", "dst_")


@_query(f", net(i, name, a, b, len) AS (VALUES {_NETS}), lpm AS ({_LPM}) SELECT event_id, CAST(tenant_id AS BIGINT) AS tenant_id, tenant_name, CAST(dst_tenant_id AS BIGINT) AS dst_tenant_id, dst_tenant_name FROM lpm")
def tenant_lpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_tenants(spark, sf_dir).select("event_id", "tenant_id", "tenant_name", "dst_tenant_id", "dst_tenant_name")


@_query(f""", net(i, name, a, b, len) AS (VALUES {_NETS}), lpm AS ({_LPM}), both_ways AS (
  SELECT tenant_name AS tenant, 'out' AS way, count(*) AS f, sum(bytes) AS b FROM lpm WHERE tenant_name <> '' GROUP BY 1 UNION ALL SELECT dst_tenant_name, 'in', count(*), sum(bytes) FROM lpm WHERE dst_tenant_name <> '' GROUP BY 1)
SELECT tenant, CAST(coalesce(sum(f) FILTER (way = 'out'), 0) AS BIGINT) AS outbound_flows, CAST(coalesce(sum(b) FILTER (way = 'out'), 0) AS BIGINT) AS outbound_bytes, CAST(coalesce(sum(f) FILTER (way = 'in'), 0) AS BIGINT) AS inbound_flows, CAST(coalesce(sum(b) FILTER (way = 'in'), 0) AS BIGINT) AS inbound_bytes
FROM both_ways GROUP BY tenant ORDER BY outbound_bytes + inbound_bytes DESC, tenant LIMIT 20""")
def tenant_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.tenant_traffic(_with_tenants(spark, sf_dir))


_TAGGED = ", threat(ip, label) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in THREATS) + "), tagged AS (SELECT raw.*, CAST(s.ip IS NOT NULL AS INTEGER) AS is_threat_src, CAST(d.ip IS NOT NULL AS INTEGER) AS is_threat_dst, CASE WHEN s.label <> '' THEN s.label WHEN d.ip IS NOT NULL THEN d.label ELSE '' END AS threat_label FROM raw LEFT JOIN threat s ON s.ip = src_ip LEFT JOIN threat d ON d.ip = dst_ip)"


@_query(f"{_TAGGED} SELECT event_id, is_threat_src, is_threat_dst, threat_label FROM tagged")
def threat_tagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_threats(raw_flows(spark, sf_dir), threat_table(spark)).select("event_id", "is_threat_src", "is_threat_dst", "threat_label")


@_query(f"{_TAGGED} SELECT count(*) AS flows, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(packets) AS BIGINT) AS packets, count(*) FILTER (is_threat_src = 1 OR is_threat_dst = 1) AS threats FROM tagged")
def flow_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.totals(enrich.with_threats(raw_flows(spark, sf_dir), threat_table(spark)))


_GEO = ", ".join(f"({_NUMBER.format(repr(a))}, {_NUMBER.format(repr(b))}, '{c}', '{city}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE), {asn}, '{org}')" for a, b, c, city, lat, lon, asn, org in GEO)


@_query(f""", geo(a, b, country, city, lat, lon, asn, org) AS (VALUES {_GEO})
SELECT event_id, 'private' AS src_country, CASE WHEN geo.a IS NULL THEN '' WHEN country = '' THEN 'unknown' ELSE country END AS dst_country, coalesce(city, '') AS dst_city, coalesce(lat, 0.0) AS dst_lat, coalesce(lon, 0.0) AS dst_lon, CAST(coalesce(asn, 0) AS BIGINT) AS dst_asn, coalesce(org, '') AS dst_org
FROM raw LEFT JOIN geo ON {_NUMBER.format('dst_ip')} BETWEEN geo.a AND geo.b""")
def geo_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    city, asn = geo_tables(spark)
    out = enrich.with_geo(enrich.with_geo(raw_flows(spark, sf_dir), city, asn, "src"), city, asn, "dst")
    return out.select("event_id", "src_country", "dst_country", "dst_city", "dst_lat", "dst_lon", "dst_asn", "dst_org")


@_query("""SELECT event_id, ip, split_part(ip, '.', 1) IN ('10', '127') OR (split_part(ip, '.', 1) = '192' AND split_part(ip, '.', 2) = '168') OR (split_part(ip, '.', 1) = '169' AND split_part(ip, '.', 2) = '254') OR (split_part(ip, '.', 1) = '172' AND CAST(split_part(ip, '.', 2) AS INTEGER) BETWEEN 16 AND 31) AS private
FROM (SELECT event_id, (['10', '127', '172', '192', '169', '8'][event_id % 6 + 1]) || '.' || (['16', '31', '32', '168', '254'][event_id % 5 + 1]) || '.' || (k % 256) || '.1' AS ip FROM ev)""")
def private_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("event_id") % len(xs) + 1).cast("int"))
    k = F.get_json_object("props", "$.k").cast("long")
    ip = F.concat(pick(["10", "127", "172", "192", "169", "8"]), F.lit("."), pick(["16", "31", "32", "168", "254"]), F.lit("."), k % 256, F.lit(".1"))
    return events(spark, sf_dir).select("event_id", ip.alias("ip")).withColumn("private", net.is_private(F.col("ip")))


_ROLLUP = "SELECT CAST(date_trunc('{0}', timestamp) AS TIMESTAMP) AS timestamp, tenant_id, src_country, dst_country, protocol, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(packets) AS BIGINT) AS packets, count(*) AS flow_count FROM flows GROUP BY ALL"


@_query(_ROLLUP.format("minute"))
def rollup_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rollup(flows(spark, sf_dir), "minute")


@_query(_ROLLUP.format("hour"))
def rollup_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rollup(flows(spark, sf_dir), "hour")


@_query(_ROLLUP.format("hour"))
def rollup_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial minute rows of two halves, merged, then hours of them: equal to the hours of all flows."""
    all_ = flows(spark, sf_dir)
    halves = [rollup.rollup(all_.where(F.col("event_id") % 2 == i), "minute") for i in (0, 1)]
    return rollup.coarser(rollup.merged(halves[0].unionByName(halves[1])), "hour")


_MINUTE = f", m AS ({_ROLLUP.format('minute')})"


@_query(f"{_MINUTE} SELECT timestamp AS time, sum(flow_count) / 60 AS flows_per_sec FROM m GROUP BY 1")
def flows_per_sec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.per_second(rollup.rollup(flows(spark, sf_dir), "minute"), "flow_count", "flows_per_sec")


@_query(f"{_MINUTE} SELECT timestamp AS time, sum(bytes) / 60 AS bytes_per_sec FROM m GROUP BY 1")
def bytes_per_sec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.per_second(rollup.rollup(flows(spark, sf_dir), "minute"), "bytes", "bytes_per_sec")


@_query(f"{_MINUTE} SELECT protocol, CAST(sum(flow_count) AS BIGINT) AS flows FROM m WHERE protocol <> '' GROUP BY 1")
def protocol_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.protocol_mix(rollup.rollup(flows(spark, sf_dir), "minute"))


@_query(f"{_MINUTE} SELECT dst_country, CAST(sum(flow_count) AS BIGINT) AS flows FROM m WHERE dst_country <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.top_countries(rollup.rollup(flows(spark, sf_dir), "minute"))


@_query("SELECT src_ip, count(*) AS flows, CAST(sum(bytes) AS BIGINT) AS bytes FROM flows GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 20")
def top_talkers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.top_talkers(flows(spark, sf_dir))


@_query("SELECT dst_asn, max(dst_org) AS org, count(*) AS flows, CAST(sum(bytes) AS BIGINT) AS bytes FROM flows WHERE dst_asn <> 0 GROUP BY 1 ORDER BY 4 DESC, 1 LIMIT 20")
def top_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.top_orgs(flows(spark, sf_dir))


@_query("SELECT count(*) AS events, count(DISTINCT client_ip) AS clients, count(DISTINCT qname) AS domains, count(DISTINCT nullif(answer_ip, '')) AS answer_ips FROM dns")
def dns_unique_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.dns_counts(dns(spark, sf_dir))


@_query("SELECT CAST(date_trunc('minute', event_time) AS TIMESTAMP) AS time, count(*) / 60 AS events_per_sec FROM dns GROUP BY 1")
def dns_per_sec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.dns_per_second(dns(spark, sf_dir))


@_query("SELECT qtype, count(*) AS events FROM dns GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8")
def dns_query_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.query_types(dns(spark, sf_dir))


@_query("SELECT qname, count(*) AS events, count(DISTINCT client_ip) AS clients FROM dns GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def dns_top_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.top_domains(dns(spark, sf_dir))


_SEEN = "strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last_seen"


@_query(f"SELECT answer_ip, count(*) AS resolutions, count(DISTINCT client_ip) AS clients, {_SEEN} FROM dns WHERE qname = 'h3.example.com' AND answer_ip <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def dns_answers_for_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.answers_for(dns(spark, sf_dir), "h3.example.com")


@_query(f"SELECT client_ip, count(*) AS resolutions, {_SEEN} FROM dns WHERE qname = 'h3.example.com' AND answer_ip = '203.0.113.1' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
def dns_clients_for_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.clients_for(dns(spark, sf_dir), "h3.example.com", "203.0.113.1")


@_query("SELECT DISTINCT event_time, event_id, ip, mac_token, '' AS host_token FROM dhcp")
def event_set_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tables import as_set

    return as_set(dhcp(spark, sf_dir))


@_query("""WITH RECURSIVE pick AS (
  SELECT ts AS timestamp, user_id, event_type, min(event_id) AS event_id FROM ev GROUP BY ALL
), numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY timestamp) AS rn FROM pick
), fold AS (
  SELECT user_id, event_type, rn, timestamp, event_id, timestamp AS last, TRUE AS kept FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.user_id, n.event_type, n.rn, n.timestamp, n.event_id, CASE WHEN n.timestamp > f.last + INTERVAL 6 HOUR THEN n.timestamp ELSE f.last END, n.timestamp > f.last + INTERVAL 6 HOUR
  FROM fold f JOIN numbered n ON n.user_id = f.user_id AND n.event_type = f.event_type AND n.rn = f.rn + 1
) SELECT event_id, user_id, event_type, timestamp FROM fold WHERE kept""")
def ttl_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "user_id", "event_type", F.col("ts").alias("timestamp"))
    return dedup.first_in_ttl(rows, ["user_id", "event_type"], "timestamp", 6 * 3600, ["event_id"])


_ASOF = """, mark AS (
  SELECT client_ip, answer_ip, event_time, max(qname) AS qname, arg_max(greatest(60, least(3600, ttl)), (qname, greatest(60, least(3600, ttl)))) AS ttl FROM dns WHERE answer_ip <> '' GROUP BY 1, 2, 3
), asked AS (SELECT event_id, timestamp, '10.0.0.' || dst_port AS src_ip, '203.0.113.' || (event_id % 4) AS dst_ip FROM raw)
SELECT a.event_id, CASE WHEN a.timestamp <= m.event_time + to_seconds(m.ttl) THEN m.qname ELSE '' END AS dst_hostname FROM asked a ASOF LEFT JOIN mark m ON a.src_ip = m.client_ip AND a.dst_ip = m.answer_ip AND a.timestamp >= m.event_time"""


@_query(_ASOF)
def dns_asof_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = raw_flows(spark, sf_dir).select("event_id", "timestamp", F.concat(F.lit("10.0.0."), "dst_port").alias("src_ip"), F.concat(F.lit("203.0.113."), F.col("event_id") % 4).alias("dst_ip"))
    return temporal.dns_as_of(asked, "src_ip", "dst_ip", "timestamp", dns(spark, sf_dir), "dst_hostname").select("event_id", "dst_hostname")


#: Closed form in SQL; questions are the purchases.
_BIND = """, q AS (SELECT event_id AS qid, {ask} AS key, ts AS t FROM ev WHERE event_type = 'purchase'),
top AS (SELECT qid, q.key, t, max(o.event_time) AS opened FROM q JOIN {table} o ON o.{key} = q.key AND o.event_time <= t AND {opens} GROUP BY 1, 2, 3),
live AS (
  SELECT DISTINCT qid, o.{entity} AS entity, o.{value} AS value FROM top JOIN {table} o ON o.{key} = top.key AND o.event_time = top.opened AND {opens}
  WHERE t <= opened + INTERVAL 3 DAY AND NOT EXISTS (SELECT 1 FROM {table} c WHERE c.{key} = top.key AND c.{entity} = o.{entity} AND NOT ({closes}) AND c.event_time >= top.opened AND c.event_time <= top.t)
), answer AS (SELECT qid, count(DISTINCT entity) AS e, count(DISTINCT value) AS v, max(value) AS value FROM live GROUP BY qid)
SELECT q.qid AS event_id, q.key, CASE WHEN e = 1 AND v = 1 THEN value ELSE '' END AS {name}, coalesce(e > 1 OR v > 1, FALSE) AS ambiguous FROM q LEFT JOIN answer ON q.qid = answer.qid"""


def _questions(spark: SparkSession, sf_dir: str, key) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return events(spark, sf_dir).where("event_type = 'purchase'").select("event_id", key(k).alias("key"), F.col("ts").alias("t"))


@_query(_BIND.format(ask="'10.0.0.' || k", table="dhcp", key="ip", entity="mac_token", value="mac_token", opens="o.event_id IN (10, 11)", closes="c.event_id IN (10, 11)", name="mac_token"))
def lease_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _questions(spark, sf_dir, lambda k: F.concat(F.lit("10.0.0."), k))
    return temporal.as_of(asked, "key", "t", temporal.lease_intervals(dhcp(spark, sf_dir), timedelta(days=3)), "mac_token", "ambiguous").drop("t")


@_query(_BIND.format(ask="'m' || (k % 20)", table="radius", key="mac_token", entity="session_id", value="user_token", opens="o.acct_status <> 'Stop'", closes="c.acct_status <> 'Stop'", name="user_token"))
def session_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _questions(spark, sf_dir, lambda k: F.concat(F.lit("m"), k % 20))
    return temporal.as_of(asked, "key", "t", temporal.session_intervals(radius(spark, sf_dir), timedelta(days=3)), "user_token", "ambiguous").drop("t")


_WHO = f""", cand AS (
  SELECT client_ip, qname, answer_ip, count(*) AS resolutions, min(event_time) AS first_seen, max(event_time) AS last_seen FROM (SELECT DISTINCT * FROM dns WHERE event_time {_BETWEEN})
  WHERE qname = 'h3.example.com' OR suffix(qname, '.h3.example.com') GROUP BY 1, 2, 3 ORDER BY client_ip, last_seen, qname, answer_ip LIMIT 1000
), lease AS (SELECT * FROM dhcp WHERE event_time BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'),
sess AS (SELECT * FROM radius WHERE event_time BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'),
ltop AS (SELECT c.*, (SELECT max(event_time) FROM lease o WHERE o.ip = c.client_ip AND o.event_id IN (10, 11) AND o.event_time <= c.last_seen) AS opened FROM cand c),
llive AS (SELECT DISTINCT client_ip, qname, answer_ip, o.mac_token AS mac FROM ltop JOIN lease o ON o.ip = client_ip AND o.event_time = opened AND o.event_id IN (10, 11)
  WHERE last_seen <= opened + INTERVAL 3 DAY AND NOT EXISTS (SELECT 1 FROM lease x WHERE x.ip = client_ip AND x.mac_token = o.mac_token AND x.event_id = 12 AND x.event_time BETWEEN opened AND last_seen)),
lans AS (SELECT client_ip, qname, answer_ip, count(*) AS n, max(mac) AS mac FROM llive GROUP BY 1, 2, 3),
dev AS (SELECT cand.*, CASE WHEN n = 1 THEN mac ELSE '' END AS mac_token, coalesce(n > 1, FALSE) AS mac_ambiguous FROM cand LEFT JOIN lans USING (client_ip, qname, answer_ip)),
stop AS (SELECT d.*, (SELECT max(event_time) FROM sess o WHERE o.mac_token = d.mac_token AND o.acct_status <> 'Stop' AND o.event_time <= d.last_seen) AS opened FROM dev d),
slive AS (SELECT DISTINCT client_ip, qname, answer_ip, o.session_id, o.user_token AS usr FROM stop s JOIN sess o ON o.mac_token = s.mac_token AND o.event_time = opened AND o.acct_status <> 'Stop'
  WHERE last_seen <= opened + INTERVAL 3 DAY AND NOT EXISTS (SELECT 1 FROM sess x WHERE x.mac_token = s.mac_token AND x.session_id = o.session_id AND x.acct_status = 'Stop' AND x.event_time BETWEEN opened AND last_seen)),
sans AS (SELECT client_ip, qname, answer_ip, count(DISTINCT session_id) AS e, count(DISTINCT usr) AS u, max(usr) AS usr FROM slive GROUP BY 1, 2, 3)
SELECT client_ip, qname, answer_ip, resolutions, first_seen, last_seen, mac_token, CASE WHEN e = 1 AND u = 1 THEN usr ELSE '' END AS user_token, mac_ambiguous, coalesce(e > 1 OR u > 1, FALSE) AS user_ambiguous FROM dev LEFT JOIN sans USING (client_ip, qname, answer_ip)"""


@_query(_WHO)
def who_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = forensic.question(who=True, qname="H3.example.com.", **WINDOW)
    return forensic.who_resolved(dns(spark, sf_dir), dhcp(spark, sf_dir), radius(spark, sf_dir), q, timedelta(days=3), timedelta(days=3))


@_query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN mac12 WHEN 1 THEN mac12 WHEN 2 THEN mac12 ELSE '' END AS mac, usr AS "user", 'h' || event_id || '.example.com' AS host
FROM (SELECT event_id, lpad(printf('%x', event_id), 12, '0') AS mac12, 'u' || user_id AS usr FROM ev)""")
def normalize_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of one device, account and name come to one form."""
    digits = F.lpad(F.upper(F.hex("event_id")), 12, "0")
    pairs = F.regexp_extract_all(digits, F.lit("(..)"), F.lit(1))
    kind = F.col("event_id") % 4
    mac = F.when(kind == 0, F.array_join(pairs, "-")).when(kind == 1, F.array_join(pairs, ":")).when(kind == 2, F.concat(F.array_join(pairs, "-"), F.lit(":Guest-Net"))).otherwise("no device")
    user = F.when(kind < 2, F.concat(F.lit("DOM\\U"), "user_id")).otherwise(F.concat(F.lit(" U"), "user_id", F.lit("@realm.example ")))
    host = F.concat(F.lit(" H"), "event_id", F.lit(".Example.COM. "))
    return events(spark, sf_dir).select("event_id", identifiers.normal_mac(mac).alias("mac"), identifiers.normal_user(user).alias("user"), identifiers.normal_host(host).alias("host"))


@_query("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '' ELSE 'set' END AS token_kind FROM ev")
def token_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed tokens exist for what is there and are '' for what is not."""
    token = identifiers.tokenizer(b"test key")(F.when(F.col("event_id") % 10 == 0, "").otherwise(F.concat(F.lit("user"), "user_id")))
    return events(spark, sf_dir).select("event_id", F.when(token == "", "").when(F.length(token) == 32, "set").otherwise("bad").alias("token_kind"))


@_query("SELECT timestamp, src_ip, dst_ip, src_port, dst_port, protocol, bytes, packets, exporter_ip, flow_type FROM (SELECT CAST(date_trunc('second', timestamp) AS TIMESTAMP) AS timestamp, src_ip, dst_ip, src_port, dst_port, protocol, bytes, packets, exporter_ip, flow_type, event_id FROM raw) WHERE event_id % 10 <> 0")
def decode_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows written as JSON messages, a tenth of them broken, and decoded again."""
    ns = F.unix_micros("timestamp") * 1000
    record = F.struct(F.when(F.col("event_id") % 2 == 0, ns).otherwise(0).alias("time_flow_start_ns"), ns.alias("time_received_ns"), F.col("src_ip").alias("src_addr"), F.col("dst_ip").alias("dst_addr"), "src_port", "dst_port", F.col("protocol").alias("proto"), "bytes", "packets", F.col("exporter_ip").alias("sampler_address"), F.col("flow_type").alias("type"), F.lit("ignored").alias("extra_key"))
    text = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{broken"), F.to_json(record))).otherwise(F.to_json(record))
    good, _ = flow_source.decode(raw_flows(spark, sf_dir).select(text.alias("value")))
    return enrich.flat(good).drop("sampling_rate")


@_query("SELECT status, count(*) AS n, count(DISTINCT ip) AS ips FROM (SELECT CASE WHEN event_id % 7 = 0 THEN 'error' WHEN event_type IN ('signup', 'view', 'error') THEN 'event' ELSE 'skip' END AS status, '10.0.0.' || k AS ip FROM ev) GROUP BY status")
def parse_dhcp_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as audit-log lines, a seventh with a bad date, and parsed."""
    kind = F.when(F.col("event_id") % 7 == 0, "10").when(F.col("event_type") == "signup", "10").when(F.col("event_type") == "view", "11").when(F.col("event_type") == "error", "12").otherwise("24")
    day = F.when(F.col("event_id") % 7 == 0, "99/99/99").otherwise(F.date_format("ts", "MM/dd/yy"))
    k = F.get_json_object("props", "$.k")
    line = F.concat_ws(",", kind, day, F.date_format("ts", "HH:mm:ss"), F.lit("text"), F.concat(F.lit("10.0.0."), k), F.lit("host.example.com"), F.lit("AABBCCDDEEFF"), F.lit(""))
    parsed = logs.dhcp_events(events(spark, sf_dir).select(line.alias("line")), identifiers.Identity("passthrough"))
    return parsed.groupBy("status").agg(F.count("*").alias("n"), F.count_distinct("ip").alias("ips"))


@_query("SELECT qname, qtype, answer_ip, ttl, count(*) AS n FROM (SELECT 'h' || (user_id % 20) || '.example.com' AS qname, CASE WHEN event_type = 'view' THEN 'A' ELSE 'TXT' END AS qtype, CASE WHEN event_type = 'view' THEN '203.0.113.' || (event_id % 4) ELSE '' END AS answer_ip, CASE WHEN event_type = 'view' THEN k ELSE 0 END AS ttl FROM ev WHERE event_type IN ('view', 'purchase', 'click')) GROUP BY ALL")
def parse_dns_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as resolver-log lines and parsed: answers, answers without an address, queries."""
    name = F.concat(F.lit("H"), F.col("user_id") % 20, F.lit(".Example.com."))
    k = F.get_json_object("props", "$.k")
    head = F.concat(F.date_format("ts", "dd-MMM-yyyy HH:mm:ss.SSS"), F.lit(" client @0x7f 10.0.0."), k, F.lit("#53535 ("), name, F.lit("): "))
    answer = F.concat(F.lit("response: "), name, F.lit(" IN A NOERROR "), name, F.lit(" "), k, F.lit(" IN A 203.0.113."), F.col("event_id") % 4)
    bare = F.concat(F.lit("response: "), name, F.lit(" IN TXT NXDOMAIN"))
    query = F.concat(F.lit("query: "), name, F.lit(" IN TXT +E(0)K (10.0.0.1)"))
    kind = F.col("event_type")
    line = F.concat(head, F.when(kind == "view", answer).when(kind == "purchase", bare).when(kind == "click", query).otherwise("lame-server"))
    parsed = logs.dns_text_events(events(spark, sf_dir).select(line.alias("line"))).where("status = 'event'")
    return parsed.groupBy("qname", "qtype", "answer_ip", "ttl").agg(F.count("*").alias("n"))


@_query("SELECT 'before' AS side, count(*) AS n_rows, count(DISTINCT (event_time, event_id, ip, mac_token)) AS n_distinct FROM dhcp UNION ALL SELECT 'after', count(*), count(*) FROM (SELECT DISTINCT event_time, event_id, ip, mac_token FROM dhcp)")
def migration_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tables import as_set, same_content

    return same_content(dhcp(spark, sf_dir), as_set(dhcp(spark, sf_dir)))


#: IPv6 networks of tenants, and ranges of addresses as in GEO.
TENANTS6 = ((1, "campus", "2001:db8::/32"), (2, "labs", "2001:db8:4::/46"), (3, "dorm", "2001:db8:5::/48"), (4, "servers", "10.0.0.0/8"))
GEO6 = (("2001:db8::", "2001:db8:3:ffff:ffff:ffff:ffff:ffff", "TH", "Bangkok", 13.75, 100.5, 64500, "Org A"), ("2001:db8:4::", "2001:db8:8:ffff:ffff:ffff:ffff:ffff", "", "", 0.0, 0.0, 64501, "Org B"))


def _v6_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows from a few IPv6 networks, one in 17 from outside, and every fifth from a mapped IPv4 address."""
    part = F.col("user_id") % 17
    six = F.when(part == 16, F.lit("2001:DEAD::1")).otherwise(F.concat(F.lit("2001:db8:"), F.lower(F.hex(part)), F.lit("::"), F.lower(F.hex(F.col("event_id") % 4096))))
    return events(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("::ffff:10.0.0."), F.col("event_id") % 200)).otherwise(six).alias("src_ip"))


_V6 = ", six AS (SELECT event_id, user_id % 17 AS part, event_id % 5 = 0 AS mapped FROM ev)"


@_query(f"{_V6} SELECT event_id, CAST(CASE WHEN mapped THEN 4 WHEN part = 16 THEN 0 WHEN part = 5 THEN 3 WHEN part BETWEEN 4 AND 7 THEN 2 ELSE 1 END AS BIGINT) AS tenant_id, CASE WHEN mapped THEN 'servers' WHEN part = 16 THEN '' WHEN part = 5 THEN 'dorm' WHEN part BETWEEN 4 AND 7 THEN 'labs' ELSE 'campus' END AS tenant_name FROM six")
def tenant_lpm_v6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_tenant(_v6_flows(spark, sf_dir), tenant_table(spark, TENANTS6), "src_ip", "").drop("src_ip")


@_query(f"""{_V6} SELECT event_id, CASE WHEN mapped THEN 'private' WHEN part <= 3 THEN 'TH' WHEN part <= 8 THEN 'unknown' ELSE '' END AS src_country, CASE WHEN NOT mapped AND part <= 3 THEN 'Bangkok' ELSE '' END AS src_city,
CASE WHEN NOT mapped AND part <= 3 THEN 13.75::DOUBLE ELSE 0 END AS src_lat, CASE WHEN NOT mapped AND part <= 3 THEN 100.5::DOUBLE ELSE 0 END AS src_lon,
CAST(CASE WHEN mapped THEN 0 WHEN part <= 3 THEN 64500 WHEN part <= 8 THEN 64501 ELSE 0 END AS BIGINT) AS src_asn, CASE WHEN mapped THEN '' WHEN part <= 3 THEN 'Org A' WHEN part <= 8 THEN 'Org B' ELSE '' END AS src_org FROM six""")
def geo_lookup_v6(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.createDataFrame(list(GEO6), "a string, b string, country string, city string, lat double, lon double, asn long, org string")
    city, asn = geo_tables(spark)
    city6, asn6 = (dimensions.networks6(table, "a", "b", values) for values in (["country", "city", "lat", "lon"], ["asn", "org"]))
    return enrich.with_geo(_v6_flows(spark, sf_dir), city, asn, "src", city6, asn6).drop("src_ip")


_V6_KINDS = (("fc00::", True), ("FD12:3456:", False), ("fe80::", False), ("2001:db8::", False), ("::ffff:10.1.2.", True), ("::ffff:8.8.8.", False), ("fdff::", True), ("fb00::", False))


@_query("SELECT event_id, [" + ", ".join(f"'{a}'" for a, _ in _V6_KINDS) + "][event_id % 8 + 1] || (event_id % 256) AS ip, [" + ", ".join(str(b) for _, b in _V6_KINDS) + "][event_id % 8 + 1] AS private FROM ev")
def private_classification_v6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique-local and mapped private addresses; the second form is no address at all."""
    head = F.element_at(F.array(*[F.lit(a) for a, _ in _V6_KINDS]), (F.col("event_id") % 8 + 1).cast("int"))
    return events(spark, sf_dir).select("event_id", F.concat(head, F.col("event_id") % 256).alias("ip")).withColumn("private", net.is_private(F.col("ip")))


_KEY = b"a key for tokens"
_PAD = lambda mask: "".join(f"\\x{x ^ mask:02X}" for x in _KEY.ljust(64, b"\0"))


@_query(f"SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '' ELSE left(sha256('{_PAD(0x5c)}'::BLOB || unhex(sha256('{_PAD(0x36)}'::BLOB || encode('user' || user_id)))), 32) END AS token FROM ev")
def token_hmac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of accounts, each written with a domain and in capitals."""
    user = F.when(F.col("event_id") % 10 == 0, "").otherwise(F.concat(F.lit("DOM\\USER"), "user_id"))
    return events(spark, sf_dir).select("event_id", identifiers.Identity("hashed", _KEY).user(user).alias("token"))


@_query("""SELECT status, acct_status, count(*) AS n, count(DISTINCT session_id) AS sessions, min(event_time) AS first_seen, max(event_time) AS last_seen
FROM (SELECT CASE WHEN event_type IN ('click', 'purchase') THEN 'skip' WHEN event_id % 7 = 0 THEN 'error' ELSE 'event' END AS status, CASE event_type WHEN 'signup' THEN 'Start' WHEN 'view' THEN 'Interim-Update' WHEN 'error' THEN 'Stop' ELSE '' END AS acct_status,
  's' || (user_id % 7) AS session_id, CASE WHEN event_type NOT IN ('click', 'purchase') AND event_id % 7 = 0 THEN NULL ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) - INTERVAL 7 HOUR END AS event_time FROM ev) GROUP BY 1, 2""")
def parse_radius_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as accounting records in local time, a seventh without a time, and parsed."""
    code = F.when(F.col("event_type") == "signup", "1").when(F.col("event_type") == "view", "Interim-Update").when(F.col("event_type") == "error", "2").otherwise("7")
    known = F.col("event_type").isin("signup", "view", "error")
    time = F.when(known & (F.col("event_id") % 7 == 0), "").otherwise(F.concat(F.lit('<Timestamp data_type="4">'), F.date_format("ts", "MM/dd/yyyy HH:mm:ss.SSS"), F.lit("</Timestamp>")))
    line = F.concat(F.lit("<Event>"), time, F.lit("<Acct-Status-Type>"), code, F.lit("</Acct-Status-Type><Acct-Session-Id>s"), F.col("user_id") % 7, F.lit("</Acct-Session-Id><User-Name>x</User-Name></Event>"))
    parsed = logs.radius_events(events(spark, sf_dir).select(line.alias("line")), identifiers.Identity("passthrough"), "Asia/Bangkok")
    return parsed.groupBy("status", "acct_status").agg(F.count("*").alias("n"), F.count_distinct("session_id").alias("sessions"), F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"))


def _capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as packet text of two lines: views are answers, errors answers of no such name, the others queries; clicks come from the resolver."""
    k, number = F.get_json_object("props", "$.k"), F.col("event_id")
    second = number % 43200
    clock = F.concat_ws(":", F.lpad((second / 3600).cast("int").cast("string"), 2, "0"), F.lpad((second % 3600 / 60).cast("int").cast("string"), 2, "0"), F.lpad((second % 60).cast("string"), 2, "0"))
    header = F.concat(clock, F.lit(".25 IP (tos 0x0, proto UDP (17), length 60)"))
    name, client = F.concat(F.lit("H"), F.col("user_id") % 20, F.lit(".Example.com.")), F.concat(F.lit("10.1.0."), k, F.lit(".40000"))
    ask = lambda who: F.concat(F.lit("    "), who, F.lit(" > 10.0.0.3.53: 5+ A? "), name, F.lit(" (35)"))
    reply = lambda rest: F.concat(F.lit("    10.0.0.3.53 > "), client, F.lit(": 5 "), rest)
    answer = F.concat(F.lit("1/0/0 "), name, F.lit(" A 203.0.113."), number % 4, F.lit(" (51)"))
    kind = F.col("event_type")
    payload = F.when(kind == "view", reply(answer)).when(kind == "error", reply(F.lit("NXDomain 0/1/0 (40)"))).when(kind == "click", ask(F.lit("10.0.0.3.40001"))).otherwise(ask(client))
    two = F.posexplode(F.array(header, payload)).alias("at", "line")
    return events(spark, sf_dir).select((number / 43200).cast("int").cast("string").alias("path"), "event_id", F.col("event_type"), two).select("path", (F.col("event_id") * 2 + F.col("at")).alias("line_no"), "line")


_CAPTURE = """, cap AS (SELECT event_type, TIMESTAMP '2024-03-01 00:00:00.25' + to_seconds(event_id % 43200) AS event_time, '10.1.0.' || k AS client_ip, 'h' || (user_id % 20) || '.example.com' AS qname, '203.0.113.' || (event_id % 4) AS ip FROM ev),
dnsev AS (SELECT event_time, client_ip, qname, CASE WHEN event_type = 'view' THEN ip ELSE '' END AS answer_ip, event_type FROM cap WHERE event_type NOT IN ('click', 'error'))"""


@_query(f"{_CAPTURE} SELECT event_time, client_ip, 40000 AS client_port, qname, 'A' AS qtype, answer_ip, event_type = 'view' AS ttl_unknown, count(*) AS n FROM dnsev GROUP BY ALL")
def parse_packet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = logs.dns_packet_events(_capture(spark, sf_dir), "2024-03-01", "UTC", "10.0.0.3").where("status = 'event'")
    return found.groupBy("event_time", "client_ip", "client_port", "qname", "qtype", "answer_ip", "ttl_unknown").agg(F.count("*").alias("n"))


@_query(f"""{_CAPTURE} SELECT (SELECT count(*) FROM ev) * 2 AS lines, (SELECT count(*) FROM ev) AS packets, (SELECT count(*) FROM cap WHERE event_type NOT IN ('view', 'error')) AS queries, (SELECT count(*) FROM cap WHERE event_type NOT IN ('view', 'error', 'click')) AS client_queries,
(SELECT count(*) FROM cap WHERE event_type IN ('view', 'error')) AS responses, (SELECT count(*) FROM cap WHERE event_type = 'error') AS nxdomain, CAST(0 AS BIGINT) AS servfail, count(*) AS events, count(*) FILTER (event_type <> 'view') AS query_only, CAST(0 AS BIGINT) AS fallback,
count(*) FILTER (event_type = 'view') AS answers_a, CAST(0 AS BIGINT) AS answers_aaaa, CAST(0 AS BIGINT) AS errors, count(DISTINCT client_ip) AS clients, count(DISTINCT qname) AS names, count(DISTINCT (client_ip, qname, answer_ip)) AS triples, min(event_time) AS first_seen, max(event_time) AS last_seen,
epoch(max(event_time)) - epoch(min(event_time)) AS span_seconds, (SELECT count(*) FROM cap WHERE event_type IN ('click', 'error')) AS skips, (SELECT count(*) FROM cap WHERE event_type NOT IN ('view', 'error', 'click')) / (epoch(max(event_time)) - epoch(min(event_time))) AS queries_per_sec FROM dnsev""")
def capture_report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.counters(_capture(spark, sf_dir), "2024-03-01", "UTC", "10.0.0.3")


@_query(f"{_CAPTURE} SELECT qname, count(*) AS n FROM dnsev WHERE event_type <> 'view' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def top_qnames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.top_names(_capture(spark, sf_dir), "2024-03-01", "UTC", "10.0.0.3")


@_query("SELECT 'h' || (user_id % 20) || '.example.com' AS qname, CASE WHEN event_type = 'view' THEN '203.0.113.' || (event_id % 4) ELSE '' END AS answer_ip, CASE WHEN event_type = 'view' THEN k ELSE 0 END AS ttl, min(ts) AS first_seen, count(*) AS n FROM ev WHERE event_type IN ('view', 'purchase') GROUP BY 1, 2, 3")
def parse_message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as multi-document messages, a file for each tenth of the accounts: answers, queries, and forwarded ones that don't count."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    name = F.concat(F.lit("H"), F.col("user_id") % 20, F.lit(".Example.com."))
    side = F.when(kind == "view", "response").otherwise("query")
    of = F.when(kind == "view", "CLIENT_RESPONSE").when(kind == "purchase", "CLIENT_QUERY").otherwise("FORWARDER_QUERY")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    block = F.array(
        F.lit("type: MESSAGE"), F.lit("message:"), text("  type: ", of), text("  ", side, "_time: !!timestamp ", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")), F.lit('  query_address: "10.0.0.9"'), F.lit("  query_port: 5000"),
        text("  ", side, "_message_data:"), F.lit("    QUESTION_SECTION:"), text("      - '", name, " IN A'"), F.lit("    ANSWER_SECTION:"), F.when(kind == "view", text("      - '", name, " ", k, " IN A 203.0.113.", F.col("event_id") % 4, "'")).otherwise("    x: y"), F.lit("---"),
    )
    lines = events(spark, sf_dir).select((F.col("user_id") % 10).cast("string").alias("path"), "event_id", F.posexplode(block).alias("at", "line")).select("path", (F.col("event_id") * 12 + F.col("at")).alias("line_no"), "line")
    found = logs.dns_message_events(lines).where("status = 'event'")
    return found.groupBy("qname", "answer_ip", "ttl").agg(F.min("event_time").alias("first_seen"), F.count("*").alias("n"))


def _two_hops(side: str, ip: str) -> str:
    return f"""{side}q AS (SELECT event_id AS qid, {ip} AS key, ts AS t FROM ev WHERE event_type = 'purchase'),
{side}top AS (SELECT qid, q.key, t, max(o.event_time) AS opened FROM {side}q q JOIN dhcp o ON o.ip = q.key AND o.event_time <= t AND o.event_id IN (10, 11) GROUP BY 1, 2, 3),
{side}live AS (SELECT DISTINCT qid, o.mac_token AS mac FROM {side}top x JOIN dhcp o ON o.ip = x.key AND o.event_time = x.opened AND o.event_id IN (10, 11)
  WHERE t <= opened + INTERVAL 3 DAY AND NOT EXISTS (SELECT 1 FROM dhcp c WHERE c.ip = x.key AND c.mac_token = o.mac_token AND c.event_id = 12 AND c.event_time >= x.opened AND c.event_time <= x.t)),
{side}dev AS (SELECT q.qid, t, CASE WHEN n = 1 THEN mac ELSE '' END AS mac, coalesce(n > 1, FALSE) AS mac_ambiguous FROM {side}q q LEFT JOIN (SELECT qid, count(*) AS n, max(mac) AS mac FROM {side}live GROUP BY 1) USING (qid)),
{side}stop AS (SELECT d.qid, d.mac, t, max(o.event_time) AS opened FROM {side}dev d JOIN radius o ON o.mac_token = d.mac AND o.event_time <= t AND o.acct_status <> 'Stop' GROUP BY 1, 2, 3),
{side}slive AS (SELECT DISTINCT qid, o.session_id, o.user_token AS usr FROM {side}stop x JOIN radius o ON o.mac_token = x.mac AND o.event_time = x.opened AND o.acct_status <> 'Stop'
  WHERE t <= opened + INTERVAL 3 DAY AND NOT EXISTS (SELECT 1 FROM radius c WHERE c.mac_token = x.mac AND c.session_id = o.session_id AND c.acct_status = 'Stop' AND c.event_time >= x.opened AND c.event_time <= x.t)),
{side}who AS (SELECT d.qid, mac AS {side}_mac_token, mac_ambiguous AS {side}_mac_ambiguous, CASE WHEN e = 1 AND u = 1 THEN usr ELSE '' END AS {side}_user_token, coalesce(e > 1 OR u > 1, FALSE) AS {side}_user_ambiguous FROM {side}dev d LEFT JOIN (SELECT qid, count(DISTINCT session_id) AS e, count(DISTINCT usr) AS u, max(usr) AS usr FROM {side}slive GROUP BY 1) USING (qid))"""


@_query(", " + _two_hops("src", "'10.0.0.' || k") + ", " + _two_hops("dst", "'10.0.0.' || ((k * 3) % 100)") + " SELECT qid AS event_id, src_mac_token, src_mac_ambiguous, src_user_token, src_user_ambiguous, dst_mac_token, dst_mac_ambiguous, dst_user_token, dst_user_ambiguous FROM srcwho JOIN dstwho USING (qid)")
def enrich_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device and then account of both sides of a flow at its time."""
    k = F.get_json_object("props", "$.k").cast("long")
    asked = events(spark, sf_dir).where("event_type = 'purchase'").select("event_id", F.col("ts").alias("timestamp"), F.concat(F.lit("10.0.0."), k).alias("src_ip"), F.concat(F.lit("10.0.0."), k * 3 % 100).alias("dst_ip"))
    leases, sessions = temporal.lease_intervals(dhcp(spark, sf_dir), timedelta(days=3)), temporal.session_intervals(radius(spark, sf_dir), timedelta(days=3))
    both = enrich.with_identity(enrich.with_identity(asked, leases, sessions, "src"), leases, sessions, "dst")
    return both.drop("timestamp", "src_ip", "dst_ip")


_TUPLE = "src_ip, dst_ip, src_port, dst_port, protocol, exporter_ip, flow_type"


@_query(f"""WITH RECURSIVE pick AS (SELECT {_TUPLE}, timestamp, min(event_id) AS event_id FROM raw GROUP BY ALL), numbered AS (SELECT *, row_number() OVER (PARTITION BY {_TUPLE} ORDER BY timestamp) AS rn FROM pick
), fold AS (
  SELECT {_TUPLE}, rn, event_id, timestamp AS last, TRUE AS kept FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.src_ip, n.dst_ip, n.src_port, n.dst_port, n.protocol, n.exporter_ip, n.flow_type, n.rn, n.event_id, CASE WHEN n.timestamp > f.last + INTERVAL 60 SECOND THEN n.timestamp ELSE f.last END, n.timestamp > f.last + INTERVAL 60 SECOND
  FROM fold f JOIN numbered n ON n.src_ip = f.src_ip AND n.dst_ip = f.dst_ip AND n.src_port = f.src_port AND n.dst_port = f.dst_port AND n.protocol = f.protocol AND n.rn = f.rn + 1
), net(i, name, a, b, len) AS (VALUES {_NETS}), geo(a, b, country, city, lat, lon, asn, org) AS (VALUES {_GEO}), lpm AS ({_LPM}),
full_ AS (SELECT raw.*, lpm.tenant_id AS tenant, CASE WHEN geo.a IS NULL THEN '' WHEN country = '' THEN 'unknown' ELSE country END AS dst_country FROM raw JOIN fold ON fold.event_id = raw.event_id AND fold.kept JOIN lpm ON lpm.event_id = raw.event_id LEFT JOIN geo ON {_NUMBER.format('raw.dst_ip')} BETWEEN geo.a AND geo.b)
SELECT CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS timestamp, CAST(tenant AS BIGINT) AS tenant_id, 'private' AS src_country, dst_country, protocol, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(packets) AS BIGINT) AS packets, count(*) AS flow_count FROM full_ GROUP BY ALL""")
def flow_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: flows deduplicated, enriched by every stage and rolled up by hour."""
    city, asn = geo_tables(spark)
    kept = dedup.first_in_ttl(raw_flows(spark, sf_dir), order=["event_id"])
    leases, sessions = temporal.lease_intervals(dhcp(spark, sf_dir), timedelta(days=3)), temporal.session_intervals(radius(spark, sf_dir), timedelta(days=3))
    out = enrich.enriched(kept, tenant_table(spark), threat_table(spark), city, asn, leases, sessions, dns(spark, sf_dir))
    return rollup.rollup(out, "hour")
