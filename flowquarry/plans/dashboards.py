"""Dashboard panels over flows, rollups and DNS events. Top lists break ties by their key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def totals(flows: DataFrame) -> DataFrame:
    threat = (F.col("is_threat_src") == 1) | (F.col("is_threat_dst") == 1)
    return flows.agg(F.count("*").alias("flows"), _long(F.sum("bytes")).alias("bytes"), _long(F.sum("packets")).alias("packets"), F.count_if(threat).alias("threats"))


def per_second(rollup: DataFrame, column: str, name: str) -> DataFrame:
    """A minute rollup's sums by second."""
    return rollup.groupBy(F.col("timestamp").alias("time")).agg((F.sum(column) / 60).alias(name)).orderBy("time")


def protocol_mix(rollup: DataFrame) -> DataFrame:
    return rollup.where("protocol <> ''").groupBy("protocol").agg(_long(F.sum("flow_count")).alias("flows")).orderBy(F.desc("flows"), "protocol")


def top_countries(rollup: DataFrame, k: int = 10) -> DataFrame:
    return rollup.where("dst_country <> ''").groupBy("dst_country").agg(_long(F.sum("flow_count")).alias("flows")).orderBy(F.desc("flows"), "dst_country").limit(k)


def top_talkers(flows: DataFrame, k: int = 20) -> DataFrame:
    return flows.groupBy("src_ip").agg(F.count("*").alias("flows"), _long(F.sum("bytes")).alias("bytes")).orderBy(F.desc("bytes"), "src_ip").limit(k)


def top_orgs(flows: DataFrame, k: int = 20) -> DataFrame:
    by = flows.where("dst_asn <> 0").groupBy("dst_asn")
    return by.agg(F.max("dst_org").alias("org"), F.count("*").alias("flows"), _long(F.sum("bytes")).alias("bytes")).orderBy(F.desc("bytes"), "dst_asn").limit(k)


def tenant_traffic(flows: DataFrame, k: int = 20) -> DataFrame:
    """Flows and bytes out of and into each tenant."""
    def one(name: str, way: str) -> DataFrame:
        return flows.where(F.col(name) != "").groupBy(F.col(name).alias("tenant")).agg(F.lit(way).alias("way"), F.count("*").alias("f"), F.sum("bytes").alias("b"))

    both = one("tenant_name", "out").unionByName(one("dst_tenant_name", "in"))
    pick = lambda c, way: _long(F.sum(F.when(F.col("way") == way, F.col(c))))
    by = both.groupBy("tenant").agg(pick("f", "out").alias("outbound_flows"), pick("b", "out").alias("outbound_bytes"), pick("f", "in").alias("inbound_flows"), pick("b", "in").alias("inbound_bytes"))
    return by.orderBy((F.col("outbound_bytes") + F.col("inbound_bytes")).desc(), "tenant").limit(k)


def dns_counts(dns: DataFrame) -> DataFrame:
    answered = F.when(F.col("answer_ip") != "", F.col("answer_ip"))
    return dns.agg(F.count("*").alias("events"), F.count_distinct("client_ip").alias("clients"), F.count_distinct("qname").alias("domains"), F.count_distinct(answered).alias("answer_ips"))


def dns_per_second(dns: DataFrame) -> DataFrame:
    at = F.date_trunc("minute", F.col("event_time").cast("timestamp")).alias("time")
    return dns.groupBy(at).agg((F.count("*") / 60).alias("events_per_sec")).orderBy("time")


def query_types(dns: DataFrame, k: int = 8) -> DataFrame:
    return dns.groupBy("qtype").agg(F.count("*").alias("events")).orderBy(F.desc("events"), "qtype").limit(k)


def top_domains(dns: DataFrame, k: int = 15) -> DataFrame:
    return dns.groupBy("qname").agg(F.count("*").alias("events"), F.count_distinct("client_ip").alias("clients")).orderBy(F.desc("events"), "qname").limit(k)


def _seen() -> tuple[Column, Column]:
    text = lambda c: F.date_format(c.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    return text(F.min("event_time")).alias("first_seen"), text(F.max("event_time")).alias("last_seen")


def answers_for(dns: DataFrame, qname: str, k: int = 20) -> DataFrame:
    by = dns.where((F.col("qname") == F.lit(qname)) & (F.col("answer_ip") != "")).groupBy("answer_ip")
    return by.agg(F.count("*").alias("resolutions"), F.count_distinct("client_ip").alias("clients"), *_seen()).orderBy(F.desc("resolutions"), "answer_ip").limit(k)


def clients_for(dns: DataFrame, qname: str, answer_ip: str, k: int = 50) -> DataFrame:
    by = dns.where((F.col("qname") == F.lit(qname)) & (F.col("answer_ip") == F.lit(answer_ip))).groupBy("client_ip")
    return by.agg(F.count("*").alias("resolutions"), *_seen()).orderBy(F.desc("resolutions"), "client_ip").limit(k)
