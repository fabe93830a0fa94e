"""Profile of a DNS packet capture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import logs


def counters(lines: DataFrame, base_date: str, zone: str = "UTC", resolver: str = "") -> DataFrame:
    """One row of counts of lines, packets, queries, responses, answers, skips and errors, and the time span."""
    live = logs.packet_lines(lines, base_date, zone)
    parts = logs.packet_fields(F.col("line"), resolver)
    raw = live.select("header", "indented", "live", *[c.alias(n) for n, c in parts.items()])
    dns = F.col("live") & F.col("client").isNotNull()
    says = lambda status: F.array_contains(F.split("body", "[^A-Za-z0-9_]+"), status)
    line_counts = raw.agg(
        F.count_if("header").alias("packets"),
        F.count_if(dns & F.col("is_query")).alias("queries"),
        F.count_if(dns & F.col("is_query") & ~F.col("upstream")).alias("client_queries"),
        F.count_if(dns & ~F.col("is_query")).alias("responses"),
        F.count_if(dns & ~F.col("is_query") & says("NXDomain")).alias("nxdomain"),
        F.count_if(dns & ~F.col("is_query") & says("ServFail")).alias("servfail"),
        F.count_if("indented").alias("indented"),
    )
    events = logs.dns_packet_events(lines, base_date, zone, resolver)
    is_query = live.select("path", "line_no", parts["is_query"].alias("is_query"))
    ev = events.join(is_query, ["path", "line_no"]).where("status <> 'skip'")
    good = F.col("status") == "event"
    triple = F.when(good, F.struct("client_ip", "qname", "answer_ip"))
    span = F.unix_micros(F.max("event_time")) - F.unix_micros(F.min("event_time"))
    event_counts = ev.agg(
        F.count_if(good).alias("events"),
        F.count_if(good & F.col("is_query")).alias("query_only"),
        F.count_if(good & ~F.col("is_query") & (F.col("answer_ip") == "")).alias("fallback"),
        F.count_if(good & ~F.col("is_query") & (F.col("answer_ip") != "") & (F.col("qtype") == "A")).alias("answers_a"),
        F.count_if(good & ~F.col("is_query") & (F.col("answer_ip") != "") & (F.col("qtype") == "AAAA")).alias("answers_aaaa"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_distinct(F.when(good, F.struct("path", "line_no"))).alias("event_lines"),
        F.count_distinct(F.when(good, F.col("client_ip"))).alias("clients"),
        F.count_distinct(F.when(good, F.col("qname"))).alias("names"),
        F.count_distinct(triple).alias("triples"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
        F.coalesce(span / 1e6, F.lit(0.0)).alias("span_seconds"),
    )
    total = lines.agg(F.count("*").alias("lines"))
    one = total.crossJoin(line_counts).crossJoin(event_counts)  # three rows of one: a report, not a join
    rate = F.when(F.col("span_seconds") > 0, F.col("client_queries") / F.col("span_seconds")).otherwise(0.0)
    return one.withColumn("skips", F.col("indented") - F.col("event_lines") - F.col("errors")).withColumn("queries_per_sec", rate).drop("indented", "event_lines")


def queries_by_type(lines: DataFrame, base_date: str, zone: str = "UTC", resolver: str = "") -> DataFrame:
    """Queries by type, upstream ones included."""
    parts = logs.packet_fields(F.col("line"), resolver)
    raw = logs.packet_lines(lines, base_date, zone).where("live").select(*[c.alias(n) for n, c in parts.items()])
    kind = F.regexp_extract("body", r"(?:^|\s)(\S*)\?(?:\s|$)", 1)
    return raw.where(F.col("client").isNotNull() & F.col("is_query") & F.col("body").rlike(r"(^|\s)\S*\?(\s|$)")).groupBy(kind.alias("qtype")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "qtype")


def top_names(lines: DataFrame, base_date: str, zone: str = "UTC", resolver: str = "", k: int = 15) -> DataFrame:
    """Names by their queries, upstream ones left out."""
    ev = logs.dns_packet_events(lines, base_date, zone, resolver).where("status = 'event'")
    asked = logs.packet_lines(lines, base_date, zone).select("path", "line_no", logs.packet_fields(F.col("line"), resolver)["is_query"].alias("is_query"))
    return ev.join(asked, ["path", "line_no"]).where("is_query").groupBy("qname").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "qname").limit(k)


def report(lines: DataFrame, base_date: str, zone: str = "UTC", resolver: str = "") -> str:
    """The profile as text; it names no client."""
    found = counters(lines, base_date, zone, resolver).first().asDict()
    text = ["DNS capture report", f"zone {zone}, base date {base_date}, resolver {resolver or '(not set)'}", ""]
    text += [f"{name:18} {value}" for name, value in found.items()]
    text += ["", "queries by type"] + [f"{r['qtype']:18} {r['n']}" for r in queries_by_type(lines, base_date, zone, resolver).collect()]
    text += ["", "top names"] + [f"{r['qname']:40} {r['n']}" for r in top_names(lines, base_date, zone, resolver).collect()]
    return "\n".join(text)
