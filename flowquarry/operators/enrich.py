"""Enrichment of flows: geography, tenants, identities, names, threats, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import net
from ..sources.flows import flow_time
from . import temporal

GEO = ("country", "city", "lat", "lon")
ASN = ("asn", "org")
#: Rows of a dimension that a broadcast may hold; larger ones are joined by shuffles.
BROADCAST_ROWS = 1_000_000


def small(dimension: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """dimension, marked for broadcast if it has at most so many rows."""
    return F.broadcast(dimension) if dimension.limit(rows + 1).count() <= rows else dimension


def with_sampling(flows: DataFrame) -> DataFrame:
    """is_sampled, expanded_bytes, expanded_packets: volumes times a rate above 1, else 0.

    A product beyond 64 bits is null and so can be counted, never wrapped.
    """
    sampled = F.col("sampling_rate") > 1
    times = lambda c: F.when(sampled, F.try_multiply(F.col(c).cast("long"), F.col("sampling_rate").cast("long"))).otherwise(F.lit(0).cast("long"))
    return flows.withColumns({"is_sampled": sampled.cast("int"), "expanded_bytes": times("bytes"), "expanded_packets": times("packets")})


def with_threats(flows: DataFrame, threats: DataFrame) -> DataFrame:
    """is_threat_src, is_threat_dst, threat_label: the source's label unless it is empty, else the destination's."""
    table = small(threats.select(F.col("ip").alias("t_ip"), F.col("label").alias("t_label")))
    one = table.withColumnsRenamed({"t_ip": "s_ip", "t_label": "s_label"})
    two = table.withColumnsRenamed({"t_ip": "d_ip", "t_label": "d_label"})
    both = flows.join(one, flows["src_ip"] == one["s_ip"], "left").join(two, flows["dst_ip"] == two["d_ip"], "left")
    src, dst = F.col("s_ip").isNotNull(), F.col("d_ip").isNotNull()
    label = F.when(src & (F.col("s_label") != ""), F.col("s_label")).when(dst, F.col("d_label")).otherwise("")
    return both.select(*[flows[c] for c in flows.columns], src.cast("int").alias("is_threat_src"), dst.cast("int").alias("is_threat_dst"), label.alias("threat_label"))


def _longest(flows: DataFrame, asked: Column, table: DataFrame, key: str, length: str, values: list[str], masked, name: str) -> DataFrame:
    """flows with a struct of the values of the longest prefix of an address, null without one.

    One equi-join of the masked address for each prefix length in use, which are few.
    """
    counts = {r["length"]: r["count"] for r in table.groupBy(F.col(length).alias("length")).count().collect()}
    mark = F.broadcast if sum(counts.values()) <= BROADCAST_ROWS else (lambda df: df)
    out, hits = flows, []
    for n in sorted(counts, reverse=True):
        of = mark(table.where(F.col(length) == n).select(F.col(key).alias(f"_f{n}"), F.struct(*values).alias(f"_t{n}")).dropDuplicates([f"_f{n}"]))
        out = out.join(of, masked(asked, n) == F.col(f"_f{n}"), "left")
        hits.append(F.col(f"_t{n}"))
    found = F.coalesce(*hits) if hits else F.lit(None).cast(table.select(F.struct(*values).alias("x")).schema["x"].dataType)
    return out.select(*[F.col(f"`{c}`") for c in flows.columns], found.alias(name))


def with_tenant(flows: DataFrame, tenants: DataFrame, ip: str, prefix: str) -> DataFrame:
    """{prefix}tenant_id and {prefix}tenant_name of the longest network that holds an address; 0 and '' without one.

    tenants: tenant_id, tenant_name, first, length of IPv4 networks; rows with network6 are IPv6 ones.
    """
    values = ["tenant_id", "tenant_name"]
    six = tenants.where("network6 is not null") if "network6" in tenants.columns else None
    out = _longest(net.parsed(flows, ip, "_ip"), F.col("_ip_n"), tenants.where("first is not null"), "first", "length", values, net.masked, "_hit4")
    out = _longest(out, F.col("_ip_h"), six, "network6", "length", values, net.masked_hex, "_hit6") if six is not None else out.withColumn("_hit6", F.lit(None).cast(out.schema["_hit4"].dataType))
    hit = F.coalesce("_hit4", "_hit6")
    return out.select(*[F.col(f"`{c}`") for c in flows.columns], F.coalesce(hit["tenant_id"], F.lit(0).cast("long")).alias(f"{prefix}tenant_id"), F.coalesce(hit["tenant_name"], F.lit("")).alias(f"{prefix}tenant_name"))


def bucketed(ranges: DataFrame, bits: int = 16) -> DataFrame:
    """Address ranges cut at the borders of buckets of 2^(32 - bits) addresses, with each piece's bucket."""
    shift = 32 - bits
    each = ranges.withColumn("bucket", F.explode(F.sequence(F.shiftright("first", shift), F.shiftright("last", shift))))
    low = F.shiftleft(F.col("bucket"), shift)
    return each.withColumn("first", F.greatest("first", low)).withColumn("last", F.least("last", low + ((1 << shift) - 1)))


def with_range(flows: DataFrame, ranges: DataFrame, number: str, values: list[str], prefix: str, bits: int = 16) -> DataFrame:
    """Values of the disjoint range that holds an address, given as a number; null without one.

    Ranges and flows meet in buckets of addresses, so the join is an equi-join that Spark can
    split where a bucket is crowded; within a bucket ranges are few and tested in the join.
    """
    pieces = small(bucketed(ranges, bits).select(F.col("bucket").alias("_b"), F.col("first").alias("_first"), F.col("last").alias("_last"), *[F.col(v).alias(f"_{v}") for v in values]))
    n = F.col(number)
    hit = (F.shiftright(n, 32 - bits) == F.col("_b")) & n.between(F.col("_first"), F.col("_last"))
    return flows.join(pieces, hit, "left").select(*[F.col(f"`{c}`") for c in flows.columns], *[F.col(f"_{v}").alias(f"{prefix}{v}") for v in values])


def with_geo(flows: DataFrame, city: DataFrame, asn: DataFrame, side: str, city6: DataFrame | None = None, asn6: DataFrame | None = None) -> DataFrame:
    """Country, city, position, ASN and organisation of one side ('src' or 'dst').

    Private and unreadable addresses are 'private' with nothing else; a range without a country
    is 'unknown'; an address in no range has ''. city6, asn6: networks of IPv6 addresses
    (dimensions.networks6). Each address is read once.
    """
    out = net.parsed(flows, f"{side}_ip", "_ip")
    closed = net.is_private_parsed(F.col("_ip_n"), F.col("_ip_h")) | (F.col("_ip_n").isNull() & F.col("_ip_h").isNull())
    out = out.withColumn("_closed", closed)
    # Closed addresses are looked up nowhere.
    out = out.withColumn("_open_n", F.when(~F.col("_closed"), F.col("_ip_n"))).withColumn("_open_h", F.when(~F.col("_closed"), F.col("_ip_h")))
    out = with_range(out, city.withColumn("hit", F.lit(True)), "_open_n", [*GEO, "hit"], "_c_")
    out = with_range(out, asn, "_open_n", list(ASN), "_a_")
    value = lambda c, n: F.col(f"_{c}_{n}")
    if city6 is not None and asn6 is not None:
        out = _longest(out, F.col("_open_h"), city6.withColumn("hit", F.lit(True)), "network6", "length", [*GEO, "hit"], net.masked_hex, "_c6")
        out = _longest(out, F.col("_open_h"), asn6, "network6", "length", list(ASN), net.masked_hex, "_a6")
        value = lambda c, n: F.coalesce(F.col(f"_{c}_{n}"), F.col(f"_{c}6.{n}"))
    country = F.when(F.col("_closed"), "private").when(value("c", "hit") & (F.coalesce(value("c", "country"), F.lit("")) == ""), "unknown").otherwise(F.coalesce(value("c", "country"), F.lit("")))
    zeros = {"city": "", "lat": 0.0, "lon": 0.0}
    columns = [country.alias(f"{side}_country"), *[F.coalesce(value("c", n), F.lit(zero)).alias(f"{side}_{n}") for n, zero in zeros.items()], F.coalesce(value("a", "asn"), F.lit(0)).cast("long").alias(f"{side}_asn"), F.coalesce(value("a", "org"), F.lit("")).alias(f"{side}_org")]
    return out.select(*[F.col(f"`{c}`") for c in flows.columns], *columns)


def with_identity(flows: DataFrame, leases: DataFrame, sessions: DataFrame, side: str, time: str = "timestamp") -> DataFrame:
    """Device and user tokens of one side at the flow's time, and whether either was ambiguous (then '')."""
    out = temporal.as_of(flows, f"{side}_ip", time, leases, f"{side}_mac_token", f"{side}_mac_ambiguous")
    return temporal.as_of(out, f"{side}_mac_token", time, sessions, f"{side}_user_token", f"{side}_user_ambiguous")


def with_names(flows: DataFrame, dns: DataFrame, time: str = "timestamp") -> DataFrame:
    """Names of both sides: what the other side last resolved to the address."""
    out = temporal.dns_as_of(flows, "src_ip", "dst_ip", time, dns, "dst_hostname")
    return temporal.dns_as_of(out, "dst_ip", "src_ip", time, dns, "src_hostname")


def flat(raw: DataFrame) -> DataFrame:
    """Decoded records as the flow table's plain columns."""
    long = lambda c: F.col(c).cast("long")
    return raw.select(flow_time().alias("timestamp"), F.col("src_addr").alias("src_ip"), F.col("dst_addr").alias("dst_ip"), "src_port", "dst_port", F.col("proto").alias("protocol"), long("bytes").alias("bytes"), long("packets").alias("packets"), long("sampling_rate").alias("sampling_rate"), F.col("sampler_address").alias("exporter_ip"), F.col("type").alias("flow_type"))


def enriched(flows: DataFrame, tenants: DataFrame | None = None, threats: DataFrame | None = None, city: DataFrame | None = None, asn: DataFrame | None = None, leases: DataFrame | None = None, sessions: DataFrame | None = None, dns: DataFrame | None = None, city6: DataFrame | None = None, asn6: DataFrame | None = None) -> DataFrame:
    """All stages for which a table is given; a failed lookup never drops a flow."""
    out = flows
    for side, prefix in (("src", ""), ("dst", "dst_")):
        if city is not None and asn is not None:
            out = with_geo(out, city, asn, side, city6, asn6)
        if tenants is not None:
            out = with_tenant(out, tenants, f"{side}_ip", prefix)
        if leases is not None and sessions is not None:
            out = with_identity(out, leases, sessions, side)
    if dns is not None:
        out = with_names(out, dns)
    if threats is not None:
        out = with_threats(out, threats)
    return with_sampling(out)


