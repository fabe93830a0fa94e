"""Schemas of records and tables. Absent values are '' or 0, never null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_TYPES: dict[str, DataType] = {"string": StringType(), "long": LongType(), "int": IntegerType(), "double": DoubleType(), "boolean": BooleanType(), "timestamp": TimestampType(), "decimal(20,0)": DecimalType(20, 0)}


def struct(fields: str) -> StructType:
    """A schema from "name type, ...", made without a session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (x.split(" ") for x in fields.split(", "))])


#: A flow record as JSON has it; unsigned 64-bit numbers are wide decimals there.
RAW_FLOW = struct(
    "type string, time_flow_start_ns long, time_flow_end_ns long, time_received_ns long, src_addr string, dst_addr string, src_port long, dst_port long, proto string, bytes decimal(20,0), packets decimal(20,0), sampling_rate decimal(20,0), sampler_address string, next_hop string, src_as long, dst_as long, tcp_flags long, in_if long, out_if long, sequence_num long, etype string, src_vlan long, dst_vlan long, forwarding_status long, ip_tos long, ip_ttl long, observation_domain_id long"
)
FLOWS = struct(
    "timestamp timestamp, tenant_id long, tenant_name string, dst_tenant_id long, dst_tenant_name string, src_mac_token string, src_user_token string, dst_mac_token string, dst_user_token string, src_hostname string, dst_hostname string, src_ip string, dst_ip string, src_port long, dst_port long, protocol string, bytes long, packets long, src_country string, src_city string, src_lat double, src_lon double, src_asn long, src_org string, dst_country string, dst_city string, dst_lat double, dst_lon double, dst_asn long, dst_org string, is_threat_src int, is_threat_dst int, threat_label string, is_sampled int, sampling_rate long, expanded_bytes long, expanded_packets long, exporter_ip string, flow_type string"
)
ROLLUP = struct("timestamp timestamp, tenant_id long, src_country string, dst_country string, protocol string, bytes long, packets long, flow_count long")
DHCP_EVENTS = struct("event_time timestamp, event_id int, ip string, mac_token string, host_token string")
RADIUS_EVENTS = struct("event_time timestamp, acct_status string, session_id string, user_token string, mac_token string, nas_ip string")
DNS_EVENTS = struct("event_time timestamp, client_ip string, client_port int, qname string, qtype string, answer_ip string, ttl long")
DNS_FLIGHT = struct("event_time timestamp, client_ip string, client_port int, qname string, qtype string, answer_ip string, ttl long, ttl_unknown boolean")


def zero(kind: str) -> Column:
    """The value that stands for an absent one."""
    return {"string": F.lit(""), "boolean": F.lit(False), "timestamp": F.timestamp_seconds(F.lit(0))}.get(kind, F.lit(0))


def shaped(df: DataFrame, schema: StructType) -> DataFrame:
    """df's columns by name in a schema's order and types; missing columns and nulls get absent values."""
    have = set(df.columns)
    return df.select(*[(F.coalesce(F.col(f.name), zero(f.dataType.typeName())) if f.name in have else zero(f.dataType.typeName())).cast(f.dataType).alias(f.name) for f in schema])
