"""Minute and hour rollups of flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("tenant_id", "src_country", "dst_country", "protocol")
_SUMS = ("bytes", "packets", "flow_count")


def rollup(flows: DataFrame, unit: str) -> DataFrame:
    """Raw bytes and packets and the number of flows by minute or hour, source tenant, countries and protocol."""
    at = F.date_trunc(unit, F.col("timestamp").cast("timestamp")).alias("timestamp")
    return flows.groupBy(at, *KEYS).agg(F.sum("bytes").cast("long").alias("bytes"), F.sum("packets").cast("long").alias("packets"), F.count("*").alias("flow_count"))


def coarser(rows: DataFrame, unit: str) -> DataFrame:
    """A rollup from a finer one: sums add up."""
    at = F.date_trunc(unit, F.col("timestamp").cast("timestamp")).alias("timestamp")
    return rows.groupBy(at, *KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in _SUMS])


def merged(parts: DataFrame) -> DataFrame:
    """One row a key from partial rollup rows."""
    return parts.groupBy("timestamp", *KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in _SUMS])
