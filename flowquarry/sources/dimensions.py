"""Dimension tables: tenants, threats, address ranges."""

from __future__ import annotations

import logging

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import net

log = logging.getLogger(__name__)


TENANTS = "tenant_id long, tenant_name string, first long, last long, length int, network6 string"


def tenant_rows(networks: list[tuple[int, str, str]]) -> list[tuple]:
    """Rows of a tenant table from (id, name, network); of a network listed twice the last counts."""
    found: dict[tuple, tuple] = {}
    for i, name, network in networks:
        if four := net.cidr(network):
            found[4, four[0], four[2]] = (i, name, *four, None)
        elif six := net.network6(network):
            found[6, *six] = (i, name, None, None, six[1], six[0])
        else:
            log.warning("tenant %s: no network: %s", i, network)
    return list(found.values())


def tenants(spark: SparkSession, path: str) -> DataFrame:
    """tenant_id, tenant_name, first, last, length, network6 of every network of a tenants file.

    IPv4 networks have first and last, IPv6 ones network6. Networks that can't be read are left
    out with a warning.
    """
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    listed = (yaml.safe_load(text) or {}).get("tenants") or []
    return spark.createDataFrame(tenant_rows([(int(t.get("id") or 0), str(t.get("name") or ""), str(x)) for t in listed for x in t.get("subnets") or []]), TENANTS)


def threats(spark: SparkSession, path: str) -> DataFrame:
    """ip, label of a threat list: the first field, the fourth or 'botnet_c2'; of repeated addresses the last counts."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line_no", "line")).select("line_no", F.trim(F.regexp_replace("line", "\r$", "")).alias("line"))
    part = F.split("line", ",", 5)
    label = F.trim(F.coalesce(F.get(part, F.lit(3)), F.lit("")))
    has = F.size(part) >= 4
    rows = lines.where("line <> '' and line not like '#%'").select("line_no", F.trim(part[0]).alias("ip"), F.when(has, label).otherwise("botnet_c2").alias("label"))
    return rows.groupBy("ip").agg(F.max_by("label", "line_no").alias("label")).where("ip <> ''")


def ranges(df: DataFrame, first: str, last: str, values: list[str]) -> DataFrame:
    """An address-range table (text ends) as first, last numbers and values; IPv4 rows only."""
    return df.select(net.v4_number(F.col(first)).alias("first"), net.v4_number(F.col(last)).alias("last"), *values).where("first is not null and last is not null")


def networks6(df: DataFrame, first: str, last: str, values: list[str]) -> DataFrame:
    """The IPv6 rows of an address-range table as networks: network6, length and values."""
    rows = df.where(F.col(first).contains(":"))
    return rows.select(F.explode(net.networks6(F.col(first), F.col(last))).alias("n"), *values).select("n.network6", "n.length", *values)
