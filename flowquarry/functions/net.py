"""IP addresses as columns: parsing, private ranges, prefixes."""

from __future__ import annotations

import ipaddress
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
#: The networks that count as private.
PRIVATE_V4 = ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8", "169.254.0.0/16")
PRIVATE_V6 = ("::1/128", "fc00::/7")
#: How an IPv4 address begins as 32 hex digits.
MAPPED = "0" * 20 + "ffff"


def v4_number(ip: Column) -> Column:
    """An IPv4 address as a number from 0 to 2^32 - 1; null for any other text. Stays in the JVM."""
    part = F.split(ip, r"\.")
    number = sum((part[i].cast("long") * (1 << (24 - 8 * i)) for i in range(1, 4)), part[0].cast("long") * (1 << 24))
    return F.when(ip.rlike(IPV4), number)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is made once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def v6_hex(ip: Column) -> Column:
    """An address written with colons as 32 hex digits, which sort as the addresses do; null for any other text."""
    digits = lambda c: F.array_join(F.transform(F.filter(F.split(c, ":"), lambda g: g != ""), lambda g: F.lpad(g, 4, "0")), "")
    filled = lambda left, right: F.concat(left, F.repeat(F.lit("0"), 32 - F.length(left) - F.length(right)), right)
    ends = lambda halves: F.struct(digits(F.get(halves, F.lit(0))).alias("left"), digits(F.coalesce(F.get(halves, F.lit(1)), F.lit(""))).alias("right"))
    whole = lambda text: F.when(is_v6(text), _bound(_bound(F.split(text, "::"), ends), lambda x: filled(x["left"], x["right"])))
    # A dotted end is written as two groups.
    pair = lambda tail: _bound(v4_number(tail), lambda n: F.concat(F.lower(F.hex(F.shiftright(n, 16))), F.lit(":"), F.lower(F.hex(n.bitwiseAND(65535)))))
    tail = F.substring_index(ip, ":", -1)
    dotted = F.concat(F.substr(ip, F.lit(1), F.length(ip) - F.length(tail)), pair(tail))
    return F.when(ip.contains(":"), _bound(F.lower(F.when(tail.contains("."), dotted).otherwise(ip)), whole))


def parsed(df: DataFrame, ip: str, name: str) -> DataFrame:
    """df with {name}_n, an IPv4 address (mapped ones too) as a number, and {name}_h, an IPv6 address as hex digits.

    Both are columns of their own, so an address is read once however often they are used.
    """
    n, h = f"{name}_n", f"{name}_h"
    out = df.withColumn(h, v6_hex(F.col(ip)))
    mapped = F.coalesce(F.col(h).startswith(MAPPED), F.lit(False))
    return out.withColumn(n, F.when(mapped, F.conv(F.substring(h, 25, 8), 16, 10).cast("long")).when(F.col(h).isNull(), v4_number(F.col(ip)))).withColumn(h, F.when(~mapped, F.col(h)))


def is_private_parsed(n: Column, h: Column) -> Column:
    """Whether an address from parsed() is private, loopback or link-local; false if it is none."""
    found = F.lit(False)
    for net in map(ipaddress.ip_network, PRIVATE_V4):
        found = found | F.coalesce(n.between(int(net.network_address), int(net.broadcast_address)), F.lit(False))
    for net in map(ipaddress.ip_network, PRIVATE_V6):
        found = found | F.coalesce(h.between(f"{int(net.network_address):032x}", f"{int(net.broadcast_address):032x}"), F.lit(False))
    return found


def is_private(ip: Column) -> Column:
    """Whether an address is private or loopback; false if the text is no address."""
    both = _bound(v6_hex(ip), lambda h: F.struct(F.when(h.isNull(), v4_number(ip)).alias("n"), h.alias("h")))
    mapped = lambda x: F.when(x["h"].startswith(MAPPED), F.conv(F.substring(x["h"], 25, 8), 16, 10).cast("long")).otherwise(x["n"])
    return _bound(both, lambda x: is_private_parsed(mapped(x), x["h"]))


def masked_hex(h: Column, length: int) -> Column:
    """The first bits of 32 hex digits, as the hex digits that hold them."""
    whole, bits = divmod(length, 4)
    head = F.substring(h, 1, whole)
    if bits:
        digit = F.conv(F.substring(h, whole + 1, 1), 16, 10).cast("int").bitwiseAND(16 - (1 << (4 - bits)))
        head = F.concat(head, F.lower(F.hex(digit)))
    return head


def network6(network: str) -> tuple[str, int] | None:
    """The hex digits that hold an IPv6 network's prefix, host bits masked, and its length; None if it is none."""
    try:
        net = ipaddress.ip_network(network.strip(), strict=False)
    except ValueError:
        return None
    return (f"{int(net.network_address):032x}"[: -(-net.prefixlen // 4)], net.prefixlen) if net.version == 6 else None


@F.pandas_udf(ArrayType(StructType([StructField("network6", StringType()), StructField("length", IntegerType())])))
def networks6(first: pd.Series, last: pd.Series) -> pd.Series:
    """The networks that make up a range of IPv6 addresses; null if the ends aren't such a range."""

    def one(a: str | None, b: str | None) -> list[dict] | None:
        try:
            nets = list(ipaddress.summarize_address_range(ipaddress.IPv6Address(a or ""), ipaddress.IPv6Address(b or "")))
        except (ValueError, TypeError):
            return None
        return [{"network6": f"{int(x.network_address):032x}"[: -(-x.prefixlen // 4)], "length": x.prefixlen} for x in nets]

    return pd.Series([one(a, b) for a, b in zip(first, last, strict=True)])


def is_v6(ip: Column) -> Column:
    """Whether a text is an IPv6 address other than a mapped IPv4 one, by its form."""
    group = r"[0-9A-Fa-f]{1,4}"
    full = rf"^{group}(?::{group}){{7}}$"
    short = rf"^(?:{group}(?::{group}){{0,6}})?::(?:{group}(?::{group}){{0,6}})?$"
    colons = F.length(ip) - F.length(F.replace(ip, F.lit(":"), F.lit("")))
    return ip.rlike(full) | (ip.rlike(short) & (colons <= 7))


def fits_type(qtype: Column, ip: Column) -> Column:
    """Whether an answer's address is of its record type's family; a mapped IPv4 address counts as IPv4."""
    mapped = F.lower(ip).rlike(r"^(?:0:){5}ffff:|^::ffff:[0-9a-f]{1,4}:[0-9a-f]{1,4}$|^::ffff:\d+\.\d+\.\d+\.\d+$")
    v4 = ip.rlike(IPV4) | mapped
    return ((qtype == "A") & v4) | ((qtype == "AAAA") & is_v6(ip) & ~mapped)


def masked(number: Column, length: int) -> Column:
    """The first bits of an IPv4 number."""
    return F.shiftleft(F.shiftright(number, 32 - length), 32 - length)


def cidr(network: str) -> tuple[int, int, int] | None:
    """First and last number and prefix length of an IPv4 network, host bits masked; None if it is none."""
    try:
        net = ipaddress.ip_network(network.strip(), strict=False)
    except ValueError:
        return None
    return (int(net.network_address), int(net.broadcast_address), net.prefixlen) if net.version == 4 else None


def endpoint(text: Column) -> tuple[Column, Column]:
    """Address and port of "address.port"; both null unless the port is from 0 to 65535."""
    ip, digits = F.regexp_extract(text, r"^(.*)\.(\d+)$", 1), F.regexp_extract(text, r"^(.*)\.(\d+)$", 2)
    port = digits.try_cast("int")
    good = (digits != "") & (port <= 65535)
    return F.when(good, ip), F.when(good, port)


def port(text: Column) -> Column:
    """A port number; 0 when out of range or no number."""
    number = text.try_cast("int")
    return F.when(text.rlike(r"^\d+$") & (number <= 65535), number).otherwise(0)
