"""Forensic questions: which flows reached a destination, and who resolved a name or address."""

from __future__ import annotations

import ipaddress
import json
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import temporal
from ..tables import as_set, between

#: Services by the autonomous systems that serve them.
SERVICES = {"facebook": (32934,), "meta": (32934,), "instagram": (32934,), "whatsapp": (32934,), "google": (15169,), "youtube": (15169,), "cloudflare": (13335,)}
FLOW_COLUMNS = ("timestamp", "src_ip", "src_port", "dst_ip", "dst_port", "protocol", "bytes", "dst_asn", "dst_org", "exporter_ip", "tenant_name")
DEFAULT_LIMIT, DEFAULT_WINDOW = 1000, timedelta(minutes=30)


class FilterError(ValueError):
    """A question that can't be asked."""


@dataclass(frozen=True)
class Question:
    """A checked question: a time window and one destination."""

    start: datetime
    end: datetime
    dst_asns: tuple[int, ...] = ()
    dst_org: str = ""
    dst_ip: str = ""
    src_ip: str = ""
    qname: str = ""
    who: bool = False
    limit: int = DEFAULT_LIMIT


def service_asns(name: str) -> tuple[int, ...]:
    found = SERVICES.get(name.strip().lower())
    if found is None:
        raise FilterError(f"unknown service {name!r} (known: {', '.join(sorted(SERVICES))})")
    return found


def instant(text: str) -> datetime:
    """A date, a date and time, or RFC 3339; UTC unless it names an offset."""
    text = text.strip()
    for layout in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%dT%H:%M:%S.%f%z", "%Y-%m-%d"):
        try:
            found = datetime.strptime(text, layout)
        except ValueError:
            continue
        return found.replace(tzinfo=UTC) if found.tzinfo is None else found.astimezone(UTC)
    raise FilterError(f"cannot read time {text!r}")


def _address(text: str, name: str) -> str:
    try:
        ipaddress.ip_address(text)
    except ValueError as error:
        raise FilterError(f"invalid {name} {text!r}") from error
    return text


def question(who: bool = False, qname: str = "", service: str = "", dst_asn: int = 0, dst_org: str = "", dst_ip: str = "", around: str = "", window: timedelta = DEFAULT_WINDOW, start: str = "", end: str = "", src_ip: str = "", limit: int = DEFAULT_LIMIT) -> Question:
    """Check and resolve a question: exactly one destination and one form of time window.

    ``around`` with ``window`` means half a window to each side.
    """
    if who and (service or dst_asn or dst_org or src_ip):
        raise FilterError("who takes a qname or a dst_ip only")
    if not who and qname:
        raise FilterError("qname goes with who")
    if who and qname and not normal_qname(qname):
        raise FilterError(f"invalid qname {qname!r}")
    given = [x for x in ((qname, dst_ip) if who else (service, dst_asn, dst_org, dst_ip)) if x]
    if len(given) != 1:
        raise FilterError("name exactly one destination")
    if dst_ip:
        _address(dst_ip, "dst_ip")
    asns = service_asns(service) if service else (dst_asn,) if dst_asn else ()
    if around:
        if start or end:
            raise FilterError("use either around or start and end")
        centre = instant(around)
        first, last = centre - window / 2, centre + window / 2
    elif start and end:
        first, last = instant(start), instant(end)
        if last < first:
            raise FilterError("the end is before the start")
    else:
        raise FilterError("name a time window")
    if src_ip:
        _address(src_ip, "src_ip")
    if limit <= 0:
        raise FilterError("limit must be positive")
    return Question(first, last, asns, dst_org, dst_ip, src_ip, normal_qname(qname), who, limit)


def normal_qname(name: str) -> str:
    return name.strip().lower().removesuffix(".")


def _window(df: DataFrame, time: str, q: Question, before: timedelta = timedelta()) -> DataFrame:
    text = lambda t: t.astimezone(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")
    return between(df, time, text(q.start - before), text(q.end))


def org_contains(column: str, part: str) -> Column:
    """Case-insensitive substring; the text is a literal, never a pattern or SQL."""
    return F.contains(F.lower(column), F.lower(F.lit(part)))


def under_domain(column: str, name: str) -> Column:
    """The name itself or any name below it."""
    return (F.col(column) == F.lit(name)) | F.endswith(F.col(column), F.lit("." + name))


def flows_to(flows: DataFrame, q: Question) -> DataFrame:
    """Flows to a destination, oldest first, up to the question's limit; ties in the order of all columns."""
    rows = _window(flows, "timestamp", q)
    if q.dst_asns:
        rows = rows.where(F.col("dst_asn").isin(list(q.dst_asns)))
    elif q.dst_org:
        rows = rows.where(org_contains("dst_org", q.dst_org))
    else:
        rows = rows.where(F.col("dst_ip") == F.lit(q.dst_ip))
    if q.src_ip:
        rows = rows.where(F.col("src_ip") == F.lit(q.src_ip))
    return rows.select(*FLOW_COLUMNS).orderBy(*FLOW_COLUMNS).limit(q.limit)


def resolutions(dns: DataFrame, q: Question) -> DataFrame:
    """client_ip, qname, answer_ip, resolutions, first_seen, last_seen of a name (and names below it) or an address."""
    rows = as_set(_window(dns, "event_time", q))
    rows = rows.where(under_domain("qname", q.qname)) if q.qname else rows.where(F.col("answer_ip") == F.lit(q.dst_ip))
    by = rows.groupBy("client_ip", "qname", "answer_ip").agg(F.count("*").alias("resolutions"), F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"))
    return by.orderBy("client_ip", "last_seen", "qname", "answer_ip").limit(q.limit)


def who_resolved(dns: DataFrame, dhcp: DataFrame, radius: DataFrame, q: Question, max_lease: timedelta = timedelta(hours=24), max_session: timedelta = timedelta(hours=24)) -> DataFrame:
    """Resolutions with the device and user that held the client's address when it was last seen.

    One plan without steps on the driver. '' means no binding, the *_ambiguous flags several; the
    user is looked up for one device only.
    """
    found = resolutions(dns, q)
    leases = temporal.lease_intervals(_window(dhcp, "event_time", q, max_lease), max_lease)
    sessions = temporal.session_intervals(_window(radius, "event_time", q, max_session), max_session)
    device = temporal.as_of(found, "client_ip", "last_seen", leases, "mac_token", "mac_ambiguous")
    user = temporal.as_of(device, "mac_token", "last_seen", sessions, "user_token", "user_ambiguous")
    return user.select("client_ip", "qname", "answer_ip", "resolutions", "first_seen", "last_seen", "mac_token", "user_token", "mac_ambiguous", "user_ambiguous")


def token_text(token: Column, ambiguous: Column) -> Column:
    """A token for reading: ambiguous and unknown are told apart."""
    return F.when(ambiguous, "ambiguous at that time").when(token == "", "unknown at that time").otherwise(token)


def render(rows: DataFrame, as_json: bool = False) -> str:
    """A bounded result (the question's limit) as JSON lines or an aligned table."""
    names = rows.columns
    if not as_json and {"mac_ambiguous", "user_ambiguous"} <= set(names):
        names = [c for c in names if not c.endswith("_ambiguous")]
        rows = rows.withColumns({f"{x}_token": token_text(F.col(f"{x}_token"), F.col(f"{x}_ambiguous")) for x in ("mac", "user")}).select(*names)
    found = [r.asDict() for r in rows.collect()]
    if as_json:
        return "\n".join(json.dumps({k: v.isoformat() if isinstance(v, datetime) else v for k, v in r.items()}) for r in found)
    cells = [[n.upper() for n in names]] + [[str(r[n]) for n in names] for r in found]
    width = [max(len(row[i]) for row in cells) for i in range(len(names))]
    return "\n".join("  ".join(c.ljust(w) for c, w in zip(row, width, strict=True)).rstrip() for row in cells)
