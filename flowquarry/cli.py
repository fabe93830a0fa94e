"""Command line: forensic questions, capture report, generated flows.

    python -m flowquarry.cli trace --tables DIR --dst-ip 203.0.113.9 --around "2026-01-01 12:00:00"
    python -m flowquarry.cli trace --tables DIR --who --qname example.com --from 2026-01-01 --to 2026-01-02
    python -m flowquarry.cli dnsscan --file capture.txt --date 2026-01-01 --resolver 10.0.0.3
    python -m flowquarry.cli loadgen --count 1000000 --out DIR
"""

from __future__ import annotations

import argparse
import sys
from datetime import timedelta

from pyspark.sql import SparkSession

from . import config
from .plans import capture, forensic
from .session import DEFAULTS
from .sources import flows, lines


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="flowquarry")
    sub = top.add_subparsers(dest="command", required=True)
    trace = sub.add_parser("trace", help="which flows reached a destination; with --who, which device and user resolved it")
    trace.add_argument("--tables", required=True, help="folder of the stored tables")
    trace.add_argument("--who", action="store_true")
    for name in ("qname", "service", "dst-org", "dst-ip", "src-ip", "around"):
        trace.add_argument(f"--{name}", default="")
    trace.add_argument("--dst-asn", type=int, default=0)
    trace.add_argument("--window", default="30m", help="whole width of the window around a time")
    trace.add_argument("--from", dest="start", default="")
    trace.add_argument("--to", dest="end", default="")
    trace.add_argument("--limit", type=int, default=forensic.DEFAULT_LIMIT)
    trace.add_argument("--json", action="store_true")
    scan = sub.add_parser("dnsscan", help="profile of a DNS packet capture in text form")
    scan.add_argument("--file", required=True)
    scan.add_argument("--date", required=True, help="day of the first packet")
    scan.add_argument("--zone", default="")
    scan.add_argument("--resolver", default="")
    load = sub.add_parser("loadgen", help="generated flow messages")
    load.add_argument("--count", type=int, default=1_000_000)
    load.add_argument("--out", default="", help="folder for text files")
    load.add_argument("--servers", default="", help="Kafka servers")
    load.add_argument("--topic", default="raw-flows")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    if args.command == "trace":
        q = forensic.question(args.who, args.qname, args.service, args.dst_asn, args.dst_org, args.dst_ip, args.around, config.duration("window", forensic.DEFAULT_WINDOW, {"window": args.window}), args.start, args.end, args.src_ip, args.limit)
        read = lambda name: spark.read.parquet(f"{args.tables.rstrip('/')}/{name}")
        if not q.who:
            return forensic.render(forensic.flows_to(read("flows"), q), args.json)
        lease, session = (config.duration(f"IDENTITY_MAX_{x}", timedelta(hours=24)) for x in ("LEASE", "SESSION"))
        return forensic.render(forensic.who_resolved(read("dns_events"), read("identity_dhcp_events"), read("identity_radius_events"), q, lease, session), args.json)
    if args.command == "dnsscan":
        return capture.report(lines.text_lines(spark, args.file), args.date, args.zone or config.log_zone("DNS_LOG_TZ"), args.resolver)
    messages = flows.generated(spark, args.count)
    if args.servers:
        flows.to_kafka(messages, args.servers, args.topic)
    elif args.out:
        messages.select("value").write.mode("append").text(args.out)
    else:
        raise SystemExit("name --out or --servers")
    return f"{args.count} flows"


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    builder = SparkSession.builder.appName("flowquarry")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    try:
        print(run(builder.getOrCreate(), args))
    except (forensic.FilterError, config.ConfigError) as error:
        print(error, file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
