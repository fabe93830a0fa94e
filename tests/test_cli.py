import json

from flowquarry import cli, queries, schemas, tables


def ask(spark, *argv):
    return cli.run(spark, cli.parser().parse_args(argv))


def test_trace_both_ways(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for name, df, schema, time in (("flows", queries.flows(spark, sf), schemas.FLOWS, "timestamp"), ("dns_events", queries.dns(spark, sf), schemas.DNS_EVENTS, "event_time"), ("identity_dhcp_events", queries.dhcp(spark, sf), schemas.DHCP_EVENTS, "event_time"), ("identity_radius_events", queries.radius(spark, sf), schemas.RADIUS_EVENTS, "event_time")):
        tables.append(df, schema, str(tmp_path / name), time)
    out = ask(spark, "trace", "--tables", str(tmp_path), "--dst-ip", "203.0.113.5", "--around", "2024-01-11 06:00:00", "--window", "240h", "--limit", "5", "--json")
    assert len(out.splitlines()) == 5 and json.loads(out.splitlines()[0])["dst_ip"] == "203.0.113.5"
    out = ask(spark, "trace", "--tables", str(tmp_path), "--who", "--qname", "h3.example.com", "--from", "2024-01-01", "--to", "2024-01-30")
    assert out.splitlines()[0].startswith("CLIENT_IP") and len(out.splitlines()) > 1


def test_scan_and_load(spark, tmp_path):
    from test_parsers import PACKETS

    (tmp_path / "c.txt").write_text(PACKETS)
    assert "packets            12" in ask(spark, "dnsscan", "--file", str(tmp_path / "c.txt"), "--date", "2026-03-01", "--resolver", "10.0.0.3")
    assert ask(spark, "loadgen", "--count", "100", "--out", str(tmp_path / "load")) == "100 flows"
    assert spark.read.text(str(tmp_path / "load")).count() == 100
    assert cli.main(["trace", "--tables", "x", "--dst-ip", "nonsense", "--around", "2024-01-11"]) == 2
