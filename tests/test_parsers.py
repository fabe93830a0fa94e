"""Parsers on fixtures of the documented shapes, with their known counts, and malformed lines."""

from collections import Counter

import pytest

from flowquarry.functions.identifiers import Identity
from flowquarry.sources import logs

PLAIN = Identity("passthrough")


def lines(spark, text, path="a"):
    return spark.createDataFrame([(path, i, x) for i, x in enumerate(text.split("\n"))], "path string, line_no long, line string")


def outcome(df):
    return Counter(r.status for r in df.collect())


def radius(status, session="S1", time="01/02/2026 03:04:05.999", **more):
    fields = {"Timestamp": time, "User-Name": "DOM\\Ann", "Calling-Station-Id": "AA-BB-CC-DD-EE-FF", "NAS-IP-Address": "10.0.0.1", "Acct-Status-Type": status, "Acct-Session-Id": session} | more
    return "<Event>" + "".join(f'<{k} data_type="1">{v}</{k}>' for k, v in fields.items() if v is not None) + "</Event>"


def test_radius(spark):
    text = "\n".join([radius("1"), radius("3"), radius("2"), radius(None), radius("7"), "", "not xml", radius("1", time=None), radius("7", time="bad"), radius("Interim-Update", time=None, **{"Event-Timestamp": "01/02/2026 03:04:05"})])
    rows = logs.radius_events(lines(spark, text), PLAIN, "Asia/Bangkok").collect()
    assert Counter(r.status for r in rows) == {"event": 4, "skip": 4, "error": 2}
    first = rows[0]
    assert (str(first.event_time), first.acct_status, first.session_id, first.nas_ip) == ("2026-01-01 20:04:05", "Start", "S1", "10.0.0.1")


def test_dhcp(spark):
    text = "\n".join(["ID,Date,Time,Description,IP Address,Host Name,MAC Address", "00,01/02/26,03:04:05,Started,,,,", "10,01/02/26,03:04:05,Assign,10.0.0.5,Host.example.com,AABBCCDDEEFF,", "11,01/02/26,03:05:05,Renew,10.0.0.5,h,AABBCCDDEEFF,", "12,01/02/26,03:06:05,Release,10.0.0.5,h,AABBCCDDEEFF,", "", "10,01/02/26,03:04:05", "11,99/99/99,03:04:05,Renew,10.0.0.5,h,AA"])
    rows = logs.dhcp_events(lines(spark, text), PLAIN).collect()
    assert Counter(r.status for r in rows) == {"event": 3, "skip": 3, "error": 2}
    assert [(r.event_id, r.ip, str(r.event_time)) for r in rows if r.status == "event"][0] == (10, "10.0.0.5", "2026-01-02 03:04:05")


def test_dns_text(spark):
    head = "01-Feb-2026 09:15:00.123 client "
    text = "\n".join([
        head + "@0x7f 10.0.0.5#40333 (a.example): query: A.Example. IN A +E(0)K (10.0.0.1)",
        head + "10.0.0.5#40333 (a.example): response: a.example IN A NOERROR a.example. 300 IN A 192.0.2.1 a.example. 300 IN A 192.0.2.2",
        head + "10.0.0.8#99999 (b.example): response: b.example IN AAAA NOERROR b.example. 120 IN AAAA 2001:db8::1",
        head + "10.0.0.9#33333 (c.invalid): response: c.invalid IN MX NXDOMAIN",
        head + "10.0.0.9#33333 (c.invalid): response: c.invalid IN A NOERROR c.invalid. 1 IN A 2001:db8::1 c.invalid. 1 IN AAAA 192.0.2.1 c.invalid. 99999999999 IN A 192.0.2.1",
        "01-Feb-2026 09:18:00.000 lame-server resolving", "", "bad time client 10.0.0.5#1 (x): query: x IN A", head + "10.0.0.5 (x): query: x IN A",
    ])
    rows = logs.dns_text_events(lines(spark, text)).collect()
    assert Counter(r.status for r in rows) == {"event": 6, "skip": 2, "error": 2}
    events = [(r.client_ip, r.client_port, r.qname, r.qtype, r.answer_ip, r.ttl) for r in rows if r.status == "event"]
    assert events == [("10.0.0.5", 40333, "a.example", "A", "", 0), ("10.0.0.5", 40333, "a.example", "A", "192.0.2.1", 300), ("10.0.0.5", 40333, "a.example", "A", "192.0.2.2", 300), ("10.0.0.8", 0, "b.example", "AAAA", "2001:db8::1", 120), ("10.0.0.9", 33333, "c.invalid", "MX", "", 0), ("10.0.0.9", 33333, "c.invalid", "A", "", 0)]
    assert str(rows[0].event_time) == "2026-02-01 09:15:00.123000"


UDP, TCP = " IP (tos 0x0, proto UDP (17), length 63)", " IP (tos 0x0, proto TCP (6), length 63)"
PACKETS = "\n".join([
    "23:59:58.5" + UDP, "    10.9.8.21.40112 > 10.0.0.3.53: 7001+ A? Example.com. (35)",
    "23:59:59.000001" + UDP, "    10.0.0.3.40077 > 192.0.2.53.53: 7002+% [1au] A? up.example. (54)",
    "00:00:01.0" + UDP, "    10.0.0.3.53 > 10.9.8.21.40112: 7001 1/0/0 example.com. A 192.0.2.1 (55)",
    "00:00:02.0" + UDP, "    10.0.0.3.53 > 10.9.8.21.40112: 1 3/0/0 w.example. CNAME c.example., c.example. A 192.0.2.2, c.example. AAAA 2001:db8::2 (99)",
    "00:00:03.0" + UDP, "    10.0.0.3.53 > 10.9.8.21.40112: 2 1/0/0 p.example. PTR host.example. (40)",
    "00:00:04.0" + UDP, "    10.0.0.3.53 > 10.9.8.21.40112: 3 NXDomain 0/1/0 (40)",
    "00:00:05.0" + TCP, "    10.9.8.21.40112 > 10.0.0.3.53: 9+ A? tcp.example. (35)",
    "    10.9.8.21.1 > 10.0.0.3.53: 9+ A? orphan.example. (35)",
    "00:00:06.0" + UDP, "banner", "    10.9.8.21.1 > 10.0.0.3.53: 9+ A? late.example. (35)",
    "00:00:07.0 IP6 (flowlabel 0x1, next-header UDP (17) payload length: 40)", "    fd00::5.40000 > fd00::3.53: 7+ AAAA? six.example. (35)",
    "00:00:08.0" + UDP, "    10.9.8.21.1 > 10.0.0.3.53: 9+ A? (35)".replace("A? (35)", "A?"),
    "00:00:09.0" + UDP, "    10.9.8.21.1 > 10.0.0.3.5353: noise",
    "00:00:10.0" + UDP, "    10.9.8.40.53 > 10.0.0.3.53: 5+ A? both.example. (35)",
    "", "25:00:00.0" + UDP, "    10.9.8.21.1 > 10.0.0.3.53: 9+ A? invalidtime.example. (35)",
])


def test_dns_packets(spark):
    rows = logs.dns_packet_events(lines(spark, PACKETS), "2026-03-01", "UTC", "10.0.0.3").collect()
    events = [(str(r.event_time), r.client_ip, r.client_port, r.qname, r.qtype, r.answer_ip, r.ttl_unknown) for r in rows if r.status == "event"]
    assert sorted(events) == sorted([
        ("2026-03-01 23:59:58.500000", "10.9.8.21", 40112, "example.com", "A", "", False), ("2026-03-02 00:00:01", "10.9.8.21", 40112, "example.com", "A", "192.0.2.1", True),
        ("2026-03-02 00:00:02", "10.9.8.21", 40112, "w.example", "A", "192.0.2.2", True), ("2026-03-02 00:00:02", "10.9.8.21", 40112, "w.example", "AAAA", "2001:db8::2", True),
        ("2026-03-02 00:00:03", "10.9.8.21", 40112, "p.example", "PTR", "", False), ("2026-03-02 00:00:07", "fd00::5", 40000, "six.example", "AAAA", "", False), ("2026-03-02 00:00:10", "10.9.8.40", 53, "both.example", "A", "", False),
    ])
    assert sum(r.status == "error" for r in rows) == 1
    open_ = logs.dns_packet_events(lines(spark, PACKETS), "2026-03-01").where("status = 'event'")
    assert open_.where("qname = 'up.example'").count() == 1


def test_headers_pair_within_a_file_only(spark):
    both = lines(spark, "00:00:01.0" + UDP, "a").unionAll(lines(spark, "    10.9.8.21.1 > 10.0.0.3.53: 9+ A? x.example. (35)", "b"))
    assert outcome(logs.dns_packet_events(both, "2026-03-01")) == {"skip": 2}


def test_small_backward_jump_stays_on_the_day(spark):
    text = "\n".join(["14:00:00.0" + UDP, "  10.0.0.6.1 > 10.0.0.3.53: 9+ A? x.example. (35)", "12:00:00.0" + UDP, "  10.0.0.6.1 > 10.0.0.3.53: 9+ A? y.example. (35)"])
    rows = logs.dns_packet_events(lines(spark, text), "2026-03-01", "Asia/Bangkok").where("status = 'event'").orderBy("event_time").collect()
    assert [str(r.event_time) for r in rows] == ["2026-03-01 05:00:00", "2026-03-01 07:00:00"]


def block(kind, *sections, time="2026-07-15T03:46:30.25Z", question="'www.example. IN A'", body=""):
    side = "query" if kind.endswith("QUERY") else "response"
    text = f'type: MESSAGE\nidentity: x\nmessage:\n  type: {kind}\n  {side}_time: !!timestamp {time}\n  query_address: "127.0.0.1"\n  query_port: 48626\n  {side}_message_data:\n    opcode: QUERY\n'
    if question:
        text += f"    QUESTION_SECTION:\n      - {question}\n"
    if sections:
        text += "    ANSWER_SECTION:\n" + "".join(f"      - '{s}'\n" for s in sections)
    return text + (f"  {side}_message: |\n{body}" if body else "")


def test_dns_messages(spark):
    text = "---\n".join([
        block("CLIENT_QUERY", body="    ;www.example. IN A\n    type: FAKE\n"), block("CLIENT_RESPONSE", "www.example. 60 IN CNAME c.example.", "c.example. 30 IN A 192.0.2.1", "c.example. 30 IN AAAA 192.0.2.9", "c.example. 30 IN AAAA 2001:db8::1"),
        block("FORWARDER_QUERY"), block("CLIENT_RESPONSE", body="    - 'www.example. 30 IN A 192.0.2.7'\n"), block("CLIENT_RESPONSE", question=""), block("CLIENT_QUERY", time="bad"), block("CLIENT_QUERY"),
    ])
    rows = logs.dns_message_events(lines(spark, text)).collect()
    assert Counter(r.status for r in rows) == {"event": 4, "skip": 1, "error": 2}  # the last block has no end
    events = [(r.qname, r.qtype, r.answer_ip, r.ttl) for r in sorted(rows, key=lambda r: r.block) if r.status == "event"]
    assert Counter(events) == Counter([("www.example", "A", "", 0), ("www.example", "A", "192.0.2.1", 30), ("www.example", "AAAA", "2001:db8::1", 30), ("www.example", "A", "", 0)])
    assert str([r for r in rows if r.status == "event"][0].event_time) == "2026-07-15 03:46:30.250000"


def test_truncated_block_is_dropped_by_a_fresh_one(spark):
    text = "type: MESSAGE\nmessage:\n  type: CLIENT_RES\n" + block("CLIENT_QUERY") + "---"
    assert outcome(logs.dns_message_events(lines(spark, text))) == {"event": 1, "skip": 1}


@pytest.mark.parametrize("parse", [lambda x: logs.radius_events(x, PLAIN), lambda x: logs.dhcp_events(x, PLAIN), logs.dns_text_events, lambda x: logs.dns_packet_events(x, "2026-01-01"), logs.dns_message_events])
def test_parsers_never_raise(spark, parse):
    text = "\n".join(["\0", "<", "<Event>", "10,", ",,,,,,,", "a" * 5000, ": response: ", " - '", "00:00:00.0", "    > : ", "type:", "---"])
    parse(lines(spark, text)).collect()
