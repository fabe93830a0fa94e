"""Log-line parsers. Each gives status (event, skip, error) and the fields of an event.

Parsers never raise: malformed lines are rows with status error, lines that aren't theirs have
status skip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import net
from ..functions.identifiers import Identity, normal_host

EVENT, SKIP, ERROR = "event", "skip", "error"


def _time(text: Column, layout: str, zone: str) -> Column:
    """An instant, whole seconds, from local time in a zone; null if malformed."""
    plain = F.regexp_replace(text, r"[.,]\d+$", "")
    return F.to_utc_timestamp(F.try_to_timestamp(plain, F.lit(layout)), zone)


def radius_events(lines: DataFrame, identity: Identity, zone: str = "UTC") -> DataFrame:
    """Accounting records, one XML element a line: status, event_time, acct_status, session_id, user_token, mac_token, nas_ip.

    Records without a known accounting status are skipped, whatever their time; those with one
    but without a time, and malformed lines, are errors.
    """
    names = ("Timestamp", "Event-Timestamp", "User-Name", "Calling-Station-Id", "NAS-IP-Address", "Acct-Status-Type", "Acct-Session-Id")
    # Elements may repeat; the last one counts.
    schema = "STRUCT<" + ", ".join(f"`{n}`: ARRAY<STRING>" for n in names) + ", _corrupt_record: STRING>"
    line = F.trim("line")
    parsed = lines.select("*", F.from_xml(line, schema, {"mode": "PERMISSIVE", "rowTag": "Event"}).alias("x"))
    field = lambda n: F.trim(F.coalesce(F.try_element_at(F.col(f"x.`{n}`"), F.lit(-1)), F.lit("")))
    kind = field("Acct-Status-Type")
    status = F.when(kind.isin("1", "Start"), "Start").when(kind.isin("2", "Stop"), "Stop").when(kind.isin("3", "Interim-Update", "InterimUpdate"), "Interim-Update").otherwise("")
    at = F.coalesce(*[_time(field(n), "MM/dd/yyyy HH:mm:ss", zone) for n in names[:2]])
    broken = F.col("x").isNull() | F.col("x._corrupt_record").isNotNull() | ~line.rlike(r"^<.*>$")
    outcome = F.when(line == "", SKIP).when(broken, ERROR).when(status == "", SKIP).when(at.isNull(), ERROR).otherwise(EVENT)
    return parsed.select(outcome.alias("status"), at.alias("event_time"), status.alias("acct_status"), field("Acct-Session-Id").alias("session_id"), identity.user(field("User-Name")).alias("user_token"), identity.mac(field("Calling-Station-Id")).alias("mac_token"), field("NAS-IP-Address").alias("nas_ip"))


def dhcp_events(lines: DataFrame, identity: Identity, zone: str = "UTC") -> DataFrame:
    """Lease changes of an audit log: status, event_time, event_id (10, 11, 12), ip, mac_token, host_token."""
    part = F.split(F.trim("line"), ",")
    field = lambda i: F.trim(F.coalesce(F.get(part, F.lit(i)), F.lit("")))
    number = F.when(field(0).rlike(r"^[+-]?\d+$"), field(0).try_cast("int"))
    at = _time(F.concat_ws(" ", field(1), field(2)), "MM/dd/yy HH:mm:ss", zone)
    outcome = F.when(number.isNull() | ~number.isin(10, 11, 12), SKIP).when((F.size(part) < 7) | at.isNull(), ERROR).otherwise(EVENT)
    return lines.select(outcome.alias("status"), at.alias("event_time"), number.alias("event_id"), field(4).alias("ip"), identity.mac(field(6)).alias("mac_token"), identity.host(field(5)).alias("host_token"))


_DNS = ("event_time", "client_ip", "client_port", "qname", "qtype", "answer_ip", "ttl", "ttl_unknown")


def _dns_row(at: Column, client: Column, port: Column, qname: Column, qtype: Column, answer: Column, ttl: Column, unknown: Column) -> Column:
    values = (at, client, port.cast("int"), qname, qtype, answer, ttl.cast("long"), unknown)
    return F.struct(*[v.alias(n) for n, v in zip(_DNS, values, strict=True)])


def _outcomes(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """status and events (an array) as rows; what has no event is one row with null fields.

    A filter on status isn't moved below the first generator, where the parse would be made again for it.
    """
    parsed = df.select(*keep, F.explode_outer(F.array(F.struct("status", "events"))).alias("o"))
    return parsed.select(*keep, "o.status", F.explode_outer("o.events").alias("e")).select(*keep, "status", *[F.col(f"e.{n}").alias(n) for n in _DNS])


def dns_text_events(lines: DataFrame, zone: str = "UTC") -> DataFrame:
    """Resolver log: a row for each query and each address answered, or one for an answer without any.

    The name is the one asked for. A time that can't be read comes before any other error.
    """
    # time: two words; then the word client, a handle that begins with @ or none, address#port, (name):, the marker, and the question.
    words = F.split(F.trim("line"), r"\s+")
    split = lines.select(words.alias("w"), F.array_position(words, "client").cast("int").alias("c"))
    word = lambda i: F.coalesce(F.get("w", i), F.lit(""))
    marked = lambda text: F.filter(F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))), lambda i: (word(i) == text) & word(i - 1).endswith(":"))
    split = split.select("*", F.try_element_at(marked("response:"), F.lit(1)).alias("r"), F.try_element_at(marked("query:"), F.lit(1)).alias("q"))
    split = split.select("*", F.coalesce("r", "q").alias("m"), (F.col("c") + word(F.col("c")).startswith("@").cast("int")).alias("e"))
    origin = F.split(word(F.col("e")), "#")
    whole = (F.col("c") > 0) & (F.size(origin) == 2) & (F.get(origin, F.lit(0)) != "") & F.get(origin, F.lit(1)).rlike("^[0-9]+$") & word(F.col("e") + 1).startswith("(") & word(F.col("m") - 1).endswith("):") & (F.col("e") < F.col("m"))
    whole = F.coalesce(whole & (word(F.col("m") + 3) != ""), F.lit(False))
    stamp = F.concat_ws(" ", word(F.lit(0)), word(F.lit(1)))
    at = F.to_utc_timestamp(F.when(stamp.rlike("[.][0-9]+$"), F.try_to_timestamp(F.regexp_replace(stamp, r"(\.\d{1,6})\d*$", "$1"), F.lit("dd-MMM-yyyy HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]"))), zone)
    field = lambda c: F.when(whole, c).otherwise("")
    # A record: owner, time to live, IN, A or AAAA, address. They follow the question and its status.
    first = F.col("r") + 4
    places = F.when(first < F.size("w"), F.filter(F.sequence(first, F.size("w") - 1), lambda i: (word(i) == "IN") & word(i + 1).isin("A", "AAAA") & word(i - 1).rlike("^[0-9]+$")))
    answers = F.transform(places, lambda i: F.struct(word(i - 1).try_cast("long").alias("ttl"), word(i + 1).alias("qtype"), word(i + 2).alias("ip")))
    parsed = split.select(
        F.col("r").isNotNull().alias("response"), F.col("q").isNotNull().alias("query"), at.alias("at"), field(F.get(origin, F.lit(0))).alias("client"), net.port(field(F.get(origin, F.lit(1)))).alias("port"),
        normal_host(field(word(F.col("m") + 1))).alias("qname"), field(word(F.col("m") + 3)).alias("qtype"), F.coalesce(answers, F.array().cast("array<struct<ttl:bigint,qtype:string,ip:string>>")).alias("answers"),
    )
    good = F.filter("answers", lambda a: (a["ttl"] <= 4294967295) & net.fits_type(a["qtype"], a["ip"]))
    parsed = parsed.select("*", good.alias("good"))
    no = F.lit(False)
    answered = F.transform("good", lambda a: _dns_row(F.col("at"), F.col("client"), F.col("port"), F.col("qname"), a["qtype"], a["ip"], a["ttl"], no))
    bare = F.array(_dns_row(F.col("at"), F.col("client"), F.col("port"), F.col("qname"), F.col("qtype"), F.lit(""), F.lit(0), no))
    status = F.when(~F.col("response") & ~F.col("query"), SKIP).when(F.col("at").isNull() | (F.col("client") == "") | (F.col("qname") == ""), ERROR).otherwise(EVENT)
    events = F.when(F.col("response") & (F.size("good") > 0), answered).otherwise(bare)
    return _outcomes(parsed.select(status.alias("status"), F.when(status == EVENT, events).alias("events")))


def packet_lines(lines: DataFrame, base_date: str, zone: str = "UTC") -> DataFrame:
    """Packet text with its payload lines marked live and timed.

    Adds indented, header, udp (a header of a UDP packet), live (a payload whose line before,
    blank ones aside, is such a header) and at. The day moves on where a header's time of day
    falls by more than twelve hours against the header before. Windows run within a file.
    """
    by = Window.partitionBy("path").orderBy("line_no")
    # A header begins with hours:minutes:seconds.fraction.
    clock_word = F.split(F.substring_index("line", " ", 1), ":", 3)
    seconds = F.split(F.get(clock_word, F.lit(2)), "[.]", 2)
    two = [F.get(clock_word, F.lit(0)), F.get(clock_word, F.lit(1)), F.get(seconds, F.lit(0))]
    fraction = F.coalesce(F.regexp_extract(F.get(seconds, F.lit(1)), "^[0-9]+", 0), F.lit(""))
    micros = F.rpad(F.substring(fraction, 1, 6), 6, "0").try_cast("long")
    clock = sum((c.try_cast("long") * k for c, k in zip(two, (3600, 60, 1), strict=True)), F.lit(0)) * 1_000_000 + micros
    valid = F.coalesce((fraction != "") & (two[0] <= "23") & (two[1] <= "59") & (two[2] <= "59"), F.lit(False))
    for c in two:
        valid &= F.coalesce(c.rlike("^[0-9][0-9]$"), F.lit(False))
    some = lines.where("line <> ''").withColumn("indented", F.col("line").rlike("^[ \t]"))
    some = some.withColumn("header", ~F.col("indented") & valid).withColumn("clock", F.when(F.col("header"), clock))
    some = some.withColumn("udp", F.col("header") & (F.col("line").contains("proto UDP") | F.col("line").contains("next-header UDP")))
    before = F.last("clock", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    some = some.withColumn("wrapped", (F.col("header") & (before - F.col("clock") > 12 * 3600 * 1_000_000)).cast("int"))
    some = some.withColumn("day", F.sum(F.coalesce("wrapped", F.lit(0))).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    some = some.withColumn("last_clock", F.last("clock", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    some = some.withColumn("live", F.col("indented") & F.coalesce(F.lag("udp").over(by), F.lit(False)))
    # The time of day is a duration from local midnight, so days with a changed clock come out as instants.
    midnight = F.to_utc_timestamp(F.date_add(F.lit(base_date).cast("date"), F.col("day").cast("int")).cast("timestamp"), zone)
    return some.withColumn("at", F.timestamp_micros(F.unix_micros(midnight) + F.col("last_clock")))


def packet_fields(payload: Column, resolver: str = "") -> dict[str, Column]:
    """Parts of an indented packet line: client, port, is_query, upstream, body; client is null where it is no DNS packet."""
    text = F.ltrim(F.regexp_replace(payload, "^[ \t]+", ""))
    shape = r"(?s)^(.*?) > (.*?): (.*)$"
    src, dst, body = (F.regexp_extract(text, shape, i) for i in (1, 2, 3))
    (src_ip, src_port), (dst_ip, dst_port) = net.endpoint(src), net.endpoint(dst)
    marker = body.rlike(r"(^|\s)\S*\?(\s|$)")
    known = src_port.isNotNull() & dst_port.isNotNull()
    is_query = known & (dst_port == 53) & ((src_port != 53) | marker)
    is_response = known & ~is_query & (src_port == 53)
    client = F.when(is_query, src_ip).when(is_response, dst_ip)
    return {"client": client, "port": F.when(is_query, src_port).when(is_response, dst_port), "is_query": is_query, "upstream": F.lit(resolver != "") & (client == resolver), "body": body}


def dns_packet_events(lines: DataFrame, base_date: str, zone: str = "UTC", resolver: str = "") -> DataFrame:
    """Packet text, two lines a packet: a row for each query and each address answered.

    Answers have no time to live here (ttl_unknown). Answers without records make no row; those
    with records but no address make one. The name of a response is its first record's owner.
    """
    live = packet_lines(lines, base_date, zone)
    parsed = live.select("path", "line_no", "live", "at", *[c.alias(n) for n, c in packet_fields(F.col("line"), resolver).items()])
    words = F.filter(F.split("body", r"\s+"), lambda w: w != "")
    asked = parsed.select("*", words.alias("words"))
    # The question follows the first word, after the first, that ends in a question mark.
    at_ = F.coalesce(F.try_element_at(F.filter(F.sequence(F.lit(1), F.greatest(F.size("words") - 1, F.lit(1))), lambda i: F.coalesce(F.get("words", i), F.lit("")).endswith("?")), F.lit(1)), F.lit(-1))
    # Records follow the counts, up to the packet's length in brackets.
    bare_body = F.regexp_replace("body", r"(?s) \((?:(?! \().)*$", "")
    counts = r"(?s)^.*?(\d+)/\d+/\d+(.*)$"
    asked = asked.select("*", at_.alias("q"), F.regexp_extract(bare_body, counts, 1).try_cast("int").alias("n"), F.trim(F.regexp_extract(bare_body, counts, 2)).alias("records"))
    qtype = F.regexp_replace(F.coalesce(F.get("words", F.col("q")), F.lit("")), r"\?$", "")
    qname = normal_host(F.coalesce(F.get("words", F.col("q") + 1), F.lit("")))
    split = F.transform(F.split("records", ", "), lambda r: F.filter(F.split(r, r"\s+"), lambda w: w != ""))
    first = F.get(split, F.lit(0))
    owner, owner_type = normal_host(F.coalesce(F.get(first, F.lit(0)), F.lit(""))), F.coalesce(F.get(first, F.lit(1)), F.lit(""))
    made = asked.select("path", "line_no", "live", "at", "client", "port", "is_query", "upstream", "n", "records", "q", qtype.alias("qtype"), qname.alias("qname"), split.alias("split"), owner.alias("owner"), owner_type.alias("owner_type"), F.size(first).alias("parts"))
    answers = F.filter("split", lambda r: (F.size(r) >= 3) & net.fits_type(F.get(r, F.lit(1)), F.get(r, F.lit(2))))
    row = lambda name, kind, ip, unknown: _dns_row(F.col("at"), F.col("client"), F.col("port"), name, kind, ip, F.lit(0), F.lit(unknown))
    answered = F.transform(answers, lambda r: row(F.col("owner"), F.get(r, F.lit(1)), F.get(r, F.lit(2)), True))
    use = F.col("live") & F.col("client").isNotNull() & ~F.col("upstream")
    bad_query = (F.col("q") < 0) | (F.col("qtype") == "") | (F.col("qname") == "")
    tagged = F.coalesce(F.col("n") > 0, F.lit(False)) & (F.col("records") != "") & (F.col("parts") >= 2) & (F.col("owner") != "")
    status = F.when(~use, SKIP).when(F.col("is_query"), F.when(bad_query, ERROR).otherwise(EVENT)).when(tagged, EVENT).otherwise(SKIP)
    status = F.coalesce(status, F.lit(SKIP))
    events = F.when(F.col("is_query"), F.array(row(F.col("qname"), F.col("qtype"), F.lit(""), False))).when(F.size(answers) > 0, answered).otherwise(F.array(row(F.col("owner"), F.col("owner_type"), F.lit(""), False)))
    return _outcomes(made.select("path", "line_no", status.alias("status"), F.when(status == EVENT, events).alias("events")), ("path", "line_no"))


def dns_message_events(lines: DataFrame) -> DataFrame:
    """Multi-document message text: a row for each client query and each address answered.

    A column-0 ``type:`` opens a block; it ends at ``---`` or the next such line, and a last block
    without an end is withheld. Only CLIENT_QUERY and CLIENT_RESPONSE count. In a block the last
    value of a key counts; literal bodies (``query_message: |``) run to the next column-0 line.
    """
    by = Window.partitionBy("path").orderBy("line_no")
    line = F.col("line")
    some = lines.where("line <> ''").withColumn("column0", ~line.rlike("^[ \t]"))
    some = some.withColumn("opens", F.col("column0") & line.startswith("type:")).withColumn("ends", F.col("column0") & ((line == "---") | line.startswith("type:")))
    block = F.sum(F.col("ends").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    some = some.withColumn("block", block)
    content = F.regexp_replace(line, "^[ \t]+", "")
    key, value = F.regexp_extract(content, r"^([^:]*)", 1), F.trim(F.regexp_extract(content, r"(?s)^[^:]*:(.*)$", 1))
    some = some.withColumn("item", ~F.col("column0") & content.startswith("- ")).withColumn("content", content)
    some = some.withColumn("key", F.when(~F.col("column0") & ~F.col("item"), key)).withColumn("value", value)
    literal = F.when(F.col("column0"), F.lit(False)).when(F.col("key").isin("query_message", "response_message") & (F.col("value") == "|"), F.lit(True))
    some = some.withColumn("in_literal", F.coalesce(F.last(literal, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)) & ~F.col("column0"))
    some = some.where("not in_literal or column0")
    within = Window.partitionBy("path", "block").orderBy("line_no")
    some = some.withColumn("section", F.last(F.when(~F.col("item") & ~F.col("column0"), F.col("key")), ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.regexp_replace(F.substring("content", 3, 1 << 30), "^'+|'+$", "")
    field = lambda *names: F.max_by(F.when(F.col("key").isin(*names), F.col("value")), F.when(F.col("key").isin(*names), F.col("line_no")))
    stamp = F.try_to_timestamp(F.trim(F.regexp_replace("value", "^!!timestamp", "")))
    time_key = F.col("key").isin("query_time", "response_time") & F.trim(F.regexp_replace("value", "^!!timestamp", "")).rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$") & stamp.isNotNull()
    items = lambda name: F.array_sort(F.collect_list(F.when(F.col("item") & (F.col("section") == name), F.struct("line_no", text.alias("text")))))
    blocks = some.groupBy("path", "block").agg(
        F.bool_or("opens").alias("open"),
        field("type").alias("kind"),
        F.max_by(F.when(time_key, stamp), F.when(time_key, F.col("line_no"))).alias("at"),
        F.regexp_replace(F.coalesce(field("query_address"), F.lit("")), '^"+|"+$', "").alias("client"),
        net.port(F.coalesce(field("query_port"), F.lit(""))).alias("port"),
        items("QUESTION_SECTION").alias("questions"),
        items("ANSWER_SECTION").alias("answers"),
    )
    last = some.groupBy("path").agg(F.max("block").alias("last_block"))
    done = blocks.join(last, "path").where("open and block < last_block")
    words = lambda t: F.filter(F.split(t, r"\s+"), lambda w: w != "")
    question = F.try_element_at(F.filter(F.transform("questions", lambda q: words(q["text"])), lambda w: F.size(w) >= 2), F.lit(-1))
    records = F.filter(F.transform("answers", lambda a: words(a["text"])), lambda w: (F.size(w) >= 5) & F.get(w, F.lit(1)).rlike(r"^\d+$") & (F.get(w, F.lit(1)).try_cast("long") <= 4294967295) & net.fits_type(F.get(w, F.lit(3)), F.get(w, F.lit(4))))
    named = done.select("path", "block", "kind", "at", "client", "port", normal_host(F.coalesce(F.get(question, F.lit(0)), F.lit(""))).alias("qname"), F.coalesce(F.try_element_at(question, F.lit(-1)), F.lit("")).alias("qtype"), records.alias("records"))
    no = F.lit(False)
    answered = F.transform("records", lambda w: _dns_row(F.col("at"), F.col("client"), F.col("port"), F.col("qname"), F.get(w, F.lit(3)), F.get(w, F.lit(4)), F.get(w, F.lit(1)).try_cast("long"), no))
    bare = F.array(_dns_row(F.col("at"), F.col("client"), F.col("port"), F.col("qname"), F.col("qtype"), F.lit(""), F.lit(0), no))
    ours = F.coalesce(F.col("kind").isin("CLIENT_QUERY", "CLIENT_RESPONSE"), no)
    status = F.when(~ours, SKIP).when(F.col("at").isNull() | (F.col("client") == "") | (F.col("qname") == ""), ERROR).otherwise(EVENT)
    events = F.when((F.col("kind") == "CLIENT_RESPONSE") & (F.size("records") > 0), answered).otherwise(bare)
    return _outcomes(named.select("path", "block", status.alias("status"), F.when(status == EVENT, events).alias("events")), ("path", "block"))
