"""As-of joins on open and close events, with ambiguity told apart from absence.

A key's candidates at an instant are those opened at the last opening time up to it, but for
those closed from then on; they hold until a horizon after the opening, the end included. So
an opening time of a key answers from then up to the next one or the horizon. These spans are
cut at the hours they touch, and a question joins the spans of its key and hour: an equi-join,
which Spark can broadcast or split where a key is crowded. Questions are never sorted by key.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "9999-12-31 00:00:00"


def intervals(events: DataFrame, key: str, entity: str, candidate: str, time: str, opens: Column, closes: Column, horizon: timedelta) -> DataFrame:
    """Binding intervals: key, entity, candidate, valid_from, valid_to (excluded), deadline (included).

    Events are a set: repeated rows change nothing, nor does the order of events of one instant.
    """
    rows = events.where(opens | closes).select(F.col(key).alias("key"), F.col(entity).alias("entity"), F.col(candidate).alias("candidate"), F.col(time).cast("timestamp").alias("at"), opens.alias("opening")).distinct()
    rows = rows.withColumn("us", F.unix_micros("at"))
    later = Window.partitionBy("key").orderBy("us").rangeBetween(1, Window.unboundedFollowing)
    since = Window.partitionBy("key", "entity").orderBy("us").rangeBetween(0, Window.unboundedFollowing)
    next_open = F.min(F.when(F.col("opening"), F.col("at"))).over(later)
    first_close = F.min(F.when(~F.col("opening"), F.col("at"))).over(since)
    ends = rows.withColumn("next_open", next_open).withColumn("first_close", first_close).where("opening")
    valid_to = F.coalesce(F.least("next_open", "first_close"), F.lit(END).cast("timestamp"))
    return ends.select("key", "entity", "candidate", F.col("at").alias("valid_from"), valid_to.alias("valid_to"), (F.col("at") + F.expr(f"INTERVAL {int(horizon.total_seconds() * 1_000_000)} MICROSECOND")).alias("deadline"))


#: Seconds of the buckets by which questions meet spans.
BUCKET = 3600


def by_bucket(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Spans (start included, until, next: microseconds) by key and bucket: keys, bucket, spans (an array).

    A span answers from start to until, the end included, unless a next one has begun. A key has
    few openings in a bucket, so a row is small.
    """
    width = BUCKET * 1_000_000
    last = F.when(F.col("next") <= F.col("until"), F.col("next") - 1).otherwise(F.col("until"))
    cut = spans.select("*", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(last / width))).alias("bucket"))
    rest = [c for c in spans.columns if c not in keys]
    return cut.groupBy(*keys, "bucket").agg(F.collect_list(F.struct(*rest)).alias("spans"))


def _met(questions: DataFrame, spans: DataFrame, keys: dict[str, str], time: str) -> DataFrame:
    """questions as a struct q, their time as at (microseconds), and the span that holds then, null without one.

    Questions without a key ('' or null) meet nothing and don't gather in one task.
    """
    q = F.struct(*[questions[f"`{c}`"] for c in questions.columns])
    asked = questions.select(q.alias("q"), F.unix_micros(questions[time].cast("timestamp")).alias("at"), *[questions[c].alias(f"_{k}") for k, c in keys.items()])
    some = F.lit(True)
    for k in keys:
        some &= F.coalesce(F.col(f"_{k}") != "", F.lit(False))
    first = next(iter(keys))
    asked = asked.withColumn("bucket", F.floor(F.col("at") / (BUCKET * 1_000_000))).withColumn(f"_{first}", F.when(some, F.col(f"_{first}")).otherwise(F.concat(F.lit("\0"), F.xxhash64("q").cast("string"))))
    spans = spans.withColumnsRenamed({k: f"_{k}" for k in keys})
    met = asked.join(spans, [*(f"_{k}" for k in keys), "bucket"], "left")
    holds = F.filter("spans", lambda s: (s["start"] <= F.col("at")) & (F.col("at") <= s["until"]) & F.coalesce(F.col("at") < s["next"], F.lit(True)))
    return met.select("q", "at", F.get(holds, F.lit(0)).alias("span"))


def as_of(questions: DataFrame, key: str, time: str, bindings: DataFrame, value: str, ambiguous: str) -> DataFrame:
    """questions with two more columns: the bound candidate ('' if none or ambiguous) and whether several held.

    One row for each question row; repeated questions stay repeated. Questions without a key have
    no candidate.
    """
    us = F.unix_micros
    entry = F.struct("entity", "candidate", us("valid_to").alias("valid_to"), us("deadline").alias("deadline"))
    openings = bindings.where("key <> ''").groupBy("key", "valid_from").agg(F.collect_list(entry).alias("candidates"), F.max(us("deadline")).alias("until"))
    following = F.lead("start").over(Window.partitionBy("key").orderBy("start"))
    spans = openings.select("key", us("valid_from").alias("start"), "until", "candidates").withColumn("next", following)
    found = _met(questions, by_bucket(spans, ["key"]), {"key": key}, time)
    holding = F.filter("span.candidates", lambda c: (F.col("at") < c["valid_to"]) & (F.col("at") <= c["deadline"]))
    found = found.select("q", holding.alias("holding"))
    who = F.array_distinct(F.transform("holding", lambda c: c["candidate"]))
    several = F.coalesce((F.size(who) > 1) | (F.size(F.array_distinct(F.transform("holding", lambda c: c["entity"]))) > 1), F.lit(False))
    answer = F.when(~several & (F.size(who) == 1), F.get(who, F.lit(0)))
    return found.select("q.*", F.coalesce(answer, F.lit("")).alias(value), several.alias(ambiguous))


def lease_intervals(dhcp: DataFrame, horizon: timedelta = timedelta(hours=24)) -> DataFrame:
    """Devices by address: opened by assignments and renewals, closed by releases."""
    some = dhcp.where("mac_token <> ''")
    return intervals(some, "ip", "mac_token", "mac_token", "event_time", F.col("event_id").isin(10, 11), F.col("event_id") == 12, horizon)


def session_intervals(radius: DataFrame, horizon: timedelta = timedelta(hours=24)) -> DataFrame:
    """Users by device: a session's Stop closes it whatever user it names."""
    some = radius.where("mac_token <> ''")
    return intervals(some, "mac_token", "session_id", "user_token", "event_time", F.col("acct_status").isin("Start", "Interim-Update"), F.col("acct_status") == "Stop", horizon)


#: Seconds that a resolution holds: at least, at most, and where its time to live is unknown.
TTL_FLOOR, TTL_CAP, TTL_UNKNOWN = 60, 3600, 600


def dns_as_of(flows: DataFrame, client: str, answer: str, time: str, dns: DataFrame, value: str) -> DataFrame:
    """flows with the name by which a client last resolved an address, '' if none holds.

    The newest resolution counts, of those at one instant the one with the greatest name; it
    holds up to its clamped time to live, the end included.
    """
    ttl = F.greatest(F.lit(TTL_FLOOR), F.least(F.lit(TTL_CAP), F.when(F.coalesce(F.col("ttl_unknown"), F.lit(False)) if "ttl_unknown" in dns.columns else F.lit(False), F.lit(TTL_UNKNOWN)).otherwise(F.col("ttl"))))
    marks = dns.where("client_ip <> '' and answer_ip <> ''").groupBy(F.col("client_ip").alias("c"), F.col("answer_ip").alias("a"), F.unix_micros(F.col("event_time").cast("timestamp")).alias("start")).agg(F.max(F.struct(F.col("qname"), ttl.alias("ttl"))).alias("seen"))
    following = F.lead("start").over(Window.partitionBy("c", "a").orderBy("start"))
    spans = marks.select("c", "a", "start", F.col("seen.qname").alias("qname"), (F.col("start") + F.col("seen.ttl").cast("long") * 1_000_000).alias("until")).withColumn("next", following)
    found = _met(flows, by_bucket(spans, ["c", "a"]), {"c": client, "a": answer}, time)
    return found.select("q.*", F.coalesce("span.qname", F.lit("")).alias(value))
