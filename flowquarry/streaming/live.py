"""Live bindings: the current device of an address, the current user of a device, in order of arrival.

The evidence queries (operators.temporal) are the record; this mode gives what holds now, from a
stream of openings and closings. The newest event wins whatever the order of arrival: an older one
changes nothing, and a closing leaves a closed binding that only a newer opening of the same entity,
or one of another entity that isn't older, replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.temporal import TTL_CAP, TTL_FLOOR, TTL_UNKNOWN

_STATE = "entity string, candidate string, us long, closed boolean"
BINDINGS = "key string, entity string, candidate string, event_time timestamp, deadline timestamp, closed boolean"


class LiveBindings(StatefulProcessor):
    """State: a key's newest binding.

    It stays past its deadline, which readers test, for another horizon: an expired binding guards
    against older events that come late. Then its state is dropped, by the clock.
    """

    def __init__(self, horizon: timedelta, expire: bool):
        self.horizon_us, self.expire = int(horizon.total_seconds() * 1_000_000), expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("binding", _STATE, 2 * self.horizon_us // 1000 if self.expire else None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.state.get()) if self.state.exists() else None
        before = held
        for part in rows:
            for entity, candidate, us, opening in part[["entity", "candidate", "us", "opening"]].itertuples(index=False):
                newest = held is None or us >= held[2]
                same = held is not None and held[0] == entity
                if opening and newest and not (same and held[3] and us == held[2]):
                    held = (entity, candidate, int(us), False)
                elif not opening and newest and same:
                    held = (entity, candidate, int(us), True)
        if held is not None and held != before:
            self.state.update(held)
            deadline = held[2] + self.horizon_us
            stamp = lambda us: pd.Timestamp(us, unit="us", tz="UTC")
            yield pd.DataFrame({"key": [key[0]], "entity": [held[0]], "candidate": [held[1]], "event_time": [stamp(held[2])], "deadline": [stamp(deadline)], "closed": [held[3]]})

    def close(self) -> None:
        pass


def live_bindings(events: DataFrame, key: str, entity: str, candidate: str, time: str, opens: Column, closes: Column, horizon: timedelta, expire: bool = True) -> DataFrame:
    """A stream of changed bindings; the last row of a key holds. Needs the RocksDB state store.

    A stream whose state expires never ends by itself; one with the trigger availableNow needs expire False.
    """
    rows = events.where((opens | closes) & (F.col(key) != "")).select(F.col(key).alias("key"), F.col(entity).alias("entity"), F.col(candidate).alias("candidate"), F.unix_micros(F.col(time).cast("timestamp")).alias("us"), opens.alias("opening"))
    return rows.groupBy("key").transformWithStateInPandas(LiveBindings(horizon, expire), BINDINGS, "append", "processingTime" if expire else "none")


def live_leases(dhcp: DataFrame, horizon: timedelta = timedelta(hours=24), expire: bool = True) -> DataFrame:
    return live_bindings(dhcp.where("mac_token <> ''"), "ip", "mac_token", "mac_token", "event_time", F.col("event_id").isin(10, 11), F.col("event_id") == 12, horizon, expire)


def live_sessions(radius: DataFrame, horizon: timedelta = timedelta(hours=24), expire: bool = True) -> DataFrame:
    return live_bindings(radius, "mac_token", "session_id", "user_token", "event_time", F.col("acct_status").isin("Start", "Interim-Update"), F.col("acct_status") == "Stop", horizon, expire)


NAMES = "client_ip string, answer_ip string, qname string, event_time timestamp, deadline timestamp"


class LiveNames(StatefulProcessor):
    """State: the newest resolution of an address by a client; of those at one instant the greatest name.

    State is dropped once it can't hold any more, by the clock: the longest time to live, and as
    much again for events that come late.
    """

    def __init__(self, expire: bool):
        self.expire = expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("name", "us long, qname string, ttl long", 2000 * TTL_CAP if self.expire else None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = tuple(self.state.get()) if self.state.exists() else None
        seen = [tuple(r) for part in rows for r in part[["us", "qname", "ttl"]].itertuples(index=False)]
        us, qname, ttl = held = max([*seen, *([before] if before else [])])
        if held != before:
            self.state.update((int(us), qname, int(ttl)))
            stamp = lambda x: pd.Timestamp(int(x), unit="us", tz="UTC")
            yield pd.DataFrame({"client_ip": [key[0]], "answer_ip": [key[1]], "qname": [qname], "event_time": [stamp(us)], "deadline": [stamp(us + ttl * 1_000_000)]})

    def close(self) -> None:
        pass


def live_names(dns: DataFrame, expire: bool = True) -> DataFrame:
    """A stream of changed names by client and address; the last row of a pair holds up to its deadline.

    A time to live is clamped as in operators.temporal. Needs the RocksDB state store.
    """
    unknown = F.coalesce(F.col("ttl_unknown"), F.lit(False)) if "ttl_unknown" in dns.columns else F.lit(False)
    ttl = F.greatest(F.lit(TTL_FLOOR), F.least(F.lit(TTL_CAP), F.when(unknown, F.lit(TTL_UNKNOWN)).otherwise(F.col("ttl")))).cast("long")
    rows = dns.where("client_ip <> '' and answer_ip <> '' and qname <> ''").select("client_ip", "answer_ip", F.unix_micros(F.col("event_time").cast("timestamp")).alias("us"), "qname", ttl.alias("ttl"))
    return rows.groupBy("client_ip", "answer_ip").transformWithStateInPandas(LiveNames(expire), NAMES, "append", "processingTime" if expire else "none")
