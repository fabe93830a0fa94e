"""Removal of repeated flows within a time to live."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: A flow's identity.
KEY = ("src_ip", "dst_ip", "src_port", "dst_port", "protocol", "exporter_ip", "flow_type")
TTL_SECONDS = 60
#: Seconds by which repeats may come late and still be known.
LATE_SECONDS = 600


def first_in_ttl(flows: DataFrame, key: list[str] | tuple[str, ...] = KEY, time: str = "timestamp", ttl_seconds: int = TTL_SECONDS, order: list[str] = ()) -> DataFrame:
    """Flows that aren't a repeat: the first of a key, then each one more than the TTL later than the last kept one.

    A repeat doesn't extend the time to live. Of flows at one instant the first by ``order`` (then
    by all columns) is kept. A key's times are folded in a sorted array: repeats of one key meet in
    one row, as instants with one flow each, so the row holds no more than one flow an instant.
    """
    keys, names = list(key), flows.columns
    one = F.struct(*[F.col(f"`{c}`") for c in (time, *order, *[c for c in names if c not in {time, *order}])])
    instants = flows.groupBy(*keys, F.col(time).alias("_at")).agg(F.min(one).alias("_row"))
    folded = instants.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.unix_micros(F.col("_at").cast("timestamp")).alias("us"), F.col("_row").alias("row")))).alias("all"))
    ttl = ttl_seconds * 1_000_000
    kind = folded.schema["all"].dataType.simpleString()
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.array().cast(kind).alias("kept"))
    step = lambda acc, x: F.when(acc["last"].isNull() | (x["us"] - acc["last"] > ttl), F.struct(x["us"].alias("last"), F.concat(acc["kept"], F.array(x)).alias("kept"))).otherwise(acc)
    return folded.select(F.explode(F.aggregate("all", start, step, lambda acc: acc["kept"])).alias("x")).select("x.row.*").select(*names)


class FirstInTtl(StatefulProcessor):
    """The same for streams: a key's state is the time of its last kept flow.

    A micro-batch's flows are folded in event-time order. A flow that comes late, before the last
    kept one, is a repeat if that lies no more than the TTL ahead. State is dropped once nothing has
    been kept of a key for the TTL and the time that flows may come late, by the clock.
    """

    def __init__(self, time: str, ttl_seconds: int, late_seconds: int | None):
        self.time, self.ttl = time, pd.Timedelta(seconds=ttl_seconds)
        self.held_ms = None if late_seconds is None else 1000 * (ttl_seconds + late_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "us long", self.held_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(self.time, kind="stable")
        last = pd.Timestamp(self.last.get()[0], unit="us") if self.last.exists() else None
        kept = []
        for i, at in enumerate(pd.to_datetime(batch[self.time]).dt.tz_localize(None)):
            if last is None or abs(at - last) > self.ttl:
                kept.append(i)
                last = at if last is None else max(at, last)
        if kept:
            self.last.update((int(last.value // 1000),))
            yield batch.iloc[kept]

    def close(self) -> None:
        pass


def first_in_ttl_stream(flows: DataFrame, key: list[str] | tuple[str, ...] = KEY, time: str = "timestamp", ttl_seconds: int = TTL_SECONDS, late_seconds: int | None = LATE_SECONDS) -> DataFrame:
    """Deduplicated stream; needs the RocksDB state store, whose size disk bounds, not memory.

    A stream whose state expires has work at every trigger and so never ends by itself: for one
    that takes what there is and ends (availableNow), give late_seconds None, and state stays.
    """
    mode = "none" if late_seconds is None else "processingTime"
    return flows.groupBy(*key).transformWithStateInPandas(FirstInTtl(time, ttl_seconds, late_seconds), flows.schema, "append", mode)
