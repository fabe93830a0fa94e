"""Structured Streaming jobs: ingest with enrichment and rollups, log followers, counters."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import schemas, tables
from ..operators import dedup, enrich, rollup
from ..sources.flows import decode
from ..sources.lines import Tail

log = logging.getLogger(__name__)

#: The state store whose size disk bounds; deduplication over time needs it.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class Refreshed:
    """A dimension that is read again once it is older than its interval; a failed read keeps the last good one.

    With a shared folder each reading is written there whole before it takes the last one's place,
    so a source that breaks later breaks no batch.
    """

    load: Callable[[SparkSession], DataFrame]
    every: timedelta
    clock: Callable[[], float] = time.monotonic
    folder: str | None = None
    _held: DataFrame | None = None
    _at: float = field(default=float("-inf"))

    def get(self, spark: SparkSession) -> DataFrame:
        if self._held is None or self.clock() - self._at >= self.every.total_seconds():
            try:
                fresh = self.load(spark)
                if self.folder is None:
                    fresh.schema  # noqa: B018  a source that can't be opened fails here, not in the batch
                else:
                    path = f"{self.folder}/{uuid.uuid4().hex}"
                    fresh.write.parquet(path)
                    fresh = spark.read.schema(fresh.schema).parquet(path)
                self._held, self._at = fresh, self.clock()
            except Exception:
                if self._held is None:
                    raise
                log.exception("a dimension could not be read again; the last one stays")
                self._at = self.clock()
        return self._held


@dataclass
class Dimensions:
    tenants: Refreshed | None = None
    threats: Refreshed | None = None
    city: Refreshed | None = None
    asn: Refreshed | None = None
    leases: Refreshed | None = None
    sessions: Refreshed | None = None
    dns: Refreshed | None = None

    def read(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {k: v.get(spark) for k, v in vars(self).items() if v is not None}


@dataclass
class Running:
    """Queries that belong together: one that fails is heard of, whichever it is."""

    queries: list[StreamingQuery]

    def awaitTermination(self, timeout: float | None = None) -> bool:
        """Wait for all; raises the first failure."""
        until = None if timeout is None else time.monotonic() + timeout
        while any(q.isActive for q in self.queries):
            for q in self.queries:
                q.awaitTermination(0.2)
            if until is not None and time.monotonic() > until:
                return False
        for q in self.queries:
            q.awaitTermination(1)
        return True

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    @property
    def isActive(self) -> bool:
        """Whether all still run."""
        return all(q.isActive for q in self.queries)


def ingest(messages: DataFrame, folder: str, dimensions: Dimensions, checkpoint: str, every: str = "1 second", ttl_seconds: int = dedup.TTL_SECONDS, once: bool = False) -> Running:
    """Messages to the flow table and partial rollups: decode, deduplicate, enrich, write.

    Tables: flows, flows_1m, flows_1h (partial rows, read through rollup.merged) and rejected below
    ``folder``, by day and then by batch: tables.expire() drops their days. A repeated batch replaces its own
    files and nothing counts twice. Back pressure is the source's limit per trigger; retries are
    Spark's replay from the checkpoint, so no row is given up. ``once`` takes what there is and ends;
    its deduplication state doesn't expire, so a checkpoint belongs to one of the two ways.
    """
    good, bad = decode(messages)
    flows = dedup.first_in_ttl_stream(enrich.flat(good), ttl_seconds=ttl_seconds, late_seconds=None if once else dedup.LATE_SECONDS)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = schemas.shaped(enrich.enriched(batch, **dimensions.read(spark)), schemas.FLOWS).withColumn(tables.PARTITION, F.to_date("timestamp"))
        rows = rows.hint("rebalance", F.col(tables.PARTITION)).sortWithinPartitions(tables.PARTITION, *tables.FLOW_ORDER)
        stored = tables.write_batch(rows, f"{folder}/flows", number)
        if stored is not None:
            for unit, name in (("minute", "flows_1m"), ("hour", "flows_1h")):
                partial = rollup.rollup(stored, unit).withColumn(tables.PARTITION, F.to_date("timestamp"))
                tables.write_batch(partial.hint("rebalance", F.col(tables.PARTITION)), f"{folder}/{name}", number)

    def reject(batch: DataFrame, number: int) -> None:
        tables.write_batch(batch.withColumn(tables.PARTITION, F.current_date()), f"{folder}/rejected", number)

    when = {"availableNow": True} if once else {"processingTime": every}
    kept = flows.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/flows").trigger(**when).start()
    return Running([kept, bad.writeStream.foreachBatch(reject).option("checkpointLocation", f"{checkpoint}/rejected").trigger(**when).start()])


def minute_windows(flows: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Minute rollup of a stream by watermark; a minute appears once no more rows of it are awaited."""
    rows = flows.withWatermark("timestamp", late)
    by = rows.groupBy(F.window("timestamp", "1 minute"), *rollup.KEYS).agg(F.sum("bytes").cast("long").alias("bytes"), F.sum("packets").cast("long").alias("packets"), F.count("*").alias("flow_count"))
    return by.select(F.col("window.start").alias("timestamp"), *rollup.KEYS, "bytes", "packets", "flow_count")


def follow_logs(spark: SparkSession, folder: str, parse: Callable[[DataFrame], DataFrame], schema, table: str, checkpoint: str, every: str = "30 seconds", once: bool = False) -> StreamingQuery:
    """Append the events of log files that appear in a folder to an event table.

    Files are taken whole and once, so they must be moved into place when finished. Parsers with
    state see a file's lines in order. Errors are counted, not raised. Rows that come twice count
    once, as event tables are read as sets.
    """
    files = spark.readStream.format("text").option("wholetext", "true").load(folder)

    def write(batch: DataFrame, number: int) -> None:
        lines = batch.select(F.col("value")).withColumn("path", F.md5("value")).select("path", F.posexplode(F.split("value", "\n")).alias("line_no", "line")).select("path", F.col("line_no").cast("long"), F.regexp_replace("line", "\r+$", "").alias("line"))
        observed = parse(lines)
        tables.append(observed.where("status = 'event'").drop("status"), schema, table, "event_time")

    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**({"availableNow": True} if once else {"processingTime": every})).start()


def follow_growing(spark: SparkSession, tail: Tail, parse: Callable[[DataFrame], DataFrame], schema, table: str, offsets: str) -> int:
    """One scan of growing files: events of their new lines go to an event table; returns the number of lines.

    For parsers without state, on the host that has the files. Offsets are kept in a file that is
    replaced once the events are stored; what a crash in between repeats counts once, as event
    tables are read as sets.
    """
    place = Path(offsets)
    if place.exists():
        tail.offsets = json.loads(place.read_text())
    found = list(tail.scan())
    if found:
        observed = parse(spark.createDataFrame([(path, i, line) for i, (path, line) in enumerate(found)], "path string, line_no long, line string"))
        tables.append(observed.where("status = 'event'").drop("status"), schema, table, "event_time")
        part = place.with_suffix(".part")
        part.write_text(json.dumps(tail.offsets))
        part.replace(place)
    return len(found)


class Counters(StreamingQueryListener):
    """Totals of observed metrics (see counted()) over all progress events."""

    def __init__(self) -> None:
        self.totals: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in (event.progress.observedMetrics or {}).items():
            for key, value in row.asDict().items():
                self.totals[f"{name}.{key}"] = self.totals.get(f"{name}.{key}", 0) + int(value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def counted(flows: DataFrame, name: str = "enrich") -> DataFrame:
    """Enriched flows whose counts are observed: hits mean at least one side."""
    have = set(flows.columns)
    count = {"received": F.count(F.lit(1))}
    for key, columns in {"identity_hits": ("src_mac_token", "dst_mac_token"), "dns_hits": ("src_hostname", "dst_hostname")}.items():
        if set(columns) <= have:
            count[key] = F.count_if((F.col(columns[0]) != "") | (F.col(columns[1]) != ""))
    for key in ("is_threat_src", "is_threat_dst", "is_sampled"):
        if key in have:
            count[key] = F.count_if(F.col(key) == 1)
    return flows.observe(name, *[c.alias(k) for k, c in count.items()])
