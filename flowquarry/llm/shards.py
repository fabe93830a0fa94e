"""Sharding with size-tiered compaction and a versioned manifest.

Arrivals are appended as small immutable Parquet shards. Shards of similar size form a tier;
once a tier holds enough of them they are merged into one shard of target-sized files, which
belongs to a higher tier. What a store holds is named by a manifest, a JSON file for each
version. A version is committed by renaming its finished manifest into place, which fails if
another writer was first, so readers see a whole version or the one before. Data files are
never changed; vacuum() removes those that only forgotten versions name. Folders that no version names
may belong to a writer that hasn't committed yet, so they go only after a time of grace.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession

#: Size of a compacted file, size that divides the lowest tier from the next, shards of a tier that are merged.
TARGET_BYTES, BASE_BYTES, FAN_IN = 128 << 20, 4 << 20, 4

#: Seconds for which a folder that no version names is kept, and commits tried against other writers.
GRACE_SECONDS, TRIES = 24 * 3600, 50


class CommitConflict(RuntimeError):
    """Another writer has committed the version first."""


@dataclass(frozen=True)
class Shard:
    """An immutable folder of Parquet files."""

    path: str
    files: int
    size: int
    rows: int

    def tier(self, base: int = BASE_BYTES, fan_in: int = FAN_IN) -> int:
        return max(0, math.floor(math.log(max(self.size, 1) / base, fan_in)) + 1) if self.size >= base else 0


class ShardStore:
    """A table below one folder of a file system that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, target: int = TARGET_BYTES, base: int = BASE_BYTES, fan_in: int = FAN_IN):
        self.spark, self.folder, self.target, self.base, self.fan_in = spark, folder.rstrip("/"), target, base, fan_in
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def versions(self) -> list[int]:
        """Committed versions in rising order."""
        place = self._path("manifests")
        if not self._fs.exists(place):
            return []
        names = [x.getPath().getName() for x in self._fs.listStatus(place)]
        return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json") and not x.startswith((".", "_")))

    def manifest(self, version: int | None = None) -> list[Shard]:
        """Shards of a version, the newest unless named; none before the first commit."""
        known = self.versions()
        if version is None and not known:
            return []
        if version is not None and version not in known:
            raise ValueError(f"no version {version}")
        stream = self._fs.open(self._path(f"manifests/{version if version is not None else known[-1]:010d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Shard(**x) for x in json.loads(text)["shards"]]

    def _commit(self, version: int, shards: list[Shard]) -> None:
        place = self._path(f"manifests/{version:010d}.json")
        part = self._path(f"manifests/.{uuid.uuid4().hex}")
        self._fs.mkdirs(place.getParent())
        stream = self._fs.create(part, False)
        try:
            stream.write(bytearray(json.dumps({"version": version, "shards": [asdict(x) for x in shards]}).encode()))
        finally:
            stream.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        mode = self.spark.sparkContext._gateway.new_array(rename, 1)
        mode[0] = rename.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration()).rename(part, place, mode)
        except Exception as error:
            self._fs.delete(part, False)
            raise CommitConflict(f"version {version} exists") from error

    def _written(self, df: DataFrame) -> Shard:
        name = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{name}")
        return self._shard(name, df)

    def _shard(self, name: str, like: DataFrame) -> Shard:
        files = [x for x in self._fs.listStatus(self._path(name)) if x.getPath().getName().endswith(".parquet")]
        rows = self.spark.read.schema(like.schema).parquet(f"{self.folder}/{name}").count()  # from the files' footers
        return Shard(name, len(files), sum(x.getLen() for x in files), rows)

    def _added(self, shard: Shard) -> int:
        for _ in range(TRIES):
            known = self.versions()
            try:
                self._commit(version := known[-1] + 1 if known else 0, [*(self.manifest(known[-1]) if known else []), shard])
                return version
            except CommitConflict:
                continue
        raise CommitConflict(f"{TRIES} commits were overtaken by other writers")

    def append(self, df: DataFrame) -> int:
        """Add an arrival as a new shard; returns the version that holds it. Another writer's commit in between is kept."""
        return self._added(self._written(df))

    def staged(self, df: DataFrame, batch: Column, n: int) -> list[str | None]:
        """Write arrivals 0 to n - 1, which ``batch`` tells apart, in one pass; their folders, None for one without rows."""
        column = "_arrival"
        while column in df.columns:
            column += "_"
        name = f"data/{uuid.uuid4().hex}"
        df.withColumn(column, batch).write.partitionBy(column).parquet(f"{self.folder}/{name}")
        folders = [f"{name}/{column}={k}" for k in range(n)]
        return [x if self._fs.exists(self._path(x)) else None for x in folders]

    def adopt(self, folder: str, like: DataFrame) -> int:
        """Add a staged arrival as a new shard."""
        name = f"data/{uuid.uuid4().hex}"
        if not self._fs.rename(self._path(folder), self._path(name)):
            raise FileNotFoundError(folder)
        return self._added(self._shard(name, like))

    def compact(self) -> int | None:
        """Merge every tier that holds enough shards, lowest first; returns the new version, None if nothing is due.

        A merge reads the shards' files and writes as many as the target size asks for, without a
        shuffle; a task handles about one target-sized file. Shards that other writers append
        meanwhile stay; if another writer has merged one of the same shards, nothing is changed.
        """
        known = self.versions()
        if not known:
            return None
        before = self.manifest(known[-1])
        shards, made = list(before), []
        while True:
            tiers: dict[int, list[Shard]] = {}
            for x in shards:
                tiers.setdefault(x.tier(self.base, self.fan_in), []).append(x)
            due = [t for t in sorted(tiers) if len(tiers[t]) >= self.fan_in and sum(x.files for x in tiers[t]) > math.ceil(sum(x.size for x in tiers[t]) / self.target)]
            if not due:
                break
            run = tiers[due[0]]
            files = max(1, math.ceil(sum(x.size for x in run) / self.target))
            made.append(self._written(self._read(run).coalesce(files)))
            shards = [x for x in shards if x not in run] + made[-1:]
        if not made:
            return None
        kept, merged, version = [x for x in shards if x in made], {x.path for x in before if x not in shards}, None
        for _ in range(TRIES):
            last = self.versions()[-1]
            now = self.manifest(last)
            if not merged <= {x.path for x in now}:
                kept = []
                break
            try:
                self._commit(last + 1, [*(x for x in now if x.path not in merged), *kept])
                version = last + 1
                break
            except CommitConflict:
                continue
        for x in made:  # merged again, or overtaken: no version names them
            if version is None or x not in kept:
                self._fs.delete(self._path(x.path), True)
        return version

    def _read(self, shards: list[Shard]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.folder}/{x.path}" for x in shards])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, the newest unless named."""
        shards = self.manifest(version)
        if not shards:
            raise ValueError("the store has no shard")
        return self._read(shards)

    def vacuum(self, keep: int = 1, grace: float = GRACE_SECONDS) -> int:
        """Forget all but the newest versions and delete the shards that only they name, and unnamed folders older than ``grace``; returns the number deleted."""
        known = self.versions()
        held = {x.path for v in known[-keep:] for x in self.manifest(v)}
        named = {x.path for v in known[:-keep] for x in self.manifest(v)}
        found = list(self._fs.listStatus(self._path("data"))) if self._fs.exists(self._path("data")) else []
        old = {f"data/{x.getPath().getName()}" for x in found if time.time() - x.getModificationTime() / 1000 >= grace}
        gone = [name for x in found if (name := f"data/{x.getPath().getName()}") not in held and (name in named or name in old)]
        for x in gone:
            self._fs.delete(self._path(x), True)
        for v in known[:-keep]:
            self._fs.delete(self._path(f"manifests/{v:010d}.json"), False)
        return len(gone)


def shard_arrivals(df: DataFrame, batch: Column, n: int, folder: str) -> ShardStore:
    """Append the arrivals 0 to n - 1 that ``batch`` tells apart, compacting and vacuuming after each, and return the store.

    The table is read once. Nothing is required of its columns. A table without rows makes a shard
    without rows, so it has a schema to be read with. Repeated rows stay repeated; null values stay null.
    """
    store = ShardStore(df.sparkSession, folder)
    staged = [x for x in store.staged(df, batch, n) if x]
    for one in staged:
        store.adopt(one, df)
        if store.compact() is not None:
            store.vacuum()
    if not staged:
        store.append(df.limit(0))
    return store
