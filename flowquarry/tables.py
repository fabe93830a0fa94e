"""Stored tables: day-partitioned Parquet, set-semantics reads, retention, storage figures."""

from __future__ import annotations

import io
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .schemas import shaped

PARTITION, BATCH = "event_date", "batch"
RETENTION_DAYS = 120
FLOW_ORDER = ("tenant_id", "timestamp", "src_ip", "dst_ip")


def create_table(spark: SparkSession, name: str, schema: StructType, path: str | None = None) -> None:
    """Create a table in the session's catalog unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {PARTITION} date) USING parquet PARTITIONED BY ({PARTITION}){place}")


def append(df: DataFrame, schema: StructType, path: str, time: str, order: tuple[str, ...] = ()) -> None:
    """Append rows in a table's columns and types, by day, times in whole seconds.

    Rows are dealt by day and sorted, so a day gets few files whose row groups can be skipped;
    a crowded day is split by Spark (rebalance).
    """
    rows = shaped(df, schema).withColumn(time, F.date_trunc("second", F.col(time))).withColumn(PARTITION, F.to_date(time))
    rows = rows.hint("rebalance", F.col(PARTITION))
    (rows.sortWithinPartitions(PARTITION, *order) if order else rows).write.mode("append").partitionBy(PARTITION).parquet(path)


def write_batch(rows: DataFrame, path: str, number: int) -> DataFrame | None:
    """Write rows, which have a day, as a numbered batch below their days and return them as stored; None if there are none.

    Days come first, so readers and expire() see them whatever the batch. The same batch written
    again replaces what it wrote before.
    """
    spark = rows.sparkSession
    rows.withColumn(BATCH, F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION, BATCH).parquet(path)
    own = f"{path}/{PARTITION}=*/{BATCH}={number}"
    place = spark._jvm.org.apache.hadoop.fs.Path(own)
    if not len(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []):
        return None
    return spark.read.schema(rows.schema).option("basePath", path).parquet(own)


def between(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Rows from start to end, both included; also names the days, so other partitions aren't read."""
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    rows = df.where(F.col(time).between(low, high))
    return rows.where(F.col(PARTITION).between(F.to_date(low), F.to_date(high))) if PARTITION in df.columns else rows


def as_set(df: DataFrame) -> DataFrame:
    """Event tables are sets: a row stored twice counts once."""
    return df.dropDuplicates()


def expired_days(spark: SparkSession, path: str, today: date, days: int = RETENTION_DAYS) -> list[str]:
    """Day partitions older than the retention, by name."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    oldest = (today - timedelta(days=days)).isoformat()
    names = [x.getPath().getName() for x in fs.listStatus(place)] if fs.exists(place) else []
    return sorted(n for n in names if n.startswith(f"{PARTITION}=") and n.split("=", 1)[1] < oldest)


def expire(spark: SparkSession, path: str, today: date, days: int = RETENTION_DAYS) -> int:
    """Delete expired day partitions; returns how many."""
    gone = expired_days(spark, path, today, days)
    for name in gone:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(gone)


def same_content(before: DataFrame, after: DataFrame) -> DataFrame:
    """Migration gate: rows and distinct rows of both tables, as side, n_rows, n_distinct."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.xxhash64(*df.columns).alias("h")).agg(F.lit(name).alias("side"), F.count("*").alias("n_rows"), F.count_distinct("h").alias("n_distinct"))

    return side(before, "before").unionAll(side(after, "after"))


def file_sizes(df: DataFrame, name: str) -> DataFrame:
    """table, files, bytes_on_disk, row_count, bytes_per_row of a table's files."""
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).groupBy("path").agg(F.max("size").alias("size"), F.count("*").alias("n"))
    total = files.agg(F.lit(name).alias("table"), F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes_on_disk"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
    return total.withColumn("bytes_per_row", F.round(F.col("bytes_on_disk") / F.greatest(F.col("row_count"), F.lit(1)), 1))


def column_sizes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """column, compressed, uncompressed, ratio, share_pct from the footers of Parquet files.

    Files are read by tasks, whole, so this is for files of a size that a task can hold.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for content in batch.column("content").to_pylist():
                meta = pq.ParquetFile(io.BytesIO(content)).metadata
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        column = group.column(c)
                        rows.append((column.path_in_schema, column.total_compressed_size, column.total_uncompressed_size))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], ["column", "compressed", "uncompressed"])

    found = spark.read.format("binaryFile").load(paths).select("content").mapInArrow(run, "column string, compressed long, uncompressed long")
    by = found.groupBy("column").agg(F.sum("compressed").alias("compressed"), F.sum("uncompressed").alias("uncompressed"))
    total = by.agg(F.sum("compressed").alias("total"))
    share = F.round(100 * F.col("compressed") / F.greatest(F.col("total"), F.lit(1)), 1)
    return by.crossJoin(F.broadcast(total)).select("column", "compressed", "uncompressed", F.round(F.col("uncompressed") / F.greatest(F.col("compressed"), F.lit(1)), 1).alias("ratio"), share.alias("share_pct"))


def readable_size(size: Column) -> Column:
    """A size in bytes as text with a binary unit."""
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]
    step = F.least(F.lit(len(units) - 1), F.floor(F.log(1024.0, F.greatest(size, F.lit(1))))).cast("int")
    return F.concat(F.format_number(size / F.pow(F.lit(1024.0), step), 2), F.lit(" "), F.element_at(F.array(*[F.lit(u) for u in units]), step + 1))
