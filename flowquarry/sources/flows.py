"""Flow records: JSON decoding, a generator, a Kafka stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RAW_FLOW, struct, zero


def decode(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Flow records of JSON messages, and the messages that are none.

    Unknown keys are ignored, missing ones are 0 or ''. A message of the wrong shape or with a
    value of the wrong type is rejected whole; the caller may keep rejects in a table.
    """
    schema = StructType([*RAW_FLOW.fields, *struct("_bad string").fields])
    parsed = messages.select("*", F.from_json(F.col(value).cast("string"), schema, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}).alias("_flow"))
    bad = F.col("_flow").isNull() | F.col("_flow._bad").isNotNull()
    others = [c for c in messages.columns if c != value]
    good = parsed.where(~bad).select(*others, *[F.coalesce(F.col(f"_flow.{f.name}"), zero(f.dataType.typeName())).alias(f.name) for f in RAW_FLOW])
    return good, parsed.where(bad).select(*messages.columns)


def flow_time() -> Column:
    """The flow's start, or its receipt where the start is 0, in whole seconds."""
    ns = F.when(F.col("time_flow_start_ns") == 0, F.col("time_received_ns")).otherwise(F.col("time_flow_start_ns"))
    return F.date_trunc("second", F.timestamp_micros(F.floor(ns / 1000000).cast("long") * 1000 + F.floor(ns % 1000000 / 1000).cast("long")))


def generated(spark: SparkSession, n: int, start_ns: int = 1_704_067_200_000_000_000, partitions: int | None = None) -> DataFrame:
    """n flow messages (key, value as JSON), each with a 7-tuple of its own up to 2^24 sources."""
    i = F.col("id")
    byte = lambda shift: F.shiftright(i, shift).bitwiseAND(F.lit(255))
    at = F.lit(start_ns) + i * 1_000_000
    record = F.struct(
        F.lit("NETFLOW_V9").alias("type"), at.alias("time_received_ns"), i.alias("sequence_num"), F.lit(1000).alias("sampling_rate"), F.lit("10.0.0.1").alias("sampler_address"),
        at.alias("time_flow_start_ns"), (at + 500_000).alias("time_flow_end_ns"), F.lit(1500).alias("bytes"), F.lit(3).alias("packets"),
        F.concat_ws(".", F.lit("10"), byte(16), byte(8), byte(0)).alias("src_addr"), F.concat_ws(".", F.lit("203.0"), byte(8), byte(0)).alias("dst_addr"), F.lit("IPv4").alias("etype"),
        F.lit("TCP").alias("proto"), (1024 + i.bitwiseAND(F.lit(0x7FFF))).alias("src_port"), F.lit(443).alias("dst_port"), F.lit(12).alias("in_if"), F.lit(7).alias("out_if"),
        F.lit(13335).alias("src_as"), F.lit(15169).alias("dst_as"), F.lit(24).alias("tcp_flags"), F.lit(58).alias("ip_ttl"),
    )
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return ids.select(F.col("id").cast("string").alias("key"), F.to_json(record).alias("value"))


def kafka_stream(spark: SparkSession, servers: str, topic: str = "raw-flows", group: str = "flowquarry", max_offsets: int = 500_000) -> DataFrame:
    """The topic as a stream; offsets are committed with the sink. Needs Spark's Kafka connector."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("groupIdPrefix", group).option("kafka.isolation.level", "read_committed").option("maxOffsetsPerTrigger", max_offsets).load()


def to_kafka(messages: DataFrame, servers: str, topic: str = "raw-flows") -> None:
    """Publish messages (key, value). Needs Spark's Kafka connector."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
