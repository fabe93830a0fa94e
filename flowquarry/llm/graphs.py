"""Connected components of large sparse graphs by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_folder

#: An odd factor: multiplication by it is a one-to-one mixing of 64-bit numbers.
FACTOR = -7046029254386353131
INVERSE = pow(FACTOR % (1 << 64), -1, 1 << 64)
INVERSE = INVERSE - (1 << 64) if INVERSE >> 63 else INVERSE

#: Edges of a task, about: what it holds in memory and a spanning forest shrinks.
TASK_EDGES = 1_000_000


def mixed(ids: np.ndarray, factor: int = FACTOR) -> np.ndarray:
    return (ids.astype(np.int64).view(np.uint64) * np.uint64(factor % (1 << 64))).view(np.int64)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the smallest node that each is joined to, by pointer jumping."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        open_ = low != high
        x, y, low, high = x[open_], y[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further
    return nodes, nodes[root]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of a task's edges; a task's edges are merged whenever they add up."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append((np.asarray(batch.column(0)), np.asarray(batch.column(1))))
        size += batch.num_rows
        if size > 2_000_000:
            a, b = forest(np.concatenate([a, *(x for x, _ in held)]), np.concatenate([b, *(y for _, y in held)]))
            held, size = [], 0
    a, b = forest(np.concatenate([a, *(x for x, _ in held)]), np.concatenate([b, *(y for _, y in held)]))
    for i in range(0, len(a), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(a[i : i + 100_000]), pa.array(b[i : i + 100_000])], ["node", "root"])


def components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """Component of every node that has an edge: node, component (the smallest node in it).

    edges: two long columns. Each round joins nodes inside tasks, points every node at the
    smallest of its tasks' roots and goes on with the edges between roots. Roots are smallest
    by a mixed number, so long chains shrink by a constant share a round. No node's edges meet
    in one task: what meets by node is a root a task. Rounds are written to the shared folder.
    """
    spark = edges.sparkSession
    folder = folder or shared_folder(spark)
    a, b = (F.col(f"`{c}`").cast("long") for c in edges.columns)
    edges.select(a.alias("a"), b.alias("b")).where("a <> b").mapInArrow(_mix_rows, "a long, b long").write.parquet(f"{folder}/edges0")
    k = 0
    while True:
        now = spark.read.parquet(f"{folder}/edges{k}")
        tasks = max(1, -(-now.count() // TASK_EDGES))  # few tasks leave few edges between their roots
        now.coalesce(tasks).mapInArrow(_contract, "node long, root long").write.parquet(f"{folder}/forest{k}")
        by = spark.read.parquet(f"{folder}/forest{k}").groupBy("node").agg(F.min("root").alias("root"), F.collect_set("root").alias("roots"))
        by.write.parquet(f"{folder}/nodes{k}")
        nodes = spark.read.parquet(f"{folder}/nodes{k}")
        further = nodes.where(F.size("roots") > 1).select(F.explode("roots").alias("a"), F.col("root").alias("b")).where("a <> b").distinct()
        further.write.parquet(f"{folder}/edges{k + 1}")
        if spark.read.parquet(f"{folder}/edges{k + 1}").isEmpty():
            break
        k += 1
    label = spark.read.parquet(f"{folder}/nodes{k}").select("node", "root")
    for j in range(k - 1, -1, -1):
        below = spark.read.parquet(f"{folder}/nodes{j}").select("node", F.col("root").alias("via"))
        upper = label.withColumnRenamed("node", "via")
        below.join(upper, "via", "left").select("node", F.coalesce("root", "via").alias("root")).write.parquet(f"{folder}/label{j}")
        label = spark.read.parquet(f"{folder}/label{j}")
    plain = label.mapInArrow(_unmix_rows, "node long, root long")
    plain.write.parquet(f"{folder}/plain")
    plain = spark.read.parquet(f"{folder}/plain")
    smallest = plain.groupBy("root").agg(F.min("node").alias("component"))
    smallest.write.parquet(f"{folder}/smallest")
    return plain.join(spark.read.parquet(f"{folder}/smallest"), "root").select("node", "component")


def _mix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(mixed(np.asarray(c))) for c in batch.columns], batch.schema.names)


def _unmix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(mixed(np.asarray(c), INVERSE)) for c in batch.columns], batch.schema.names)
