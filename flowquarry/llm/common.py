"""Pieces that several operators share: shared-folder tables, Arrow batches, word tables."""

from __future__ import annotations

import ctypes
import functools
import gc
import itertools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Characters of text that one step of an Arrow function handles at a time.
SLICE_CHARS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    The setting is read from the session. Only where it is unset (tests, local runs) a
    folder below the warehouse takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{base.rstrip('/')}/fq-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "t", folder: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives lost executors."""
    path = f"{folder or shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dropped(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate tables through Spark's file system layer."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(df: DataFrame) -> None:
    """Have Spark and Python exchange texts in small batches, unless the session says otherwise.

    The defaults, ten thousand rows and 64 MB, are made for numbers and large executors; a batch
    of texts is held several times over in a worker and in the executor's direct memory.
    """
    for key, default, value in (("maxRecordsPerBatch", "10000", "1000"), ("maxBytesPerBatch", "67108864b", "4m"), ("maxBytesPerOutputBatch", "-1b", "4m")):
        key = f"spark.sql.execution.arrow.{key}"
        if df.sparkSession.conf.get(key, None) == default:
            df.sparkSession.conf.set(key, value)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function after whose tasks the worker, which lives on, gives its free memory back to the system."""
    return functools.partial(_released, run)


def _released(run: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _tune()
    yield from run(batches)
    give_back()


def lean(made: Callable, *arguments: object) -> object:
    """made(*arguments) on the driver; what it needed beside its result goes back to the system."""
    _tune()
    out = made(*arguments)
    give_back()
    return out


@functools.cache
def _allocator() -> ctypes.CDLL | None:
    """The C library, where it is one whose allocator can be tuned."""
    try:
        library = ctypes.CDLL(None)
        return library if hasattr(library, "malloc_trim") and hasattr(library, "mallopt") else None
    except OSError:
        return None


@functools.cache
def _tune() -> None:
    """Once a process: Arrow's buffers come from the C library, and its large blocks stay separate, so they can be given back."""
    pa.set_memory_pool(pa.system_memory_pool())
    if library := _allocator():
        library.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD; a fixed one doesn't grow
        library.mallopt(-1, 16 << 20)  # M_TRIM_THRESHOLD


def give_back() -> None:
    """Free memory of this process goes back to the system."""
    gc.collect()
    if library := _allocator():
        library.malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str = "text", chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about so much text; one row is never cut."""
    if batch.num_rows == 0:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < len(size):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + chars, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def carrying(docs: DataFrame, result: str, *extra: Column) -> tuple[DataFrame, StructType]:
    """docs as one column ``row`` beside extra columns, and the schema of a result that carries it.

    As a struct the input's columns keep their names whatever the result's are.
    """
    schema = StructType.fromDDL(result).add("row", docs.schema)
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *extra), schema


def with_text(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A batch that has its text in ``row`` gets it as a column too, without a copy."""
    return batch if "text" in batch.schema.names else batch.append_column("text", pc.struct_field(batch.column("row"), "text"))


class WordTable:
    """Numbers words 0, 1, ... and keeps one row of values for each.

    ``fill(words)`` makes the values of new words: a list of arrays, a row a word. A word's
    values are then looked up instead of made again. The table is emptied once it holds
    ``cap`` words, so its memory is bounded; results don't depend on that.
    """

    def __init__(self, fill: Callable[[list[str]], list[np.ndarray]], cap: int = 250_000):
        self.fill, self.cap = fill, cap
        self.ids: dict[str, int] = {}
        self.values: list[np.ndarray] = []
        self.room = 0

    def numbers(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one list after the other, and the lists' bounds."""
        if len(self.ids) > self.cap:
            self.ids, self.values, self.room = {}, [], 0
        bounds = np.zeros(len(lists) + 1, dtype=np.int64)
        np.cumsum([len(x) for x in lists], out=bounds[1:])
        out = np.fromiter(map(self.ids.get, itertools.chain.from_iterable(lists), itertools.repeat(-1)), dtype=np.int64, count=int(bounds[-1]))
        missing = np.flatnonzero(out < 0)
        if len(missing) or not self.values:
            words = [lists[i][j] for i, j in _places(missing, bounds)]
            self._add(list(dict.fromkeys(words)))
            out[missing] = list(map(self.ids.__getitem__, words))
        return out, bounds

    def _add(self, fresh: list[str]) -> None:
        made, n = self.fill(fresh), len(self.ids)
        if not self.values:
            self.values = [np.empty((0, *x.shape[1:]), dtype=x.dtype) for x in made]
        if n + len(fresh) > self.room:
            self.room = max(2 * self.room, n + len(fresh), 4096)
            grown = []
            for old in self.values:
                new = np.empty((self.room, *old.shape[1:]), dtype=old.dtype)
                new[:n] = old[:n]
                grown.append(new)
            self.values = grown
        for kept, x in zip(self.values, made, strict=True):
            kept[n : n + len(fresh)] = x
        self.ids.update(zip(fresh, range(n, n + len(fresh)), strict=True))


def _places(at: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """List and place in it of each position."""
    which = np.searchsorted(bounds, at, side="right") - 1
    return zip(which.tolist(), (at - bounds[which]).tolist(), strict=True)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows; an empty run sums to zero. A run's sum depends on its rows alone."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), dtype=values.dtype)
    some = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(some):
        out[some] = np.add.reduceat(values, bounds[:-1][some], axis=0)
    return out
