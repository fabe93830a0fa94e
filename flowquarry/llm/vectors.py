"""Near-duplicate vectors by an inverted multi-index, verified exactly.

Unit vectors are cut into halves, each half with a codebook of its own; the product of the
codebooks is a grid of cells. A vector lies in the cell of its halves' nearest centres and
searches cells by the multi-sequence order: pairs of centres by rising sum of two terms, one a
half. A term is a lower bound of the squared distance from the vector's half to any point of
the centre's region, so the traversal may stop once the sum exceeds the squared distance that
the cosine threshold allows: the target recall is then 1. Visited cells' vectors are compared
in double precision.

Equal vectors are one before the search. Cells with many vectors are cut into blocks and each
pair of blocks is a group of its own; a group gives degrees and a spanning forest of its
links, never the links.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, shared_folder
from .graphs import components, forest

MIN_COSINE = 0.98
#: Vectors that codebooks are fitted on, steps of the fit, vectors aimed at in a cell, sample vectors that a centre needs.
#: So codebooks grow with the square root of the vectors of a label, up to 2,500 centres (1.25 billion vectors a label).
TRAIN_VECTORS, STEPS, CELL_VECTORS, CENTRE_VECTORS = 20_000, 10, 200, 8
#: Vectors in a block of a crowded cell; crowded cells known to the driver are at most MAX_CROWDED.
BLOCK, MAX_CROWDED = 1024, 50_000
_PREPARED = "vec_id long, label long, dim int, key binary, raw binary"
_PLACED = "cell string, block int, stored boolean, rep long, n long, raw binary"


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes; key is null where a vector links with nothing."""
    for batch in batches:
        ids, labels, vectors = (batch.column(c) for c in ("vec_id", "label", "embedding"))
        keys, raws, dims = [], [], []
        for vec_id, label, v in zip(ids.to_pylist(), labels.to_pylist(), vectors, strict=True):
            x = None
            if vec_id is not None and label is not None and v.is_valid and v.values.null_count == 0:
                x = np.asarray(v.values, dtype=np.float64)
                if not len(x) or not np.isfinite(x).all() or not x.any():
                    x = None
                else:  # scaling keeps squares finite and doesn't change a cosine
                    x = x / np.abs(x).max() + 0.0
            raws.append(None if x is None else x.tobytes())
            dims.append(0 if x is None else len(x))
            keys.append(None if x is None else hashlib.md5(f"{label}:".encode() + raws[-1]).digest())
        yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), labels.cast(pa.int64()), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())], ["vec_id", "label", "dim", "key", "raw"])


def unit_rows(raws: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raws), dtype=np.float64).reshape(len(raws), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def codebook(x: np.ndarray, k: int, steps: int = STEPS) -> np.ndarray:
    """Centres by Lloyd's steps from rows spread over the sample; a centre without rows stays."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(steps):
        near = (-2 * x @ centres.T + (centres * centres).sum(axis=1)).argmin(axis=1)
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return np.unique(centres, axis=0)


def bounds(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row, and lower bounds of the squared distances to all centres' regions."""
    square = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)
    near = square.argmin(axis=1)
    own = (centres * centres).sum(axis=1)
    apart = np.sqrt(np.maximum(own[:, None] - 2 * centres @ centres.T + own, 0.0))
    # A distance that rounding could make too large would give too large a bound.
    apart = np.where(apart > 1e-6, apart, 0.0)[near]
    # Distance to the plane halfway between the nearest centre and the other one.
    plane = (square - square[np.arange(len(x)), near][:, None]) / (2 * np.where(apart > 0, apart, np.inf))
    return near, np.maximum(plane, 0.0) ** 2


def spread(rep: int, parts: int) -> int:
    """A part for an id; ids with a common factor don't meet in one."""
    return ((rep * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 32) % parts


def multi_sequence(first: np.ndarray, second: np.ndarray, most: float) -> list[tuple[int, int]]:
    """Cells by rising sum of their terms, as long as it is at most ``most``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, out = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, []
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > most:
            break
        out.append((int(a[i]), int(b[j])))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))
    return out


def _codebooks(reps: DataFrame, total: int, labels: int, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Two codebooks for each number of dimensions in a bounded sample, chosen by a hash of the vector."""
    point = F.pmod(F.xxhash64("key"), F.lit(1_000_000)) / 1_000_000
    rows = reps.where(point < min(1.0, sample / max(total, 1))).select("key", "dim", "raw").toArrow().sort_by("key").to_pydict()
    k = int(np.clip(np.sqrt(total / (max(labels, 1) * CELL_VECTORS)), 2, max(2, sample // CENTRE_VECTORS)))
    found = {}
    for dim in sorted(set(rows["dim"])):
        x = unit_rows([r for r, d in zip(rows["raw"], rows["dim"], strict=True) if d == dim])
        half = dim // 2
        found[dim] = codebook(x[:, :half], k) if half else np.zeros((1, 0)), codebook(x[:, half:], k)
    return found


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, sample: int = TRAIN_VECTORS, block: int = BLOCK, folder: str | None = None) -> DataFrame:
    """Links between vectors of equal label with a cosine of at least ``min_cosine``.

    Input: vec_id, embedding, label. Output, a row for each input row: vec_id, n_links (other
    rows linked directly), component_id (smallest vec_id reachable, itself included), kept
    (vec_id = component_id). Vectors that are null, empty, zero or hold null or non-finite
    components, and rows with a null label or vec_id, link with nothing; so do vectors of
    unlike length. Repeated rows link with each other. Other columns are ignored; an empty
    table gives an empty result. All links are found (see the module's text).
    """
    spark = vectors.sparkSession
    folder = folder or shared_folder(spark)
    vectors.select("vec_id", "label", "embedding").mapInArrow(_prepare, _PREPARED).write.parquet(f"{folder}/vectors")
    prepared = spark.read.parquet(f"{folder}/vectors")
    prepared.where("key is not null").groupBy("key", "label", "dim").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("raw").alias("raw")).write.parquet(f"{folder}/reps")
    reps = spark.read.parquet(f"{folder}/reps")
    total, labels = reps.agg(F.count("*"), F.count_distinct("label")).first()
    books = _codebooks(reps, total, labels, sample)
    most = 2.0 - 2.0 * min_cosine + 1e-9

    def place(batches: Iterator[pa.RecordBatch], crowded: dict[str, int], search: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            columns = {c: batch.column(c).to_pylist() for c in ("label", "dim", "rep", "n", "raw")}
            for dim in sorted(set(columns["dim"])):
                at = [i for i, d in enumerate(columns["dim"]) if d == dim]
                one, two = books.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))
                step = max(16, 1_000_000 // (len(one) + len(two)))  # rows whose distances to all centres are held
                for j, i in enumerate(at):
                    k = j % step
                    if not k:
                        unit = unit_rows([columns["raw"][x] for x in at[j : j + step]])
                        near1, low1 = bounds(unit[:, : dim // 2], one)
                        near2, low2 = bounds(unit[:, dim // 2 :], two)
                    rep, n, raw = columns["rep"][i], columns["n"][i], columns["raw"][i]
                    name = f"{columns['label'][i]}:{dim}:"
                    cell = f"{name}{near1[k]}:{near2[k]}"
                    own = crowded.get(cell, 1)
                    # A crowded cell has a grid of blocks: stored vectors fill a row of it, searching ones a column.
                    rows += [(cell, spread(rep, own) * own + x, True, rep, n, raw) for x in range(own)]
                    if search:
                        for a, b in multi_sequence(low1[k], low2[k], most):
                            cell = f"{name}{a}:{b}"
                            there = crowded.get(cell, 1)
                            rows += [(cell, x * there + spread(rep, there), False, rep, n, raw) for x in range(there)]
                    if len(rows) > 20_000:
                        yield _placed(rows)
                        rows = []
            if rows:
                yield _placed(rows)

    size = max(block, total // MAX_CROWDED)
    stored = reps.mapInArrow(lambda x: place(x, {}, False), _PLACED).groupBy("cell").count().where(F.col("count") > size).collect()
    crowded = {r["cell"]: -(-r["count"] // size) for r in stored}
    placed = reps.mapInArrow(lambda x: place(x, crowded, True), _PLACED)

    def compare(group: pa.Table) -> pa.Table:
        stored = group.filter(group.column("stored"))
        search = group.filter(pc.invert(group.column("stored")))
        ids, out = [np.asarray(x.column("rep")) for x in (stored, search)], []
        if stored.num_rows and search.num_rows:
            kept, n = unit_rows(stored.column("raw").to_pylist()), np.asarray(stored.column("n"))
            for i in range(0, search.num_rows, 2048):
                some = search.slice(i, 2048)
                near = unit_rows(some.column("raw").to_pylist()) @ kept.T >= min_cosine
                near &= ids[1][i : i + 2048, None] != ids[0][None]
                x, y = np.nonzero(near)
                if len(x):
                    here = ids[1][i : i + 2048]
                    degree = near @ n
                    nodes, roots = forest(here[x], ids[0][y])
                    out.append((nodes, roots, np.zeros(len(nodes), np.int64)))
                    out.append((here[degree > 0], here[degree > 0], degree[degree > 0]))
        columns = [np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in range(3)]
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=["node", "root", "links"])

    placed.groupBy("cell", "block").applyInArrow(compare, "node long, root long, links long").write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")
    joined = components(found.where("node <> root").select("node", "root"), f"{folder}/graph")
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    stats = reps.select("key", "rep", "n").join(degrees, F.col("rep") == F.col("node"), "left").drop("node").join(joined, F.col("rep") == F.col("node"), "left")
    stats.select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")).write.parquet(f"{folder}/stats")
    result = prepared.select("vec_id", "key").join(spark.read.parquet(f"{folder}/stats"), "key", "left")
    component = F.coalesce("component_id", "vec_id")
    result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept")).write.parquet(f"{folder}/result")
    for name in ("vectors", "reps", "found", "graph", "stats"):
        dropped(spark, f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/result")


def _placed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["cell", "block", "stored", "rep", "n", "raw"])


#: All pairs in DuckDB, for tests on small tables.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding]) AND list_bool_or([x <> 0 FOR x IN embedding])
), link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
deg AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings e LEFT JOIN low ON low.x = vec_id LEFT JOIN deg ON deg.x = vec_id
"""
