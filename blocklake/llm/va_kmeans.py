"""Centroid clustering over a VA-file: k-means that reads few-bit cells and fetches a vector only where it must.

Vectors are integers, stored in Spark's bucketed layout under a key; beside them lies the approximation file: per
vector its cell in every dimension, `bits` bits each. A round builds a lookup table per dimension, cell and
centroid with the least and the greatest that a vector of that cell can add to its distance; summed over the
dimensions they bound the distance. Distances are taken relative to the one from a common point, which changes no
comparison and makes the intervals narrow where the centroids lie near one another.

Sums are kept from round to round: a round looks at the assignment before and after the last update. Where both
are certain from the intervals and equal, nothing is read; the other vectors are fetched by key, assigned exactly,
and those that moved change the sums. Only centroids, counts and sums reach the driver.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import materialize
from blocklake.plans.bucketed import buckets_for, write_bucketed
from blocklake.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 6
SAMPLE = 4096  # vectors the cell borders are read from; any borders give the same result
ROWS_PER_BUCKET = 400_000
LIMIT = 1 << 27  # greatest component whose squared distances fit a long


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, x): the vectors of `dims` finite components, each as floor(scale * component)."""
    e = F.col("e")
    fit = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    kept = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("e")).where(
        (F.size(e) == dims) & F.forall(e, fit))
    cell = lambda v: F.when(F.abs(v * scale) < LIMIT, F.floor(v * scale).cast("int")).otherwise(
        F.raise_error(F.lit("vector component too large: squared distances must fit 64 bits")).cast("int"))
    return kept.select("vec_id", F.transform(e, cell).alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(-1, dims)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance); ties go to the smaller number."""
    d = (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)[None]
    a = d.argmin(1)
    return a, d[np.arange(len(x)), a]


def pack(cells: np.ndarray, bits: int) -> np.ndarray:
    """(n, d) small integers as rows of bytes, `bits` bits each."""
    each = np.unpackbits(cells.astype(np.uint8)[:, :, None], axis=2)[:, :, 8 - bits :]
    return np.packbits(each.reshape(len(cells), -1), axis=1)


def unpack(rows: np.ndarray, dims: int, bits: int) -> np.ndarray:
    each = np.unpackbits(rows, axis=1)[:, : dims * bits].reshape(len(rows), dims, bits)
    return each @ (1 << np.arange(bits - 1, -1, -1)).astype(np.int64)


def approximate(stored: DataFrame, borders: np.ndarray, bits: int) -> DataFrame:
    """(key, cells): the approximation file; borders[d] cuts dimension d into 2^bits cells."""
    dims = len(borders)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1), dims)
            cells = np.stack([np.searchsorted(borders[d], x[:, d], side="right") for d in range(dims)], axis=1)
            packed = pack(cells, bits) if len(x) else np.empty((0, 1), np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in packed], pa.binary())],
                                             names=["key", "cells"])

    return stored.select("key", "x").mapInArrow(cut, "key long, cells binary")


def lookup_tables(centroids: np.ndarray, borders: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest), both (dimension, cell, centroid): what a dimension adds to distance minus that from a
    common point. That is linear in the component, so a cell's two ends bound it."""
    point = centroids.mean(0).astype(np.int64)
    first = np.concatenate([low[:, None], borders], axis=1)
    last = np.maximum(np.concatenate([borders - 1, high[:, None]], axis=1), first)
    ends = [(z[:, :, None] - centroids.T[:, None, :]) ** 2 - ((z - point[:, None]) ** 2)[:, :, None] for z in (first, last)]
    return np.minimum(*ends), np.maximum(*ends)


def certain(cells: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
    """Per vector the centroid that is nearest whatever the vector is within its cells, or -1 where intervals overlap."""
    lower = np.zeros((len(cells), least.shape[2]), np.int64)
    upper = lower.copy()
    for d in range(cells.shape[1]):
        lower += least[d][cells[:, d]]
        upper += greatest[d][cells[:, d]]
    open_ = lower <= upper.min(1, keepdims=True)
    return np.where(open_.sum(1) == 1, open_.argmax(1), -1)


def undecided(cells: DataFrame, before: np.ndarray, after: np.ndarray, shape: tuple, bits: int) -> DataFrame:
    """(key): the vectors whose assignment may differ between two sets of centroids."""
    dims = len(shape[0])
    tables = [lookup_tables(c, *shape) for c in (before, after)]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rows = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                at = unpack(rows, dims, bits)
                old, new = (certain(at, *t) for t in tables)
                fetch = np.flatnonzero((old < 0) | (old != new))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(fetch))], names=["key"])

    return cells.select("key", "cells").mapInArrow(look, "key long")


def moves(x_rows: DataFrame, before: np.ndarray | None, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, sums) to add per centroid when the rows of `x_rows` (x) go from their old centroid to their new."""
    k, dims = after.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for b in batches:
            x = matrix(b.column(0), dims)
            x = np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1)
            new = nearest(x[:, 1:], after)[0]
            if before is not None:
                old = nearest(x[:, 1:], before)[0]
                moved = old != new
                np.subtract.at(total, old[moved], x[moved])
                x, new = x[moved], new[moved]
            np.add.at(total, new, x)
        c, d = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array(total[c, d])],
                                         names=["c", "d", "v"])

    got = x_rows.select("x").mapInArrow(add, "c int, d int, v long").groupBy("c", "d").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((k, dims + 1), np.int64)
    for r in got:  # at most k * (dims + 1) rows
        total[r["c"], r["d"]] = r["v"]
    return total[:, 0], total[:, 1:]


def cluster(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = 64, k: int = 8,
            rounds: int = 10, scale: int = 1024, seed: str = "3", bits: int = BITS) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, of another length, or hold a null or non-finite component are left out. Every row is a
    vector of its own, rows that repeat an id or a vector included; a null id is read as the text `null` when the
    first centroids are drawn, and equal digests go by the vector. Fewer than k vectors make as many centroids, none
    make an empty result. A component whose squared distances would not fit 64 bits fails the job. Only the
    named columns are read.
    """
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, vec_id, embedding, dims, scale)
    schema = T.StructType([T.StructField("vec_id", kept.schema["vec_id"].dataType), T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])
    # Equal rows of one partition share a key: they are fetched together, and one partition bounds their number.
    keyed = kept.select(F.xxhash64("vec_id", "x", F.spark_partition_id()).alias("key"), "vec_id", "x")
    n = kept.count()
    buckets = buckets_for(n, ROWS_PER_BUCKET, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stored = write_bucketed(keyed, scratch_path(spark, "llm-vectors"), "key", buckets)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = stored.select(drawn.alias("draw"), "x").orderBy("draw", "x").limit(k).collect()
    if not first:
        return _named(spark.createDataFrame([], schema), np.empty((0, dims), np.int64))
    ends = stored.agg(*[f("x", d) for d in range(dims) for f in (_least, _greatest)]).first()
    low, high = np.array(ends[::2], np.int64), np.array(ends[1::2], np.int64)
    some = np.array([r[0] for r in stored.orderBy("key").limit(SAMPLE).select("x").collect()], np.int64)
    cut = np.sort(some, axis=0)[(np.arange(1, 1 << bits) * len(some)) >> bits]
    shape = (np.ascontiguousarray(cut.T), low, high)
    cells = materialize(approximate(stored, shape[0], bits), "cells")

    before, now = None, np.array([r["x"] for r in first], np.int64)
    counts, sums = moves(stored, None, now)
    for done in range(1, rounds + 1):
        before, now = now, np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], now)
        if done == rounds or np.array_equal(before, now):  # centroids that stand still stay so
            break
        fetched = stored.join(undecided(cells, before, now, shape, bits), "key", "left_semi")
        more, moved = moves(fetched, before, now)
        counts, sums = counts + more, sums + moved
    last = now

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, d = nearest(matrix(b.column(1), dims), last)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(a, pa.int32()), pa.array(d)], names=schema.names)

    return _named(materialize(stored.select("vec_id", "x").mapInArrow(assign, schema), "assigned"), last)


def _least(x: str, d: int):
    return F.min(F.col(x)[d]).alias(f"l{d}")


def _greatest(x: str, d: int):
    return F.max(F.col(x)[d]).alias(f"g{d}")


def _named(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The assignment with its clusters' inertia and the digest of their centroids (one row a centroid, broadcast)."""
    spark = assigned.sparkSession
    sums = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    rows = [(i, sums.get(i, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
            for i, c in enumerate(centroids)]
    names = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(names), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
