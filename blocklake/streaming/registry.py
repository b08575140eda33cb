"""EXT-1: data standards. A standard = a suffix, a transform from its blobs to named tables, and the
catalog entries of those tables. The same transform runs in batch jobs and in streaming foreachBatch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake import schemas as S
from blocklake.operators import files as FS
from blocklake.operators import kv as K


class Cache:
    """Intermediates a transform reuses across several tables; released once the batch is written.

    A table that others derive from is written first, where a store is at hand, and read back from there: the batch is
    computed once, no executor holds it, and a lost one costs a reading of files. Other intermediates are persisted.
    """

    def __init__(self, write: Callable[[str, DataFrame], DataFrame] | None = None,
                 start: Callable[[str, DataFrame], None] | None = None):
        self.items: list[DataFrame] = []
        self.write = write
        self.start = start
        self.written: set[str] = set()

    def __call__(self, df: DataFrame) -> DataFrame:
        df = df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        self.items.append(df)
        return df

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Table `name` of the batch, to derive further tables from."""
        if self.write is None:
            return self(df)
        self.written.add(name)
        return self.write(name, df)

    def begin(self, name: str, df: DataFrame) -> None:
        """Table `name` of the batch, which no other derives from: where a store is at hand it is written from now on,
        while the transform goes on."""
        if self.start is not None:
            self.written.add(name)
            self.start(name, df)

    def release(self) -> None:
        for df in self.items:
            df.unpersist()
        self.items.clear()


# (blobs, cache), or (blobs, cache, ends) for a standard that asks for block ends, to its tables by name.
Transform = Callable[..., dict[str, DataFrame]]


@dataclass(frozen=True)
class Standard:
    suffix: str
    transform: Transform
    tables: tuple[str, ...]
    # Whether the transform is handed the ends of blocks beside the rows.
    ends: bool = False

    def run(self, blobs: DataFrame, cache: Cache, upper_bound: int | None = None) -> dict[str, DataFrame]:
        """The standard's tables of one batch of its blobs, read up to `upper_bound`."""
        if not self.ends:
            return self.transform(blobs, cache)
        return self.transform(blobs, cache, block_ends(blobs, upper_bound))


STANDARDS: dict[str, Standard] = {}


def block_ends(blobs: DataFrame, upper_bound: int | None = None) -> DataFrame:
    """(block_height): the blocks a batch completes (STR-3): each block of its rows, and the bound it has read up to.

    A block is never split over batches, so all its rows are there; the bound has none where it held no call.
    """
    ends = blobs.select("block_height")
    if upper_bound is not None:
        ends = ends.unionByName(blobs.sparkSession.range(1).select(F.lit(upper_bound).cast("long").alias("block_height")))
    return ends.distinct()


def register_standard(suffix: str, transform: Transform, tables: dict[str, S.TableSpec] | None = None,
                      schemas: dict[str, T.StructType] | None = None, ends: bool = False) -> Standard:
    """Register a standard; `tables` adds catalog entries for tables the transform emits, `schemas` their columns.

    With `ends` the transform is called with a third argument, the block ends of the batch.
    """
    S.CATALOG.update(tables or {})
    S.TABLE_SCHEMAS.update(schemas or {})
    std = Standard(suffix, transform, tuple((tables or {}).keys()), ends)
    STANDARDS[suffix] = std
    return std


def _kv_tables(blobs: DataFrame, cache: Cache) -> dict[str, DataFrame]:
    return K.derive_kv_tables(K.explode_kv(blobs), cache)


def _file_tables(blobs: DataFrame, cache: Cache, alignment: int = S.OFFSET_ALIGNMENT) -> dict[str, DataFrame]:
    return {S.FILE_CHUNKS_TABLE: FS.latest_chunks(FS.decode_files(blobs, alignment))}


def file_standard(alignment: int) -> Transform:
    return lambda blobs, cache: _file_tables(blobs, cache, alignment)


def _raw_tables(blobs: DataFrame, cache: Cache) -> dict[str, DataFrame]:
    """The `raw` standard keeps each call's payload as text, keyed like the blob."""
    return {"s_raw": blobs.select(*S.PROVENANCE_COLS, F.col("data").cast("string").alias("data"))}


register_standard(S.KV_SUFFIX, _kv_tables)
register_standard(S.FILES_SUFFIX, _file_tables)
register_standard(S.RAW_SUFFIX, _raw_tables, {
    "s_raw": S.TableSpec("s_raw", key=("predecessor_id", "current_account_id", "block_height", "shard_id",
                                       "receipt_index", "action_index", "receipt_id"),
                         bucket_by=("predecessor_id", "current_account_id"),
                         sort_by=("predecessor_id", "current_account_id", "block_height"),
                         unique_per_delta=False),
}, {"s_raw": S.RAW_SCHEMA})
