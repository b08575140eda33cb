"""Batch jobs: calls -> blobs, blobs -> a standard's tables, checkpoint last (SNK-1/2/5/6/8).

A job is one batch of the same code the streaming writer runs per micro-batch, so batch and stream
results agree by construction.
"""

from __future__ import annotations

from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.operators.kv import unknown_accounts
from blocklake.operators.routing import by_suffix, to_blobs
from blocklake.plans.latest_table import LatestTable
from blocklake.plans.store import Store
from blocklake.sources.blocks import flatten_blocks, read_blocks
from blocklake.sources.validate import validate_rows
from blocklake.streaming.registry import STANDARDS, Cache, Standard


# The checkpoint row that keeps where a store began (no standard can have this name).
START_SUFFIX = "*start"


def _batch_height(df: DataFrame, upper_bound: int | None) -> int | None:
    """D21: the newest height a batch is known to cover: its rows' and the bound it has read up to.

    `df` is a stored table, so this reads one column of it.
    """
    return max((h for h in (df.agg(F.max("block_height")).first()[0], upper_bound) if h is not None), default=None)


def ingest_calls(store: Store, calls: DataFrame, batch_id: int, upper_bound: int | None = None) -> None:
    """Raw stage: route tagged calls into `blobs`, then move the universal checkpoint.

    A row with a missing id or a negative number fails the batch before anything is committed. The height comes
    from the stored delta, so the batch is neither computed twice nor held in memory.
    """
    # SNK-3 expiry counts from write time, so the raw stage stamps it; whole days are dropped later.
    now = F.current_timestamp()
    blobs = validate_rows(to_blobs(calls))[0].withColumn("ingest_ts_us", F.unix_micros(now)).withColumn(
        "ingest_day", F.date_format(now, "yyyy-MM-dd"))
    store.write_delta("blobs", blobs, batch_id)
    h = _batch_height(store.delta("blobs", batch_id), upper_bound)
    if h is not None:
        store.write_meta(S.UNIVERSAL_SUFFIX, h)


LATEST = "latest"
TABLES_BESIDE = 4  # of a batch, written while those that others derive from are made


def new_block_files(store: Store, path: str) -> DataFrame:
    """(path): files below `path` that the raw stage has not read yet, by a listing that opens none of them."""
    files = store.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return files.join(store.ingested_files().select("path"), "path", "left_anti")


def ingest_files(store: Store, path: str, batch_id: int, fmt: str = "json", start: int | str | None = None,
                 args_encoding: str = "base64") -> list[str]:
    """Raw stage over a folder of block files: read what has not been read yet, whatever its heights (STR-1, STR-8).

    The ledger of read files decides, so a file of older blocks that arrives late is still ingested. `start` holds for the
    first run alone: a height, or `latest` (also where it is None), which takes from each later run what is newer than
    the newest block found at the first. That height is kept with the checkpoint. A crash before the ledger is
    written reads the files again; the blobs are unique on their key. Returns the files read.
    """
    files = new_block_files(store, path)
    paths = [r[0] for r in files.collect()]  # one name a new file: what a reader's own listing holds
    if not paths:
        return []
    blocks = read_blocks(store.spark, paths, fmt)
    first = store.checkpoint_height(START_SUFFIX)
    if first is None:
        if start is None or start == LATEST:
            newest = blocks.agg(F.max("block.header.height")).first()[0]
            first = newest if newest is not None else 0
        else:
            first = int(start)
        store.write_meta(START_SUFFIX, first)
    kept = blocks.where(F.col("block.header.height") >= first)
    ingest_calls(store, flatten_blocks(kept, args_encoding), batch_id)
    store.mark_ingested(files, batch_id)
    return sorted(paths)


def index_standard(store: Store, blobs: DataFrame, batch_id: int, standard: Standard | str,
                   upper_bound: int | None = None) -> dict[str, DataFrame]:
    """Derived stage: one standard's tables from its blobs, written as deltas; checkpoint after data.

    Tables that others derive from are written first, and read back as this batch's delta. Tables begun on the way are
    written beside them; all have ended when this returns or fails, so a retried batch never meets an earlier try.
    """
    std = STANDARDS[standard] if isinstance(standard, str) else standard
    mine = by_suffix(blobs, std.suffix)

    def write(name: str, df: DataFrame) -> DataFrame:
        store.write_delta(name, df, batch_id)
        return store.delta(name, batch_id).drop("bucket", "batch_id")

    begun: list[Future] = []
    with ThreadPoolExecutor(max_workers=TABLES_BESIDE) as pool:
        cache = Cache(write, lambda name, df: begun.append(pool.submit(store.write_delta, name, df, batch_id)))
        try:
            tables = std.run(mine, cache, upper_bound)
            if "kv_accounts" in tables and store.exists("kv_accounts"):
                # A set that only grows: what is stored already, a replayed batch's own rows included, is not written again.
                tables["kv_accounts"] = unknown_accounts(tables["kv_accounts"], store.raw("kv_accounts"))
            store.write_tables({n: df for n, df in tables.items() if n not in cache.written}, batch_id)
            for f in begun:
                f.result()
        finally:
            pool.shutdown()
            cache.release()
    h = _batch_height(mine, upper_bound)
    if h is not None:
        store.write_meta(std.suffix, h)
    return tables


def merge_standard(store: Store, blobs: DataFrame, standard: Standard | str,
                   upper_bound: int | None = None) -> dict[str, list[int]]:
    """Derived stage onto tables kept merged (SNK-7): per table, the buckets this batch has rewritten."""
    std = STANDARDS[standard] if isinstance(standard, str) else standard
    cache = Cache()
    try:
        tables = std.run(by_suffix(blobs, std.suffix), cache, upper_bound)
        return {name: LatestTable(store.spark, f"{store.root}/merged", name).upsert(df) for name, df in tables.items()}
    finally:
        cache.release()


def index_pending(store: Store, batch_id: int, standard: Standard | str) -> list[int]:
    """Index every stored blobs delta that `standard` has not indexed yet; returns their ids.

    Work is chosen by delta, not by height, so blocks that were ingested late are indexed too. The raw head is
    read first: all blobs up to it are in the listed deltas, so a standard without calls moves there as well.
    """
    std = STANDARDS[standard] if isinstance(standard, str) else standard
    head = store.checkpoint_height(S.UNIVERSAL_SUFFIX)
    todo = store.pending_deltas(std.suffix)
    if todo:
        index_standard(store, store.blobs_feed(todo), batch_id, std, upper_bound=head)
        store.mark_indexed(std.suffix, todo)
    elif head is not None:
        store.write_meta(std.suffix, head)
    return todo
