"""Structured Streaming (STR-1..9): tail the blobs table per standard, write deltas in foreachBatch.

* Start position: the query's checkpointLocation on restart; `start_height` filters the first run (STR-1).
* With a raw store given, the derived stream never passes the raw stage's checkpoint (STR-2): later blobs are held
  for the next micro-batch. A block stays inside one file, so a micro-batch never splits one (STR-3).
* `max_files_per_trigger` bounds a micro-batch (STR-4); the trigger sets the cadence (STR-5).
* Latest-per-key state lives in the tables themselves: each micro-batch writes its pre-aggregated
  delta under its own batch_id (idempotent on retry) and reads merge deltas by version, so replays and
  late, reordered files give the batch result (STR-6/7/8); no watermark, nothing is ever dropped. The same two in
  Spark's state store: `start_latest_stream` (changed keys only) and `start_history_stream` (deduplicated).
* A failed micro-batch is retried by Spark from the same offsets and never moves the checkpoint (STR-9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blocklake import schemas as S
from blocklake.operators import kv as K
from blocklake.operators.latest import latest_by
from blocklake.plans.jobs import index_standard, ingest_calls
from blocklake.sources.blocks import flatten_blocks, read_blocks
from blocklake.plans.latest_table import LatestTable
from blocklake.plans.store import Store
from blocklake.sources.validate import validate_rows
from blocklake.streaming.registry import STANDARDS, Standard


def read_blob_stream(spark: SparkSession, path: str, suffix: str | None = None,
                     start_height: int | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(S.BLOBS_SCHEMA).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(path)
    if suffix is not None:
        df = df.where(F.col("suffix") == suffix)
    if start_height is not None:
        df = df.where(F.col("block_height") >= start_height)
    return df


def standard_writer(store: Store, standard: Standard | str, first_delta_id: int = 0, raw: Store | None = None):
    """foreachBatch function writing one standard's deltas (same code as the batch job).

    Delta id = the writer's first id + the micro-batch id, so a retried micro-batch replaces its own
    delta and two writers never share one. With a `raw` store a micro-batch takes blobs up to the raw stage's
    checkpoint alone (STR-2); the rest, which the raw stage may still be writing, is held for the next one. All
    blobs up to that height have been seen then, so the standard's checkpoint moves there, with or without calls.
    """
    std = STANDARDS[standard] if isinstance(standard, str) else standard

    def write(batch: DataFrame, batch_id: int) -> None:
        delta = first_delta_id + batch_id
        if raw is None:
            index_standard(store, validate_rows(batch)[0], delta, std)
            return
        head = raw.checkpoint_height(S.UNIVERSAL_SUFFIX)
        rows = batch.select(*S.BLOBS_SCHEMA.names).unionByName(store.held_blobs(std.suffix, first_delta_id, delta))
        committed = F.col("block_height") <= F.lit(-1 if head is None else head)
        store.hold_blobs(std.suffix, delta, rows.where(~committed))
        index_standard(store, validate_rows(rows.where(committed))[0], delta, std, upper_bound=head)

    return write


def start_standard_stream(spark: SparkSession, blobs_path: str, store: Store, standard: Standard | str,
                          checkpoint_location: str,
                          available_now: bool = False, processing_time: str = "5 seconds",
                          max_files_per_trigger: int | None = None,
                          start_height: int | None = None, raw: Store | None = None) -> StreamingQuery:
    std = STANDARDS[standard] if isinstance(standard, str) else standard
    src = read_blob_stream(spark, blobs_path, std.suffix, start_height, max_files_per_trigger)
    first = store.allocate_writer(checkpoint_location)
    w = src.writeStream.foreachBatch(standard_writer(store, std, first, raw)).option("checkpointLocation",
                                                                                       checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.queryName(f"index_{std.suffix}").start()


def start_latest_stream(spark: SparkSession, blobs_path: str, table: LatestTable, checkpoint_location: str,
                        available_now: bool = False, processing_time: str = "5 seconds",
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """STR-6: the newest value per key kept in Spark's state store, changed keys merged into `table`.

    A streaming argmax in update mode: a micro-batch emits the keys whose newest row it changed or confirmed, one
    row each. State is one row a key, as the table itself; on a cluster it belongs in RocksDB (see README). The state
    decides whatever the files' order, and the merge is idempotent, so replays change nothing.
    """
    rows = K.explode_kv(read_blob_stream(spark, blobs_path, S.KV_SUFFIX, None, max_files_per_trigger))
    newest = latest_by(rows.select(*K.KV_COLS), K.KV_LAST_KEY, K.KV_VERSION)
    w = newest.writeStream.outputMode("update").foreachBatch(lambda batch, _: table.upsert(batch)).option(
        "checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.queryName(f"latest_{table.name}").start()


ARRIVAL = "_arrived"


def start_history_stream(spark: SparkSession, blobs_path: str, path: str, checkpoint_location: str,
                         remember: str = "7 days", available_now: bool = False, processing_time: str = "5 seconds",
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """STR-7: `s_kv` as an append-only stream, deduplicated on its primary key by the state store.

    Rule for bounded state: a key is remembered for `remember` after its file arrived. Event time is the file's
    modification time, which a late or replayed file has anew, so no row is ever too late; a replay within the time adds
    no row, a later one adds rows that reading the history by its key removes.
    """
    src = spark.readStream.schema(S.BLOBS_SCHEMA).format("parquet")
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", max_files_per_trigger)
    blobs = src.load(blobs_path).select("*", F.col("_metadata.file_modification_time").alias(ARRIVAL))
    rows = K.explode_kv(blobs.where(F.col("suffix") == S.KV_SUFFIX), keep=(ARRIVAL,))
    fresh = rows.withWatermark(ARRIVAL, remember).dropDuplicatesWithinWatermark(K.KV_HISTORY_KEY).drop(ARRIVAL)
    w = fresh.writeStream.outputMode("append").format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.queryName("history").start()


def start_ingest_stream(spark: SparkSession, blocks_path: str, store: Store, checkpoint_location: str,
                        fmt: str = "json", available_now: bool = False, processing_time: str = "5 seconds",
                        max_files_per_trigger: int | None = None, start_height: int | None = None,
                        args_encoding: str = "base64") -> StreamingQuery:
    """Raw stage as a stream: block files -> flattened calls -> `blobs` deltas + universal checkpoint."""
    blocks = read_blocks(spark, blocks_path, fmt, start_height, streaming=True,
                         max_files_per_trigger=max_files_per_trigger)
    calls = flatten_blocks(blocks, args_encoding)
    first = store.allocate_writer(checkpoint_location)

    def write(batch: DataFrame, batch_id: int) -> None:
        ingest_calls(store, batch, first + batch_id)

    w = calls.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.queryName("ingest_blocks").start()
