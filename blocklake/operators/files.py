"""File-upload standard (FS-1..FS-9): binary records -> chunk rows -> newest chunk per key -> files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.functions import binary
from blocklake.functions.paths import is_valid_partial, is_valid_simple
from blocklake.operators.routing import reject_rows

FS_KEY = ["predecessor_id", "current_account_id", "relative_path", "nonce", "offset"]
# D15: file rows have no order_id; arrival follows (height, shard, receipt, action).
FS_VERSION = ["block_height", "shard_id", "receipt_index", "action_index"]
FS_COLS = S.PROVENANCE_COLS + ["mime_type", "relative_path", "content", "offset", "full_size", "nonce"]


def classify_uploads(blobs: DataFrame, alignment: int = S.OFFSET_ALIGNMENT,
                     max_bytes: int = S.MAX_FILE_BYTES) -> DataFrame:
    """FS-1 decode plus FS-2..5 validity; adds the `u_*` record columns and `reason` (null = accepted)."""
    d = binary.decode_upload(blobs).withColumn("u_len", F.octet_length("u_content").cast("long"))
    simple_ok = is_valid_simple(F.col("u_path"), F.col("u_has_content"), F.col("u_mime"), F.col("u_len"),
                                max_bytes)
    partial_ok = is_valid_partial(F.col("u_path"), F.col("u_offset"), F.col("u_full"), F.col("u_mime"),
                                  F.col("u_len"), F.col("u_nonce"), alignment, max_bytes)
    reason = (
        F.when(~F.col("u_ok"), "undecodable")
        .when((F.col("u_kind") == 0) & ~simple_ok, "invalid_simple")
        .when((F.col("u_kind") == 1) & ~partial_ok, "invalid_partial")
    )
    return d.withColumn("reason", reason)


def decode_files(blobs: DataFrame, alignment: int = S.OFFSET_ALIGNMENT) -> DataFrame:
    """FS-6/7: accepted records as `s_fastfs_v2` rows (a Simple deletion keeps a row with nulls, D16)."""
    c = classify_uploads(blobs, alignment).where(F.col("reason").isNull())
    deletion = (F.col("u_kind") == 0) & ~F.col("u_has_content")
    return c.select(
        *S.PROVENANCE_COLS,
        F.when(~deletion, F.col("u_mime")).alias("mime_type"),
        F.col("u_path").alias("relative_path"),
        F.when(~deletion, F.col("u_content")).alias("content"),
        F.col("u_offset").cast("int").alias("offset"),
        F.when(deletion, F.lit(0)).otherwise(F.col("u_full")).cast("int").alias("full_size"),
        F.col("u_nonce").cast("int").alias("nonce"),
    )


def file_rejects(blobs: DataFrame, alignment: int = S.OFFSET_ALIGNMENT) -> DataFrame:
    c = classify_uploads(blobs, alignment).where(F.col("reason").isNotNull())
    return reject_rows(c, "files", F.col("reason"), F.col("u_path"))


def latest_chunks(rows: DataFrame) -> DataFrame:
    """FS-8 `s_fastfs_v2`: newest row per (pred, contract, path, nonce, offset); re-upload overwrites.

    Rows carry up to 1 MiB of content, so the newest is the first of a sort and never an aggregate's state. The
    limit of one row per key also holds before the shuffle: a path that is rewritten all the time sends one row
    per task.
    """
    newest = Window.partitionBy(*FS_KEY).orderBy(*[F.col(c).desc() for c in FS_VERSION])
    return rows.select(*FS_COLS, F.row_number().over(newest).alias("_nth")).where("_nth = 1").drop("_nth")


def assemble_files(chunks: DataFrame, alignment: int = S.OFFSET_ALIGNMENT) -> DataFrame:
    """FS-9: one row per upload (pred, contract, path, nonce) with the reassembled bytes.

    A group holds one file, which FS-4 bounds in bytes. Each chunk is zero-padded to the bytes its slot
    covers (D19) before the shuffle, and the slots are joined once, in offset order; `complete` says
    every slot is present. Deletion markers (null content) are not files and are left out.
    """
    live = chunks.where(F.col("content").isNotNull())
    simple = F.col("nonce") == 0
    # A Simple upload is whole; a Partial chunk fills its aligned slot, the tail reading as zeros.
    width = F.least(F.lit(alignment), F.col("full_size") - F.col("offset")).cast("int")
    live = live.withColumn("_slot", F.when(simple, F.col("content")).otherwise(
        F.rpad("content", width, F.unhex(F.lit("00")))))
    g = live.groupBy("predecessor_id", "current_account_id", "relative_path", "nonce").agg(
        F.max("full_size").alias("full_size"),
        F.min("full_size").alias("_min_full"),
        F.count(F.lit(1)).alias("n_chunks"),
        F.expr("listagg(_slot) WITHIN GROUP (ORDER BY offset)").alias("_bytes"),
        F.max("mime_type").alias("mime_type"),
    )
    expected = F.when(simple, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.expr(f"(full_size + {alignment - 1}) div {alignment}")))
    complete = (F.col("n_chunks") == expected) & (F.col("_min_full") == F.col("full_size"))
    return g.select(
        "predecessor_id", "current_account_id", "relative_path", "nonce", "mime_type", "full_size",
        F.col("n_chunks").cast("int").alias("n_chunks"),
        complete.alias("complete"),
        F.when(complete, F.col("_bytes")).alias("content"),
    )
