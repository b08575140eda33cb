"""FLT-2..4 and PRJ-1..3: tagged calls -> raw blobs routed by suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.functions.columns import block_height_bucket, is_valid_suffix, strip_prefix


def _tagged(calls: DataFrame, prefix: str) -> DataFrame:
    return calls.withColumn("suffix", strip_prefix("method_name", prefix)).where(F.col("suffix").isNotNull())


def to_blobs(calls: DataFrame, prefix: str = S.CALL_PREFIX) -> DataFrame:
    """Calls whose method is `prefix + valid suffix`, projected to the BLOBS_SCHEMA columns."""
    t = _tagged(calls, prefix).where(is_valid_suffix("suffix"))
    return t.select(
        "receipt_id", "action_index", "suffix",
        block_height_bucket("block_height").alias("block_height_bucket"),
        F.col("args").alias("data"),
        "tx_hash", "signer_id", "predecessor_id", "current_account_id",
        "block_height", "block_timestamp", "shard_id", "receipt_index",
    )


def suffix_rejects(calls: DataFrame, prefix: str = S.CALL_PREFIX) -> DataFrame:
    """RPT-1 rows for calls that carry the prefix but an invalid suffix (the reference only logs them)."""
    t = _tagged(calls, prefix).where(~is_valid_suffix("suffix"))
    return reject_rows(t, "route", F.lit("invalid_suffix"), F.col("suffix"))


def by_suffix(blobs: DataFrame, suffix: str) -> DataFrame:
    """FLT-4: one standard's blobs. On a stored table this is a directory-partition filter."""
    return blobs.where(F.col("suffix") == F.lit(suffix))


REJECT_COLS = ["stage", "reason", "receipt_id", "action_index", "block_height", "predecessor_id",
               "current_account_id", "detail"]


def reject_rows(df: DataFrame, stage: str | Column, reason: Column, detail: Column) -> DataFrame:
    return df.select(
        (F.lit(stage) if isinstance(stage, str) else stage).alias("stage"), reason.alias("reason"), "receipt_id", "action_index", "block_height",
        "predecessor_id", "current_account_id", detail.cast("string").alias("detail"))
