"""Reports: rejects with reasons (RPT-1), throughput per hour (RPT-2), checkpoint lag (Q-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOUR_NS = 3_600_000_000_000


def reject_summary(rejects: DataFrame) -> DataFrame:
    """RPT-1: count of rejected records per (stage, reason)."""
    return rejects.groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("n"))


def throughput(calls: DataFrame, window_ns: int = HOUR_NS) -> DataFrame:
    """RPT-2: blocks and calls per block-time window (window start kept as ns, time-zone free).

    Counting distinct heights per window is a two-level aggregation (per (window, height), then per
    window), so no window's height set is ever held whole in one task.
    """
    w = F.expr(f"block_timestamp div {window_ns}") * F.lit(window_ns)
    per_block = calls.groupBy(w.alias("window_start_ns"), "block_height").agg(F.count(F.lit(1)).alias("c"))
    return per_block.groupBy("window_start_ns").agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum("c").alias("n_calls"))


def checkpoint_lag(meta: DataFrame, head_suffix: str = "*") -> DataFrame:
    """Q-14: per standard, its checkpoint against the raw stage's (the head) and the lag in blocks.

    `meta` holds one row per standard, so the window over it is a bounded single-partition step.
    """
    head = F.max(F.when(F.col("suffix") == head_suffix, F.col("last_processed_block_height"))).over(
        Window.partitionBy())
    m = meta.withColumn("head_height", head)
    return m.where(F.col("suffix") != head_suffix).select(
        "suffix", "last_processed_block_height", "head_height",
        (F.col("head_height") - F.col("last_processed_block_height")).alias("lag_blocks"))


def stalls(readings: DataFrame, head_suffix: str = "*") -> DataFrame:
    """Q-14 stall check: per standard, its checkpoint at the newest reading against the reading before.

    `readings` holds (reading_ts_us, suffix, last_processed_block_height), one row per standard per reading.
    `stalled` is true when the checkpoint did not move between the last two readings although it is behind
    the head: a standard that has read everything is idle, not stalled. The two greatest readings come from
    aggregates, so a long log of readings is never sorted in one task.
    """
    at = F.struct("reading_ts_us", "last_processed_block_height")
    newest = readings.groupBy("suffix").agg(F.max(at).alias("new"))
    before = readings.join(newest, "suffix").where(F.col("reading_ts_us") < F.col("new.reading_ts_us")).groupBy(
        "suffix").agg(F.max(at).alias("old"))
    # One row per standard, so the window over all of them is bounded.
    head = F.max(F.when(F.col("suffix") == head_suffix, F.col("new.last_processed_block_height"))).over(Window.partitionBy())
    x = newest.withColumn("head", head).join(before, "suffix", "left")
    height, previous = F.col("new.last_processed_block_height"), F.col("old.last_processed_block_height")
    return x.select("suffix", F.col("new.reading_ts_us").alias("reading_ts_us"),
                    height.alias("last_processed_block_height"), previous.alias("previous_height"),
                    F.coalesce((previous == height) & (height < F.col("head")), F.lit(False)).alias("stalled"))
