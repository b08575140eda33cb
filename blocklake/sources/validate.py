"""SRC-8: row validation on read. Stored ints must be non-negative and ids present; a bad row either
fails the job (the reference's behaviour) or is split off with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NON_NEGATIVE = ["action_index", "block_height", "block_timestamp", "shard_id", "receipt_index", "order_id",
                "block_height_bucket", "offset", "full_size", "nonce"]
REQUIRED = ["receipt_id", "signer_id", "predecessor_id", "current_account_id", "action_index", "block_height",
            "block_timestamp", "shard_id", "receipt_index"]


def row_problem(df: DataFrame):
    """Column: the first problem of a row (null when the row is valid)."""
    checks = [(F.col(c) < 0, f"negative_{c}") for c in NON_NEGATIVE if c in df.columns]
    checks += [(F.col(c).isNull(), f"missing_{c}") for c in REQUIRED if c in df.columns]
    expr = None
    for cond, reason in checks:
        expr = F.when(cond, reason) if expr is None else expr.when(cond, reason)
    return expr if expr is not None else F.lit(None).cast("string")


def validate_rows(df: DataFrame, on_error: str = "fail") -> tuple[DataFrame, DataFrame | None]:
    """("fail") -> (rows, None), raising inside the job on the first bad row;
    ("reject") -> (good rows, bad rows with a `reason` column)."""
    p = row_problem(df)
    if on_error == "fail":
        return df.where(F.when(p.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("invalid row: "), p)))
                        .cast("boolean")), None
    if on_error == "reject":
        tagged = df.withColumn("reason", p)
        return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())
    raise ValueError(f"on_error must be 'fail' or 'reject', not {on_error!r}")
