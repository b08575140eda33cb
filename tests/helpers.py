"""Literal inputs for semantic tests."""

from pyspark.sql import functions as F

from blocklake import schemas as S

BASE = dict(receipt_id="r", action_index=0, tx_hash=None, signer_id="s.near", predecessor_id="alice.near",
            current_account_id="app.near", block_height=100, block_timestamp=100_000, shard_id=0, receipt_index=0)


def blobs(spark, rows, suffix="kv"):
    """Blob rows from dicts: provenance defaults from BASE, `data` given as text or bytes."""
    out = []
    for r in rows:
        d = {**BASE, **r}
        data = d.pop("data")
        if isinstance(data, str):
            data = data.encode("utf-8")
        out.append((d["receipt_id"], d["action_index"], d.get("suffix", suffix),
                    d["block_height"] // S.BLOCK_HEIGHT_BUCKET_SIZE, bytearray(data), d["tx_hash"], d["signer_id"],
                    d["predecessor_id"], d["current_account_id"], d["block_height"], d["block_timestamp"],
                    d["shard_id"], d["receipt_index"]))
    return spark.createDataFrame(out, S.BLOBS_SCHEMA)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def lit_bytes(b: bytes):
    return F.unhex(F.lit(b.hex()))
