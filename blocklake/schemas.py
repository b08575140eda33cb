"""Explicit schemas and the table catalog.

Every table is declared here once; nothing is inferred at read time. The catalog records, per table,
the key a row is unique on, the columns that decide which version of a key wins, and the physical
layout used when the table is written (directory partitions and sort order).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Fixed values of the data model (they must equal the reference's for identical results).
CALL_PREFIX = "__fastdata_"
UNIVERSAL_SUFFIX = "*"
KV_SUFFIX = "kv"
FILES_SUFFIX = "fastfs"
RAW_SUFFIX = "raw"
FILE_CHUNKS_TABLE = "s_fastfs_v2"
BLOCK_HEIGHT_BUCKET_SIZE = 10_000
MAX_BUCKET_SPAN = 1_000
MAX_NUM_KEYS = 256
MAX_KEY_BYTES = 1024
MAX_RECEIPT_INDEX = 100_000
MAX_ACTION_INDEX = 1_000
LWW_HEIGHT_FACTOR = 1_000_000_000
MAX_RELATIVE_PATH_BYTES = 1024
MAX_MIME_TYPE_BYTES = 256
OFFSET_ALIGNMENT = 1 << 20
MAX_FILE_BYTES = 32 << 20
I32_MAX = 2_147_483_647
BLOBS_TTL_SECONDS = 2_592_000

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BinaryType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Input feed: one row per block, nested shards -> receipt outcomes -> receipt -> actions.
FUNCTION_CALL = _struct(("method_name", S, True), ("args", S, True))
ACTION = _struct(("FunctionCall", FUNCTION_CALL, True))
ACTION_RECEIPT = _struct(("signer_id", S, True), ("actions", T.ArrayType(ACTION, True), True))
RECEIPT = _struct(
    ("receipt_id", S, True),
    ("predecessor_id", S, True),
    ("receiver_id", S, True),
    ("receipt", _struct(("Action", ACTION_RECEIPT, True)), True),
)
OUTCOME = _struct(("tx_hash", S, True), ("receipt", RECEIPT, True))
# Integers are read wide and narrowed by a checked cast, so a value that does not fit fails instead of vanishing.
SHARD = _struct(("shard_id", L, True), ("receipt_execution_outcomes", T.ArrayType(OUTCOME, True), True))
BLOCK_SCHEMA = _struct(
    ("block", _struct(("header", _struct(("height", L, True), ("timestamp", L, True)), True)), True),
    ("shards", T.ArrayType(SHARD, True), True),
)

# The ten provenance columns shared by every derived row.
PROVENANCE = [
    ("receipt_id", S, False),
    ("action_index", I, False),
    ("tx_hash", S, True),
    ("signer_id", S, False),
    ("predecessor_id", S, False),
    ("current_account_id", S, False),
    ("block_height", L, False),
    ("block_timestamp", L, False),
    ("shard_id", I, False),
    ("receipt_index", I, False),
]
PROVENANCE_COLS = [n for n, _, _ in PROVENANCE]

# Flat function calls (flatten output, before suffix routing).
CALLS_SCHEMA = _struct(*PROVENANCE, ("method_name", S, False), ("args", B, True))

BLOBS_SCHEMA = _struct(
    ("receipt_id", S, False),
    ("action_index", I, False),
    ("suffix", S, False),
    ("block_height_bucket", L, False),
    ("data", B, True),
    ("tx_hash", S, True),
    ("signer_id", S, False),
    ("predecessor_id", S, False),
    ("current_account_id", S, False),
    ("block_height", L, False),
    ("block_timestamp", L, False),
    ("shard_id", I, False),
    ("receipt_index", I, False),
)

S_KV_SCHEMA = _struct(*PROVENANCE, ("order_id", L, False), ("key", S, False), ("value", S, False))

RAW_SCHEMA = _struct(*PROVENANCE, ("data", S, True))

KV_EDGES_SCHEMA = _struct(
    ("edge_type", S, False),
    ("target", S, False),
    ("source", S, False),
    ("current_account_id", S, False),
    ("block_height", L, False),
    ("block_timestamp", L, False),
    ("order_id", L, False),
    ("value", S, False),
)

FILE_CHUNKS_SCHEMA = _struct(
    *PROVENANCE,
    ("mime_type", S, True),
    ("relative_path", S, False),
    ("content", B, True),
    ("offset", I, False),
    ("full_size", I, False),
    ("nonce", I, False),
)

# Blobs deltas each standard has indexed.
INDEXED_SCHEMA = _struct(("suffix", S, False), ("batch_id", L, False))

# Source files the raw stage has read.
INGESTED_SCHEMA = _struct(("path", S, False), ("batch_id", L, False))

META_SCHEMA = _struct(("suffix", S, False), ("last_processed_block_height", L, False))


READINGS_SCHEMA = _struct(*[(f.name, f.dataType, f.nullable) for f in META_SCHEMA.fields], ("reading_ts_us", L, False))


def _of(schema: T.StructType, *first: str, only: tuple[str, ...] = ()) -> T.StructType:
    """`schema` with some columns in front, or only some of its columns."""
    names = only or (*first, *[n for n in schema.names if n not in first])
    return T.StructType([schema[n] for n in names])


# Derived tables as stored (the views of a user drop the state columns).
KV_REVERSE_SCHEMA = _of(S_KV_SCHEMA, only=(
    "current_account_id", "key", "predecessor_id", "receipt_id", "action_index", "tx_hash", "signer_id", "block_height",
    "block_timestamp", "shard_id", "receipt_index", "order_id", "value"))
KV_EDGE_STATE_SCHEMA = T.StructType([*KV_EDGES_SCHEMA.fields, T.StructField("is_deletion", T.BooleanType(), False)])
TABLE_SCHEMAS: dict[str, T.StructType] = {
    "s_kv": S_KV_SCHEMA,
    "s_kv_last": S_KV_SCHEMA,
    "mv_kv_key": _of(S_KV_SCHEMA, "key", "block_height", "order_id", "predecessor_id", "current_account_id"),
    "mv_kv_cur_key": _of(S_KV_SCHEMA, "current_account_id", "key", "block_height", "order_id", "predecessor_id"),
    "kv_reverse": KV_REVERSE_SCHEMA,
    "kv_accounts": _of(S_KV_SCHEMA, only=("current_account_id", "key", "predecessor_id")),
    "kv_edges": KV_EDGE_STATE_SCHEMA,
    "all_accounts": _of(S_KV_SCHEMA, only=("predecessor_id", "block_height", "block_timestamp", "order_id")),
    "s_kv_by_block": _of(S_KV_SCHEMA, only=("predecessor_id", "current_account_id", "block_height", "key", "value",
                                            "block_timestamp", "order_id", "receipt_id", "tx_hash")),
    FILE_CHUNKS_TABLE: FILE_CHUNKS_SCHEMA,
    "s_block_calls": _struct(("block_height", L, False), ("n_calls", L, False)),
}


@dataclass(frozen=True)
class TableSpec:
    """Physical and logical description of one stored table."""

    name: str
    key: tuple[str, ...]
    # Columns whose struct ordering picks the winning row per key; empty = append-only history.
    version: tuple[str, ...] = ()
    # Directory partition columns (low cardinality only: suffix, time bucket, batch).
    partition_by: tuple[str, ...] = ("batch_id",)
    # Lookup columns whose hash is the table's `bucket` directory.
    bucket_by: tuple[str, ...] = ()
    # Sort order inside each file: row-group min/max then prune point lookups.
    sort_by: tuple[str, ...] = ()
    descending: frozenset[str] = field(default_factory=frozenset)
    # Every delta is already unique on `key` (written from an argmax or dedup of its batch).
    unique_per_delta: bool = True


CATALOG: dict[str, TableSpec] = {
    t.name: t
    for t in [
        TableSpec(
            "blobs",
            key=("suffix", "block_height_bucket", "block_height", "shard_id", "receipt_index", "action_index",
                 "receipt_id"),
            # A blob written again lives by its newest ingest.
            version=("ingest_ts_us",),
            partition_by=("ingest_day", "suffix", "block_height_bucket", "batch_id"),
            sort_by=("block_height", "shard_id", "receipt_index", "action_index", "receipt_id"),
            unique_per_delta=False,
        ),
        TableSpec("meta", key=("suffix",)),
        TableSpec(
            "s_kv",
            key=("predecessor_id", "current_account_id", "key", "block_height", "order_id"),
            bucket_by=("predecessor_id", "current_account_id"),
            sort_by=("predecessor_id", "current_account_id", "key", "block_height", "order_id"),
        ),
        TableSpec(
            "mv_kv_key",
            key=("key", "block_height", "order_id", "predecessor_id", "current_account_id"),
            bucket_by=("key",),
            sort_by=("key", "block_height", "order_id", "predecessor_id", "current_account_id"),
        ),
        TableSpec(
            "mv_kv_cur_key",
            key=("current_account_id", "key", "block_height", "order_id", "predecessor_id"),
            bucket_by=("current_account_id",),
            sort_by=("current_account_id", "key", "block_height", "order_id", "predecessor_id"),
        ),
        TableSpec(
            "s_kv_last",
            key=("predecessor_id", "current_account_id", "key"),
            version=("block_height", "order_id"),
            bucket_by=("predecessor_id", "current_account_id"),
            sort_by=("predecessor_id", "current_account_id", "key"),
        ),
        TableSpec(
            "kv_reverse",
            key=("current_account_id", "key", "predecessor_id"),
            version=("block_height", "order_id"),
            bucket_by=("current_account_id", "key"),
            sort_by=("current_account_id", "key", "predecessor_id"),
        ),
        TableSpec(
            "kv_accounts",
            key=("current_account_id", "key", "predecessor_id"),
            bucket_by=("current_account_id",),
            sort_by=("current_account_id", "key", "predecessor_id"),
        ),
        TableSpec(
            "kv_edges",
            key=("edge_type", "target", "source"),
            # Deletion beats insert on an equal version, then the greater value, then the greater contract.
            version=("block_height", "order_id", "is_deletion", "value", "current_account_id"),
            bucket_by=("edge_type", "target"),
            sort_by=("edge_type", "target", "source"),
        ),
        TableSpec(
            "all_accounts",
            key=("predecessor_id",),
            version=("block_height", "order_id"),
            bucket_by=("predecessor_id",),
            sort_by=("predecessor_id",),
        ),
        TableSpec(
            "s_kv_by_block",
            key=("predecessor_id", "current_account_id", "block_height", "key"),
            version=("order_id",),
            bucket_by=("predecessor_id", "current_account_id"),
            sort_by=("predecessor_id", "current_account_id", "block_height", "key"),
            descending=frozenset({"block_height"}),
        ),
        # Calls of a standard per complete block; a block that was read again with more calls wins.
        TableSpec("s_block_calls", key=("block_height",), version=("n_calls",), bucket_by=("block_height",),
                  sort_by=("block_height",)),
        TableSpec(
            FILE_CHUNKS_TABLE,
            key=("predecessor_id", "current_account_id", "relative_path", "nonce", "offset"),
            version=("block_height", "shard_id", "receipt_index", "action_index"),
            bucket_by=("predecessor_id", "current_account_id"),
            sort_by=("predecessor_id", "current_account_id", "relative_path", "nonce", "offset"),
        ),
    ]
}
