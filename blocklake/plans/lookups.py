"""User-level lookups (Q-1..Q-16) on the derived tables.

Each is a filter on the table's leading clustering columns (pushed to the Parquet scan, pruned by the
row-group statistics of the sorted deltas) plus, where the reference documents one, an order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklake.plans.store import scan_suffix


def _eq(df: DataFrame, **kv) -> DataFrame:
    cond = F.lit(True)
    for k, v in kv.items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.where(cond)


def get_latest(s_kv_last: DataFrame, predecessor_id: str, current_account_id: str, key: str) -> DataFrame:
    """Q-1: latest value of one key."""
    return _eq(s_kv_last, predecessor_id=predecessor_id, current_account_id=current_account_id, key=key)


def list_keys(s_kv_last: DataFrame, predecessor_id: str, current_account_id: str) -> DataFrame:
    """Q-2: every key (latest value) an account wrote on a contract."""
    return _eq(s_kv_last, predecessor_id=predecessor_id, current_account_id=current_account_id).orderBy("key")


def key_history(s_kv: DataFrame, predecessor_id: str, current_account_id: str, key: str) -> DataFrame:
    """Q-3: all versions of one key, newest first."""
    return _eq(s_kv, predecessor_id=predecessor_id, current_account_id=current_account_id, key=key).orderBy(
        F.col("block_height").desc(), F.col("order_id").desc())


def key_prefix(s_kv_last: DataFrame, predecessor_id: str, current_account_id: str, prefix: str) -> DataFrame:
    """Q-4: keys in [prefix, prefix + 0xff) -- a `StringStartsWith` filter the Parquet scan pushes down."""
    return _eq(s_kv_last, predecessor_id=predecessor_id, current_account_id=current_account_id).where(
        F.col("key").startswith(prefix)).orderBy("key")


def predecessors_page(kv_reverse: DataFrame, current_account_id: str, key: str, cursor: str | None = None,
                      limit: int = 100) -> DataFrame:
    """Q-5: accounts that wrote `key` on a contract, one page after `cursor` (paging is the feature)."""
    df = _eq(kv_reverse, current_account_id=current_account_id, key=key)
    if cursor is not None:
        df = df.where(F.col("predecessor_id") > F.lit(cursor))
    return df.orderBy("predecessor_id").limit(limit)


def followers(kv_edges: DataFrame, edge_type: str, target: str) -> DataFrame:
    """Q-6: sources of live edges of a type into `target`."""
    return _eq(kv_edges, edge_type=edge_type, target=target).select("source")


def contract_accounts(kv_accounts: DataFrame, current_account_id: str) -> DataFrame:
    """Q-7: (key, predecessor) pairs written on a contract."""
    return _eq(kv_accounts, current_account_id=current_account_id).orderBy("key", "predecessor_id")


def timeline(s_kv_by_block: DataFrame, predecessor_id: str, current_account_id: str,
             from_height: int | None = None, to_height: int | None = None) -> DataFrame:
    """Q-8: one account's writes on a contract, newest block first (optional inclusive height range)."""
    df = _eq(s_kv_by_block, predecessor_id=predecessor_id, current_account_id=current_account_id)
    if from_height is not None:
        df = df.where(F.col("block_height") >= from_height)
    if to_height is not None:
        df = df.where(F.col("block_height") <= to_height)
    return df.orderBy(F.col("block_height").desc(), "key")


def key_across_accounts(mv_kv_key: DataFrame, key: str) -> DataFrame:
    """Q-9: history of a key over every account and contract."""
    return _eq(mv_kv_key, key=key).orderBy("block_height", "order_id", "predecessor_id", "current_account_id")


def contract_history(mv_kv_cur_key: DataFrame, current_account_id: str, key: str | None = None) -> DataFrame:
    """Q-10: history of a contract (optionally one key)."""
    df = _eq(mv_kv_cur_key, current_account_id=current_account_id)
    if key is not None:
        df = df.where(F.col("key") == key)
    return df.orderBy("key", "block_height", "order_id", "predecessor_id")


def list_files(chunks: DataFrame, predecessor_id: str, current_account_id: str,
               live_only: bool = False) -> DataFrame:
    """Q-11: paths of an account on a contract (deletion markers count unless `live_only`, D16)."""
    df = _eq(chunks, predecessor_id=predecessor_id, current_account_id=current_account_id)
    if live_only:
        df = df.where(F.col("content").isNotNull() | (F.col("nonce") > 0))
    return df.select("relative_path").distinct()


def file_uploads(chunks: DataFrame, predecessor_id: str, current_account_id: str,
                 relative_path: str) -> DataFrame:
    """Q-12: every upload (nonce) of a path, chunks in offset order."""
    return _eq(chunks, predecessor_id=predecessor_id, current_account_id=current_account_id,
               relative_path=relative_path).orderBy("nonce", "offset")


def upload_chunks(chunks: DataFrame, predecessor_id: str, current_account_id: str, relative_path: str,
                  nonce: int) -> DataFrame:
    """Q-13: chunks of one upload in order."""
    return _eq(chunks, predecessor_id=predecessor_id, current_account_id=current_account_id,
               relative_path=relative_path, nonce=nonce).orderBy("offset")


def account_registry(all_accounts: DataFrame) -> DataFrame:
    """Q-15: accounts by last activity."""
    return all_accounts.orderBy(F.col("last_block_height").desc(), "predecessor_id")


def raw_calls_by_suffix(blobs: DataFrame, suffix: str, lo: int, hi: int) -> DataFrame:
    """Q-16: raw calls of one standard in a height range (debug)."""
    return scan_suffix(blobs, suffix, lo, hi)
