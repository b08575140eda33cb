"""KV standard (KV-1..KV-16): JSON-object blobs -> key/value history and its derived tables.

All tables are DataFrame functions of DataFrames, shared by the batch job and the streaming
`foreachBatch` writer. Only the latest-value family needs a shuffle (one argmax per key); the explode,
guards and key checks are narrow and run inside one codegen stage.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.functions.columns import edge_of, is_deletion, is_valid_key, order_id
from blocklake.functions.fence import fence
from blocklake.functions.json_text import is_plain, let, readied, unmarked, unmarked_key
from blocklake.operators.latest import latest_by
from blocklake.operators.routing import reject_rows

KV_COLS = S.PROVENANCE_COLS + ["order_id", "key", "value"]
KV_LAST_KEY = ["predecessor_id", "current_account_id", "key"]
KV_HISTORY_KEY = ["predecessor_id", "current_account_id", "key", "block_height", "order_id"]
KV_VERSION = ["block_height", "order_id"]
EDGE_KEY = ["edge_type", "target", "source"]
# D12 tie-break after the version: a deletion wins, then the greater value, then the greater contract.
EDGE_VERSION = ["block_height", "order_id", "is_deletion", "value", "current_account_id"]


@lru_cache(maxsize=4)
def _json_columns(app: str) -> tuple[Column, Column]:
    """Whether `data` is plain JSON, and the text to parse: long expressions, built once an application."""
    txt = F.col("data").cast("string")
    return is_plain(txt), F.when(F.col("_plain"), txt).otherwise(let(txt, readied))


@lru_cache(maxsize=4)
def _pair_columns(app: str) -> tuple[Column, Column]:
    """A parsed object's entry (`key`, `_val`) as it stood in the text: the key, and the value as compact JSON text."""
    text = F.to_json("_val")
    return (F.when(F.col("_plain"), F.col("key")).otherwise(unmarked_key(F.col("key"))).alias("key"),
            F.when(F.col("_plain"), text).otherwise(unmarked(text)).alias("value"))


def classify_kv_blobs(blobs: DataFrame) -> DataFrame:
    """KV-2/KV-3 guards in the reference's order: JSON -> object -> key count -> order_id.

    Adds `_obj` (map<string, variant>, duplicate keys collapsed last-wins), `_plain` (whether its values print as
    they are, or through `unmarked`), `order_id` and `reason` (null for an accepted blob). The key count is taken on
    the whole object, before key checks (D5).
    """
    # Parsed once, behind a fence: the accept filter below must not re-parse inside its condition.
    plain, ready = _json_columns(blobs.sparkSession.sparkContext.applicationId)
    x = fence(fence(blobs, _plain=plain), _v=F.try_parse_json(ready))
    x = fence(x, _obj=F.expr("try_cast(_v AS map<string, variant>)"), order_id=order_id())
    reason = (
        F.when(F.col("_v").isNull(), "invalid_json")
        .when(F.col("_obj").isNull(), "not_object")
        .when(F.size("_obj") > S.MAX_NUM_KEYS, "too_many_keys")
        .when(F.col("order_id").isNull(), "order_id_overflow")
    )
    return x.withColumn("reason", reason).drop("_v")


def explode_kv(blobs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """KV-1/4/5: one row per accepted key with its value as compact JSON text (S_KV_SCHEMA columns, then `keep`).

    A JSON string keeps its quotes and JSON null is the 4-character text `null` (D8); numbers are spelled as
    the reference's writer spells them (`1.0`, `1e16`).
    """
    ok = classify_kv_blobs(blobs).where(F.col("reason").isNull())
    e = ok.select(*S.PROVENANCE_COLS, "order_id", *keep, "_plain", F.explode("_obj").alias("key", "_val"))
    return e.select(*S.PROVENANCE_COLS, "order_id", *_pair_columns(blobs.sparkSession.sparkContext.applicationId), *keep).where(
        is_valid_key("key"))


def kv_rejects(blobs: DataFrame) -> DataFrame:
    """RPT-1 rows for rejected KV blobs and keys, with the reason the reference would only log.

    One pass: a blob yields itself with its reason, or each of its bad keys. `detail` is the whole payload or
    key; a count by reason never reads it.
    """
    c = classify_kv_blobs(blobs)

    def fault(stage: str, reason: Column, detail: Column) -> Column:
        return F.struct(F.lit(stage).alias("stage"), reason.alias("reason"), detail.alias("detail"))

    whole = F.array(fault("kv_blob", F.col("reason"), F.col("data").cast("string")))
    written = F.transform(F.map_keys("_obj"), lambda k: F.when(F.col("_plain"), k).otherwise(unmarked_key(k)))
    bad_keys = F.filter(written, lambda k: ~is_valid_key(k))
    keys = F.transform(bad_keys, lambda k: fault("kv_key", F.when(
        F.octet_length(k) > S.MAX_KEY_BYTES, "key_too_long").otherwise("invalid_key"), k))
    e = c.select("*", F.explode(F.when(F.col("reason").isNotNull(), whole).otherwise(keys)).alias("_f"))
    return reject_rows(e, F.col("_f.stage"), F.col("_f.reason"), F.col("_f.detail"))


def kv_history(kv: DataFrame) -> DataFrame:
    """KV-6 `s_kv`: unique on (pred, contract, key, height, order_id); replayed rows collapse."""
    return kv.dropDuplicates(KV_HISTORY_KEY)


def kv_last(kv: DataFrame) -> DataFrame:
    """KV-7 `s_kv_last`: newest (block_height, order_id) per (pred, contract, key). `null` values stay (D9)."""
    return latest_by(kv.select(*KV_COLS), KV_LAST_KEY, KV_VERSION)


def kv_reverse(last: DataFrame) -> DataFrame:
    """KV-13 `kv_reverse`: the latest rows keyed by (contract, key) -> predecessor."""
    return last.select("current_account_id", "key", "predecessor_id", "receipt_id", "action_index", "tx_hash",
                       "signer_id", "block_height", "block_timestamp", "shard_id", "receipt_index", "order_id",
                       "value")


def kv_accounts(last: DataFrame) -> DataFrame:
    """KV-9 `kv_accounts`: (contract, key, predecessor); `last` is already unique on it, so no shuffle."""
    return last.select("current_account_id", "key", "predecessor_id")


def unknown_accounts(accounts: DataFrame, stored: DataFrame) -> DataFrame:
    """KV-9 incremental: the triples of a batch that a stored registry does not hold yet."""
    return accounts.join(stored.select(*accounts.columns), accounts.columns, "left_anti")


def edge_candidates(last: DataFrame) -> DataFrame:
    """KV-10/11: edge rows (insert or tombstone) of every latest key that parses as an edge."""
    e = last.select("*", edge_of("key", "predecessor_id").alias("_e")).where(F.col("_e").isNotNull())
    return e.select(
        F.col("_e.edge_type").alias("edge_type"), F.col("_e.target").alias("target"),
        F.col("_e.source").alias("source"), "current_account_id", "block_height", "block_timestamp",
        "order_id", "value", is_deletion("value").alias("is_deletion"))


def kv_edge_state(last: DataFrame) -> DataFrame:
    """KV-12 state: newest write per (edge_type, target, source), tombstones kept.

    The contract is not part of the identity (D11): the same edge written on two contracts, or as
    `/a/b` and `a/b`, collapses to one. Argmax over the latest rows equals argmax over all history,
    because each history row's newest version per (pred, contract, key) is in `last`.
    """
    return latest_by(edge_candidates(last), EDGE_KEY, EDGE_VERSION)


def live_edges(state: DataFrame) -> DataFrame:
    return state.where(~F.col("is_deletion")).drop("is_deletion")


def kv_edges(last: DataFrame) -> DataFrame:
    """KV-12 `kv_edges`: live edges only (a newest `null` write deletes)."""
    return live_edges(kv_edge_state(last))


def all_accounts_state(last: DataFrame) -> DataFrame:
    """KV-14 state: per predecessor, its newest write's (height, timestamp, order_id)."""
    return latest_by(last.select("predecessor_id", "block_height", "block_timestamp", "order_id"),
                     ["predecessor_id"], KV_VERSION)


def all_accounts_view(state: DataFrame) -> DataFrame:
    return state.select("predecessor_id", F.col("block_height").alias("last_block_height"),
                        F.col("block_timestamp").alias("last_block_timestamp"))


def all_accounts(last: DataFrame) -> DataFrame:
    """KV-14 `all_accounts`: per predecessor, height and timestamp of its newest write."""
    return all_accounts_view(all_accounts_state(last))


def kv_by_block(kv: DataFrame) -> DataFrame:
    """KV-8 `s_kv_by_block`: one row per (pred, contract, height, key), highest order_id wins (D14)."""
    cols = ["predecessor_id", "current_account_id", "block_height", "key", "value", "block_timestamp",
            "order_id", "receipt_id", "tx_hash"]
    return latest_by(kv.select(*cols), ["predecessor_id", "current_account_id", "block_height", "key"],
                     ["order_id"])


def mv_kv_key(history: DataFrame) -> DataFrame:
    """KV-15: history re-keyed by key (key, height, order_id, pred, contract)."""
    h = history.where(F.col("key").isNotNull() & F.col("block_height").isNotNull()
                      & F.col("order_id").isNotNull() & F.col("predecessor_id").isNotNull()
                      & F.col("current_account_id").isNotNull())
    return h.select("key", "block_height", "order_id", "predecessor_id", "current_account_id",
                    *[c for c in KV_COLS if c not in ("key", "block_height", "order_id", "predecessor_id",
                                                       "current_account_id")])


def mv_kv_cur_key(history: DataFrame) -> DataFrame:
    """KV-16: history re-keyed by contract (contract, key, height, order_id, pred)."""
    h = history.where(F.col("key").isNotNull() & F.col("block_height").isNotNull()
                      & F.col("order_id").isNotNull() & F.col("predecessor_id").isNotNull()
                      & F.col("current_account_id").isNotNull())
    return h.select("current_account_id", "key", "block_height", "order_id", "predecessor_id",
                    *[c for c in KV_COLS if c not in ("key", "block_height", "order_id", "predecessor_id",
                                                       "current_account_id")])


def derive_kv_tables(kv: DataFrame, cache=None) -> dict[str, DataFrame]:
    """Every KV table of one batch of exploded rows (SNK-5 fan-out).

    With a `cache` the history is made first and the rest derives from it, so the rows are parsed once; the latest
    rows, which feed five tables, are made once as well, beside the tables that need the history alone.
    """
    history = kv_history(kv)
    if cache is not None:
        kv = history = cache.table("s_kv", history)
    # The two access paths of the history, clustered by key and by contract (KV-15/16), and its newest write a block.
    of_history = {"mv_kv_cur_key": mv_kv_cur_key(history), "mv_kv_key": mv_kv_key(history), "s_kv_by_block": kv_by_block(kv)}
    last = kv_last(kv)
    if cache is not None:
        for name, df in of_history.items():
            cache.begin(name, df)
        last = cache.table("s_kv_last", last)
    return {
        "s_kv": history,
        **of_history,
        "s_kv_last": last,
        "kv_reverse": kv_reverse(last),
        "kv_accounts": kv_accounts(last),
        "kv_edges": kv_edge_state(last),
        "all_accounts": all_accounts_state(last),
    }
