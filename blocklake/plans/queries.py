"""Named queries over the driver tables: each is `(spark, sf_dir) -> DataFrame`.

These wire the fixture views (sources.fixtures) to the engine's operators; the same operator functions
run inside the batch jobs (plans.jobs) and the streaming writers (streaming.writers). Every query reads
whole tables; lookup parameters are the lookup itself, not a way to shrink the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blocklake import schemas as S
from blocklake.functions.columns import lww_version, order_id
from blocklake.functions.paths import is_valid_mime, is_valid_relative_path
from blocklake.operators import files as FS
from blocklake.operators import kv as K
from blocklake.operators import reports as RP
from blocklake.operators import routing as R
from blocklake.plans import lookups as Q
from blocklake.plans.jobs import index_pending, index_standard, ingest_calls, ingest_files
from blocklake.plans.latest_table import LatestTable
from blocklake.plans.published import Published, publish
from blocklake.plans.store import Store, expire, scan_suffix
from blocklake.session import checkpoint_root, configure, scratch_path
from blocklake.sources import fixtures as FX
from blocklake.sources.blocks import flatten_blocks as flatten
from blocklake.sources.blocks import read_blocks, split_malformed
from blocklake.sources.validate import validate_rows
from blocklake.streaming.registry import STANDARDS, Cache, Standard, file_standard
from blocklake.streaming.writers import start_history_stream, start_latest_stream, start_standard_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Lookup parameters (accounts of the events and documents views).
PRED, CONTRACT = "user7.near", "app1.near"
FILE_PRED, FILE_CONTRACT, FILE_DOC = "src3", "en.fs.near", 243
LIVE_PRED = "src0"
SCAN_LO, SCAN_HI = FX.EVENTS_HEIGHT_BASE + 97 * 100, FX.EVENTS_HEIGHT_BASE + 97 * 300
EXPIRE_NOW_US = 1_707_955_200_000_000  # 2024-02-15 00:00:00 UTC
STREAM_BATCHES = 4
STREAM_FILE_BYTES = 8 << 20  # of blobs in one file of a stream's source
BLOB_ID_BYTES = 200  # about what a blob holds beside its payload
BLOCK_FEED_START = FX.BLOCKS_HEIGHT_BASE + 10


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _text(df: DataFrame, c: str = "data") -> DataFrame:
    return df.withColumn(c, F.col(c).cast("string"))


# ------------------------------------------------------------------ fixture plumbing
def event_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return FX.calls_from_events(spark, sf_dir)


def event_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.to_blobs(event_calls(spark, sf_dir))


def written_event_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as written, for a reader that goes over them several times: the view is computed once."""
    path = scratch_path(spark, "event-blobs")
    event_blobs(spark, sf_dir).write.parquet(path)
    return spark.read.schema(S.BLOBS_SCHEMA).parquet(path)


def event_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.explode_kv(R.by_suffix(event_blobs(spark, sf_dir), S.KV_SUFFIX))


def event_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.kv_last(event_kv(spark, sf_dir))


def doc_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File blobs of the documents view, materialized like a written blobs table (reliable checkpoint).

    The decoder then reads `data` as a column, as it does from the blobs table, in its own codegen
    stage, instead of sharing one with the fixture's record-encoding expressions.
    """
    configure(spark)
    checkpoint_root(spark)
    return R.by_suffix(R.to_blobs(FX.calls_from_documents(spark, sf_dir)), S.FILES_SUFFIX).checkpoint()


def doc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FS.latest_chunks(FS.decode_files(doc_blobs(spark, sf_dir), FX.DOC_ALIGNMENT))


def _chunk_view(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c != "content"],
                     F.md5("content").alias("content_md5"),
                     F.octet_length("content").cast("int").alias("content_len"))


# ------------------------------------------------------------------ ingest / routing
@query
def flatten_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2 + FLT-1 + PRJ-1 on nested blocks built from orders/lineitem."""
    configure(spark)
    return _text(flatten(FX.blocks_from_orders(spark, sf_dir)), "args")


@query
def block_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1 + SRC-2: the block feed as JSON lines, read with the declared schema from a start height."""
    configure(spark)
    path = scratch_path(spark, "blocks-json")
    FX.blocks_from_orders(spark, sf_dir).write.json(path)
    return _text(flatten(read_blocks(spark, path, "json", start_height=BLOCK_FEED_START)), "args")


@query
def raw_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-2/3/4 + PRJ-1..3: every routed blob."""
    return _text(event_blobs(spark, sf_dir))


@query
def suffix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = event_blobs(spark, sf_dir)
    return b.groupBy("suffix").agg(F.count(F.lit(1)).alias("n_calls"),
                                   F.countDistinct("block_height").alias("n_blocks"))


@query
def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4/5 on every blob."""
    b = event_blobs(spark, sf_dir).select("receipt_id", "suffix", "block_height", "shard_id", "receipt_index",
                                          "action_index", order_id().alias("order_id"))
    return b.withColumn("lww_version", lww_version())


@query
def scan_suffix_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1 then SRC-3/4: blobs written partitioned by (suffix, bucket), range scan prunes buckets."""
    store = Store(spark, scratch_path(spark, "store"))
    ingest_calls(store, event_calls(spark, sf_dir), batch_id=0)
    blobs = store.table("blobs").drop("ingest_ts_us", "ingest_day")
    return _text(scan_suffix(blobs, S.KV_SUFFIX, SCAN_LO, SCAN_HI))


@query
def expire_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: blobs alive under the 30-day TTL at a fixed `now` (ingest time = block time here)."""
    b = event_blobs(spark, sf_dir).withColumn("ingest_ts_us", F.expr("block_timestamp div 1000"))
    return expire(b, EXPIRE_NOW_US).select("receipt_id", "suffix", "block_height")


@query
def malformed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1: a block feed in which every tenth line is cut; no line vanishes without a reject row."""
    configure(spark)
    path = scratch_path(spark, "blocks-bad")
    lines = FX.blocks_from_orders(spark, sf_dir).select(F.to_json(F.struct("block", "shards")).alias("value"), "block")
    cut = F.col("block.header.height") % 10 == 3
    lines.select(F.when(cut, F.expr("substring(value, 1, length(value) div 2)")).otherwise(F.col("value")).alias("value")
                 ).write.text(path)
    good, bad = split_malformed(read_blocks(spark, path, "json", on_error="keep"))
    return flatten(good).select(F.lit("call").alias("kind")).unionByName(
        bad.select(F.col("reason").alias("kind"))).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def validated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-8: blobs of which some carry a negative shard or no signer, split with a reason."""
    k = F.substring("receipt_id", 5, 20).cast("long")
    b = event_blobs(spark, sf_dir).withColumns({
        "shard_id": F.when(k % 50 == 7, -1).otherwise(F.col("shard_id")),
        "signer_id": F.when(k % 50 == 9, F.lit(None)).otherwise(F.col("signer_id"))})
    good, bad = validate_rows(b, "reject")
    return bad.select("receipt_id", "reason").unionByName(good.select("receipt_id", F.lit("ok").alias("reason")))


@query
def late_blobs_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-8 in batch: the newer half is ingested and indexed first, then the older half; nothing is lost."""
    store = Store(spark, scratch_path(spark, "store"))
    calls = event_calls(spark, sf_dir)
    for i, half in enumerate([F.col("block_height") > SCAN_HI, F.col("block_height") <= SCAN_HI]):
        ingest_calls(store, calls.where(half), batch_id=i)
        index_pending(store, i, S.KV_SUFFIX)
    return store.table("s_kv")


# ------------------------------------------------------------------ KV tables
@query
def kv_value_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KV-1/5: which JSON values are accepted, and the text they are stored as."""
    blobs = R.by_suffix(R.to_blobs(FX.value_calls(spark, sf_dir)), S.KV_SUFFIX)
    return K.explode_kv(blobs).select("receipt_id", "key", "value")


@query
def kv_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.kv_history(event_kv(spark, sf_dir))


@query
def kv_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_last(spark, sf_dir)


@query
def kv_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.kv_reverse(event_last(spark, sf_dir))


@query
def all_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.all_accounts(event_last(spark, sf_dir))


@query
def kv_by_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.kv_by_block(event_kv(spark, sf_dir))


@query
def kv_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.kv_accounts(event_last(spark, sf_dir))


@query
def kv_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.kv_edges(event_last(spark, sf_dir))


@query
def mv_kv_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.mv_kv_key(K.kv_history(event_kv(spark, sf_dir)))


@query
def mv_kv_cur_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.mv_kv_cur_key(K.kv_history(event_kv(spark, sf_dir)))


@query
def kv_last_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5/7: KV deltas written in shuffled batches plus one replayed batch, merged on read."""
    store = Store(spark, scratch_path(spark, "store"))
    blobs = event_blobs(spark, sf_dir).withColumn("_part", F.pmod(F.xxhash64("receipt_id"), F.lit(3)))
    for batch_id, part in [(0, 2), (1, 0), (2, 1), (3, 0)]:
        index_standard(store, blobs.where(F.col("_part") == part).drop("_part"), batch_id, S.KV_SUFFIX)
    return store.table("s_kv_last")


@query
def raw_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT-1: the registered `raw` standard's table."""
    return STANDARDS[S.RAW_SUFFIX].transform(R.by_suffix(event_blobs(spark, sf_dir), S.RAW_SUFFIX), Cache())["s_raw"]


BLOCK_CALLS = Standard(S.RAW_SUFFIX, lambda blobs, cache, ends: {"s_block_calls": ends.join(
    blobs.groupBy("block_height").agg(F.count(F.lit(1)).alias("n_calls")), "block_height", "left").select(
        "block_height", F.coalesce("n_calls", F.lit(0).cast("long")).alias("n_calls"))}, ("s_block_calls",), ends=True)


@query
def block_call_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT-1, STR-3: a standard that counts its calls per complete block, the bound of every batch included."""
    store = Store(spark, scratch_path(spark, "store"))
    calls = event_calls(spark, sf_dir)
    for i, half in enumerate([F.col("block_height") <= SCAN_HI, F.col("block_height") > SCAN_HI]):
        ingest_calls(store, calls.where(half), batch_id=i)
        index_pending(store, i, BLOCK_CALLS)
    return store.table("s_block_calls")


# ------------------------------------------------------------------ lookups
@query
def get_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.get_latest(event_last(spark, sf_dir), PRED, CONTRACT, "click")


@query
def list_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.list_keys(event_last(spark, sf_dir), PRED, CONTRACT)


@query
def key_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.key_history(K.kv_history(event_kv(spark, sf_dir)), PRED, CONTRACT, "graph/follow/user3.near")


@query
def key_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.key_prefix(event_last(spark, sf_dir), PRED, CONTRACT, "graph/")


@query
def predecessors_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.predecessors_page(K.kv_reverse(event_last(spark, sf_dir)), CONTRACT, "click", cursor="user1.near",
                               limit=5)


@query
def followers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.followers(K.kv_edges(event_last(spark, sf_dir)), "graph/follow", "user3.near")


@query
def contract_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.contract_accounts(K.kv_accounts(event_last(spark, sf_dir)), "app2.near")


@query
def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.timeline(K.kv_by_block(event_kv(spark, sf_dir)), PRED, CONTRACT)


@query
def timeline_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-8 with an inclusive block-height range."""
    return Q.timeline(K.kv_by_block(event_kv(spark, sf_dir)), PRED, CONTRACT, SCAN_LO, SCAN_HI)


@query
def key_across_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.key_across_accounts(K.mv_kv_key(K.kv_history(event_kv(spark, sf_dir))), "view")


@query
def contract_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.contract_history(K.mv_kv_cur_key(K.kv_history(event_kv(spark, sf_dir))), "app0.near", "purchase")


@query
def account_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.account_registry(K.all_accounts(event_last(spark, sf_dir)))


# ------------------------------------------------------------------ files
@query
def file_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FS-1..FS-8: `s_fastfs_v2` (content shown as md5 + length)."""
    return _chunk_view(doc_chunks(spark, sf_dir))


@query
def file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.list_files(doc_chunks(spark, sf_dir), FILE_PRED, FILE_CONTRACT)


@query
def file_list_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-11 without deleted paths (D16) on the account whose single-chunk files all get deleted."""
    return Q.list_files(doc_chunks(spark, sf_dir), LIVE_PRED, FILE_CONTRACT, live_only=True)


@query
def file_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_view(Q.file_uploads(doc_chunks(spark, sf_dir), FILE_PRED, FILE_CONTRACT,
                                      f"{FILE_PRED}/en/{FILE_DOC}.txt"))


@query
def upload_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_view(Q.upload_chunks(doc_chunks(spark, sf_dir), FILE_PRED, FILE_CONTRACT,
                                       f"{FILE_PRED}/en/{FILE_DOC}.txt", FILE_DOC + 1))


@query
def file_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FS-9: every upload reassembled from its chunks (md5 of the bytes)."""
    a = FS.assemble_files(doc_chunks(spark, sf_dir), FX.DOC_ALIGNMENT)
    return a.select(*[c for c in a.columns if c != "content"], F.md5("content").alias("content_md5"))


@query
def path_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FS-2 on the paths of real page URLs."""
    return FX.page_paths(spark, sf_dir).withColumn("is_valid", is_valid_relative_path("relative_path"))


@query
def mime_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FS-3 on page URLs, the empty text, a control character and both sides of the length limit."""
    pages = FX.table(spark, sf_dir, "pages")
    kind, n = F.col("page_id") % 6, S.MAX_MIME_TYPE_BYTES
    mime = (F.when(kind == 0, "text/html").when(kind == 1, "").when(kind == 2, F.concat(F.lit("text/"), F.lit("\u0007")))
            .when(kind == 3, F.lit("m" * n)).when(kind == 4, F.lit("m" * (n + 1))).otherwise(F.col("url")))
    return pages.select("page_id", is_valid_mime(mime).alias("is_valid"))


# ------------------------------------------------------------------ reports
def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = event_calls(spark, sf_dir)
    blobs = R.to_blobs(calls)
    return (R.suffix_rejects(calls)
            .unionByName(K.kv_rejects(R.by_suffix(blobs, S.KV_SUFFIX)))
            .unionByName(FS.file_rejects(doc_blobs(spark, sf_dir), FX.DOC_ALIGNMENT)))


@query
def reject_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-1, one row per rejected call, blob or key with its reason (the reference only logs them)."""
    return _rejects(spark, sf_dir)


@query
def reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-1 over both inputs: routing, KV blob/key and file rejects with their reasons."""
    return RP.reject_summary(_rejects(spark, sf_dir))


@query
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-1 on inputs that hold every fault: each reason of routing, blobs, keys and uploads is counted."""
    calls = FX.faulty_calls(configure(spark), sf_dir)
    files = R.by_suffix(R.to_blobs(FX.faulty_uploads(spark, sf_dir)), S.FILES_SUFFIX)
    return RP.reject_summary(R.suffix_rejects(calls).unionByName(
        K.kv_rejects(R.by_suffix(R.to_blobs(calls), S.KV_SUFFIX))).unionByName(FS.file_rejects(files, FX.DOC_ALIGNMENT)))


@query
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.throughput(event_calls(spark, sf_dir))


def _two_readings(spark: SparkSession, sf_dir: str) -> Store:
    """Calls up to a height ingested and indexed by both standards; then the rest, indexed by one."""
    store = Store(spark, scratch_path(spark, "store"))
    calls = event_calls(spark, sf_dir)
    ingest_calls(store, calls.where(F.col("block_height") <= SCAN_HI), batch_id=0)
    index_pending(store, 0, S.KV_SUFFIX)
    index_pending(store, 0, S.RAW_SUFFIX)
    store.record_reading(1)
    ingest_calls(store, calls.where(F.col("block_height") > SCAN_HI), batch_id=1)
    index_pending(store, 1, S.RAW_SUFFIX)
    store.record_reading(2)
    return store


@query
def checkpoint_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-14: a standard that has read everything has no lag, whether or not the last blocks held its calls;
    one that has not run since more was ingested lags by what it has not read."""
    return RP.checkpoint_lag(_two_readings(spark, sf_dir).meta())


@query
def stalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-14: of two readings, the standard that stands still behind the head is stalled."""
    return RP.stalls(_two_readings(spark, sf_dir).readings())


# ------------------------------------------------------------------ lookups over stored tables
SHUFFLED = (2, 0, 1)


def _parts(blobs: DataFrame) -> list[DataFrame]:
    """The blobs in three batches, out of order."""
    x = blobs.withColumn("_part", F.pmod(F.xxhash64("receipt_id"), F.lit(3)))
    return [x.where(F.col("_part") == i).drop("_part") for i in SHUFFLED]


def _kv_table(blobs: DataFrame, name: str) -> DataFrame:
    return K.derive_kv_tables(K.explode_kv(R.by_suffix(blobs, S.KV_SUFFIX)))[name]


def stored_table(spark: SparkSession, sf_dir: str, name: str) -> Store:
    """One KV table, written in three batches out of order."""
    store = Store(spark, scratch_path(spark, "store"))
    for i, part in enumerate(_parts(event_blobs(spark, sf_dir))):
        store.write_delta(name, _kv_table(part, name), i)
    return store


@query
def stored_get_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-1 over the stored table: one bucket per delta, merged."""
    return stored_table(spark, sf_dir, "s_kv_last").lookup(
        "s_kv_last", predecessor_id=PRED, current_account_id=CONTRACT, key="click")


@query
def stored_key_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-3 over the stored table."""
    return stored_table(spark, sf_dir, "s_kv").lookup(
        "s_kv", predecessor_id=PRED, current_account_id=CONTRACT, key="graph/follow/user3.near")


@query
def stored_predecessors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-5 over the stored table."""
    found = stored_table(spark, sf_dir, "kv_reverse").lookup("kv_reverse", current_account_id=CONTRACT, key="click")
    return Q.predecessors_page(found, CONTRACT, "click", cursor="user1.near", limit=5)


@query
def stored_followers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-6 over the stored table."""
    return stored_table(spark, sf_dir, "kv_edges").lookup(
        "kv_edges", edge_type="graph/follow", target="user3.near").select("source")


@query
def stored_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-8 over the stored table."""
    return stored_table(spark, sf_dir, "s_kv_by_block").lookup(
        "s_kv_by_block", predecessor_id=PRED, current_account_id=CONTRACT)


@query
def stored_key_across_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-9 over the stored table."""
    return stored_table(spark, sf_dir, "mv_kv_key").lookup("mv_kv_key", key="view")


@query
def stored_contract_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-10 over the stored table."""
    return stored_table(spark, sf_dir, "mv_kv_cur_key").lookup("mv_kv_cur_key", current_account_id="app0.near", key="purchase")


# ------------------------------------------------------------------ tables kept merged, and published in buckets
def merged_table(spark: SparkSession, sf_dir: str, name: str) -> LatestTable:
    """One KV table kept merged over three batches out of order and a replayed one."""
    table = LatestTable(spark, scratch_path(spark, "merged"), name)
    parts = _parts(event_blobs(spark, sf_dir))
    for part in [*parts, parts[0]]:
        table.upsert(_kv_table(part, name))
    return table


def merged_chunks(spark: SparkSession, sf_dir: str) -> LatestTable:
    """The file chunks kept merged, the odd documents before the even ones."""
    table = LatestTable(spark, scratch_path(spark, "merged"), S.FILE_CHUNKS_TABLE)
    blobs = doc_blobs(spark, sf_dir)
    for odd in (True, False):
        half = blobs.where((F.col("block_height") % 4 < 2) == F.lit(odd))
        table.upsert(FS.latest_chunks(FS.decode_files(half, FX.DOC_ALIGNMENT)))
    return table


def _publish(spark: SparkSession, table: LatestTable) -> Published:
    return publish(table.snapshot(), table.name, scratch_path(spark, "published"))


@query
def merged_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-7: `s_kv_last` merged by touched buckets, batch by batch."""
    return merged_table(spark, sf_dir, "s_kv_last").snapshot()


@query
def merged_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-7 with tombstones: the edge state merged by touched buckets, deletions hidden."""
    return K.live_edges(merged_table(spark, sf_dir, "kv_edges").snapshot())


@query
def new_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KV-9 incremental: the triples that the second half of the log adds to a stored registry, and no others."""
    store = Store(spark, scratch_path(spark, "store"))
    blobs = event_blobs(spark, sf_dir)
    for i, half in enumerate([F.col("block_height") <= SCAN_HI, F.col("block_height") > SCAN_HI]):
        accounts = _kv_table(blobs.where(half), "kv_accounts")
        store.write_delta("kv_accounts", K.unknown_accounts(accounts, store.table("kv_accounts")) if i else accounts, i)
    return store.delta("kv_accounts", 1).select("current_account_id", "key", "predecessor_id")


@query
def published_list_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-2 over the published table: the buckets of one account."""
    return _publish(spark, merged_table(spark, sf_dir, "s_kv_last")).find(predecessor_id=PRED, current_account_id=CONTRACT)


@query
def published_key_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-4 over the published table: a prefix of the clustering column."""
    return _publish(spark, merged_table(spark, sf_dir, "s_kv_last")).find(
        predecessor_id=PRED, current_account_id=CONTRACT, starts_with="graph/")


@query
def published_predecessors_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-5 over the published table: a page after a cursor."""
    return _publish(spark, merged_table(spark, sf_dir, "kv_reverse")).find(
        current_account_id=CONTRACT, key="click", after="user1.near", limit=5)


@query
def published_contract_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-7 over the published table."""
    return _publish(spark, merged_table(spark, sf_dir, "kv_accounts")).find(current_account_id="app2.near")


@query
def published_timeline_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-8 over the published table: a range of heights, newest block first."""
    return _publish(spark, merged_table(spark, sf_dir, "s_kv_by_block")).find(
        predecessor_id=PRED, current_account_id=CONTRACT, between=(SCAN_LO, SCAN_HI))


@query
def published_account_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-15 over the table kept merged."""
    return Q.account_registry(K.all_accounts_view(merged_table(spark, sf_dir, "all_accounts").snapshot()))


@query
def published_file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-11 over the published chunks; content is never read."""
    found = _publish(spark, merged_chunks(spark, sf_dir)).find(predecessor_id=FILE_PRED, current_account_id=FILE_CONTRACT)
    return found.select("relative_path").distinct()


@query
def published_file_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-12 over the published chunks."""
    return _chunk_view(_publish(spark, merged_chunks(spark, sf_dir)).find(
        predecessor_id=FILE_PRED, current_account_id=FILE_CONTRACT, relative_path=f"{FILE_PRED}/en/{FILE_DOC}.txt"))


@query
def published_upload_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-13 over the published chunks."""
    return _chunk_view(_publish(spark, merged_chunks(spark, sf_dir)).find(
        predecessor_id=FILE_PRED, current_account_id=FILE_CONTRACT, relative_path=f"{FILE_PRED}/en/{FILE_DOC}.txt",
        nonce=FILE_DOC + 1))


# ------------------------------------------------------------------ streaming
def _stream_files(spark: SparkSession, blobs: DataFrame) -> tuple[str, list[str], int]:
    """Blobs in height-ordered files: their folder, the files, and how many of them make a micro-batch.

    A run takes a quarter of the files in each micro-batch. Their number follows the size of the blobs, so that a task
    writes, and later reads, one file of bounded size, and a micro-batch has as many tasks as its input asks for.
    """
    src = scratch_path(spark, "stream-src")
    size = blobs.agg(F.sum(F.octet_length("data") + F.lit(BLOB_ID_BYTES).cast("long"))).first()[0] or 0
    each = max(1, -(-size // (STREAM_BATCHES * STREAM_FILE_BYTES)))
    blobs.repartitionByRange(STREAM_BATCHES * each, "block_height").write.parquet(src)
    files = sorted(spark.read.schema(S.BLOBS_SCHEMA).parquet(src).inputFiles())
    # A block stays in one file, so there are no more files than blocks.
    return src, files, max(1, -(-len(files) // STREAM_BATCHES))


def _replay(spark: SparkSession, src: str, files: list[str]) -> None:
    """These files' blobs once more, under new names; a block stays in one file."""
    again = spark.read.schema(S.BLOBS_SCHEMA).parquet(*files)
    again.repartitionByRange(len(files), "block_height").write.mode("append").parquet(src)


def _stream_store(spark: SparkSession, sf_dir: str, blobs: DataFrame, suffix: str | Standard) -> Store:
    """Blobs streamed in four micro-batches, and the first files replayed in a fifth."""
    src, files, each = _stream_files(spark, blobs)
    store = Store(spark, scratch_path(spark, "store"))
    ckpt = scratch_path(spark, "stream-ckpt")
    q = start_standard_stream(spark, src, store, suffix, ckpt, available_now=True, max_files_per_trigger=each)
    q.awaitTermination()
    if files:
        # The restarted query reads the replayed files alone.
        _replay(spark, src, files[:each])
        q = start_standard_stream(spark, src, store, suffix, ckpt, available_now=True, max_files_per_trigger=each)
        q.awaitTermination()
    return store


@query
def stream_kv_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-*: `s_kv_last` built by a file stream of blobs (with a replayed file) equals the batch table."""
    return _stream_store(spark, sf_dir, written_event_blobs(spark, sf_dir), S.KV_SUFFIX).table("s_kv_last")


@query
def stream_kv_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-*: live edges from the streamed edge state (tombstones kept in the deltas)."""
    store = _stream_store(spark, sf_dir, written_event_blobs(spark, sf_dir), S.KV_SUFFIX)
    return K.live_edges(store.table("kv_edges"))


@query
def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-* for the file standard (4 KiB alignment of the document view)."""
    std = Standard(S.FILES_SUFFIX, file_standard(FX.DOC_ALIGNMENT), (S.FILE_CHUNKS_TABLE,))
    store = _stream_store(spark, sf_dir, doc_blobs(spark, sf_dir), std)
    return _chunk_view(store.table(S.FILE_CHUNKS_TABLE))


def _replayed_files(spark: SparkSession, sf_dir: str, start: Callable[[str, int], StreamingQuery]) -> None:
    """Run a stream over the blobs in four micro-batches; then once more with the first files replayed."""
    src, files, each = _stream_files(spark, written_event_blobs(spark, sf_dir))
    start(src, each).awaitTermination()
    if files:
        _replay(spark, src, files[:each])
        start(src, each).awaitTermination()


@query
def stream_state_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-6: `s_kv_last` by a streaming argmax in the state store, changed keys merged into the table."""
    table = LatestTable(spark, scratch_path(spark, "merged"), "s_kv_last")
    ckpt = scratch_path(spark, "stream-ckpt")
    _replayed_files(spark, sf_dir, lambda src, each: start_latest_stream(
        spark, src, table, ckpt, available_now=True, max_files_per_trigger=each))
    return table.snapshot()


@query
def stream_state_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-7: `s_kv` appended by a stream that drops known keys; the replayed file adds no row, nothing is merged."""
    path, ckpt = scratch_path(spark, "history"), scratch_path(spark, "stream-ckpt")
    _replayed_files(spark, sf_dir, lambda src, each: start_history_stream(
        spark, src, path, ckpt, available_now=True, max_files_per_trigger=each))
    return spark.read.schema(S.S_KV_SCHEMA).parquet(path)


@query
def late_files_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1/8: block files of newer blocks first, the older ones into the same folder later; all calls are stored."""
    store, src = Store(spark, scratch_path(spark, "store")), scratch_path(spark, "blocks-json")
    blocks = FX.blocks_from_orders(configure(spark), sf_dir)
    late = F.col("block.header.height") % 2 == 0
    for i, half in enumerate([~late, late]):
        blocks.where(half).write.mode("append").json(src)
        ingest_files(store, src, i, start=BLOCK_FEED_START)
    return _text(store.table("blobs").drop("ingest_ts_us", "ingest_day"))
