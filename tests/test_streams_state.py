"""Streams in the state store, streams bounded by the raw checkpoint, the ledger of files, failures and stops."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.plans.jobs import LATEST, START_SUFFIX, ingest_calls, ingest_files
from blocklake.plans.latest_table import LatestTable
from blocklake.plans.store import Store
from blocklake.session import scratch_path
from blocklake.streaming.writers import (start_history_stream, start_ingest_stream, start_latest_stream,
                                         start_standard_stream)
from helpers import blobs


def kv_file(spark, path, rows, nth):
    """One blobs file with an arrival time of its own."""
    before = set(glob.glob(f"{path.removeprefix('file:')}/*.parquet"))
    blobs(spark, rows).coalesce(1).write.mode("append").parquet(path)
    for f in set(glob.glob(f"{path.removeprefix('file:')}/*.parquet")) - before:
        os.utime(f, (1_700_000_000 + nth, 1_700_000_000 + nth))


def block(height, method):
    """A block with one call, as a line of the feed."""
    call = {"FunctionCall": {"method_name": method, "args": "e30="}}
    receipt = {"receipt_id": f"r{height}", "predecessor_id": "p", "receiver_id": "c",
               "receipt": {"Action": {"signer_id": "s", "actions": [call]}}}
    return json.dumps({"block": {"header": {"height": height, "timestamp": height * 10}}, "shards": [
        {"shard_id": 0, "receipt_execution_outcomes": [{"tx_hash": None, "receipt": receipt}]}]})


def block_file(spark, path, *blocks):
    spark.createDataFrame([(b,) for b in blocks], "value string").coalesce(1).write.mode("append").text(path)


def heights(df):
    return sorted(r[0] for r in df.select("block_height").distinct().collect())


# ------------------------------------------------------------------ state store
def test_latest_stream_reversed_and_replayed(spark):
    src, table = scratch_path(spark, "src"), LatestTable(spark, scratch_path(spark, "latest"), "s_kv_last")
    files = [[dict(data='{"a":"new","b":1.50}', block_height=9)], [dict(data='{"a":"old"}', block_height=3)],
             [dict(data='{"a":"mid","c":null}', block_height=5)]]
    ckpt = scratch_path(spark, "ck")
    written = []
    for i, rows in enumerate([*files, files[1]]):  # newest first, then one replayed
        kv_file(spark, src, rows, i)
        before = table.head().version if table.head() else 0
        start_latest_stream(spark, src, table, ckpt, available_now=True, max_files_per_trigger=1).awaitTermination()
        written.append(table.head().version - before)
    got = {r["key"]: (r["value"], r["block_height"]) for r in table.snapshot().collect()}
    assert got == {"a": ('"new"', 9), "b": ("1.5", 9), "c": ("null", 5)}
    assert written == [1, 0, 1, 0]  # old and replayed rows write nothing


def test_history_stream_adds_no_row_for_a_replayed_file(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "history", "ck"))
    files = [[dict(data='{"a":1,"b":2}', block_height=9)], [dict(data='{"a":3}', block_height=3)]]
    for i, rows in enumerate([*files, *files, [dict(data='{"z":1}', block_height=1)]]):
        kv_file(spark, src, rows, i)
        start_history_stream(spark, src, out, ckpt, available_now=True, max_files_per_trigger=1).awaitTermination()
    got = spark.read.schema(S.S_KV_SCHEMA).parquet(out)
    assert sorted((r["key"], r["block_height"]) for r in got.collect()) == [("a", 3), ("a", 9), ("b", 9), ("z", 1)]


# ------------------------------------------------------------------ bound by the raw stage (STR-2, SNK-2, Q-14)
def test_derived_stream_never_passes_the_raw_checkpoint(spark):
    root, ckpt = scratch_path(spark, "bound"), scratch_path(spark, "ck")
    store = Store(spark, root)
    rows = blobs(spark, [dict(data='{"a":1}', block_height=h, receipt_id=str(h)) for h in (5, 6, 7)])
    store.write_delta("blobs", rows.withColumns({"ingest_ts_us": F.lit(0).cast("long"), "ingest_day": F.lit("2024-01-01")}), 0)
    store.write_meta(S.UNIVERSAL_SUFFIX, 6)  # the raw stage is still writing block 7
    run = lambda: start_standard_stream(spark, store.path("blobs"), store, S.KV_SUFFIX, ckpt, available_now=True, raw=store)
    run().awaitTermination()
    assert heights(store.table("s_kv")) == [5, 6] and store.checkpoint_height(S.KV_SUFFIX) == 6
    more = blobs(spark, [dict(data="x", block_height=8, receipt_id="8")], suffix="raw")
    store.write_delta("blobs", more.withColumns({"ingest_ts_us": F.lit(0).cast("long"), "ingest_day": F.lit("2024-01-01")}), 1)
    store.write_meta(S.UNIVERSAL_SUFFIX, 8)
    run().awaitTermination()
    # What was held is indexed; block 8 held no call of this standard, whose checkpoint moves there all the same.
    assert heights(store.table("s_kv")) == [5, 6, 7] and store.checkpoint_height(S.KV_SUFFIX) == 8


# ------------------------------------------------------------------ ledger of files (STR-1, STR-8)
def test_late_files_are_ingested_once(spark):
    store, src = Store(spark, scratch_path(spark, "led")), scratch_path(spark, "blocks")
    block_file(spark, src, block(20, "__fastdata_kv"), block(21, "__fastdata_kv"))
    assert len(ingest_files(store, src, 0, start=10)) == 1
    block_file(spark, src, block(15, "__fastdata_kv"), block(9, "__fastdata_kv"))  # late, and before the start
    assert len(ingest_files(store, src, 1)) == 1 and ingest_files(store, src, 2) == []
    assert heights(store.table("blobs")) == [15, 20, 21]
    assert store.checkpoint_height(S.UNIVERSAL_SUFFIX) == 21
    assert [r["suffix"] for r in store.meta().collect()] == ["*"]  # the start position is no standard


def test_start_latest_is_the_default(spark):
    for start in (None, LATEST):
        store, src = Store(spark, scratch_path(spark, "led")), scratch_path(spark, "blocks")
        block_file(spark, src, block(20, "__fastdata_kv"), block(21, "__fastdata_kv"))
        ingest_files(store, src, 0, start=start)
        block_file(spark, src, block(22, "__fastdata_kv"), block(7, "__fastdata_kv"))
        ingest_files(store, src, 1, start=start)
        assert heights(store.table("blobs")) == [21, 22] and store.checkpoint_height(START_SUFFIX) == 21


def test_crash_before_the_ledger_reads_again_without_copies(spark, monkeypatch):
    store, src = Store(spark, scratch_path(spark, "led")), scratch_path(spark, "blocks")
    block_file(spark, src, block(20, "__fastdata_kv"))
    with monkeypatch.context() as m:
        m.setattr(Store, "mark_ingested", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            ingest_files(store, src, 0, start=0)
    assert len(ingest_files(store, src, 1)) == 1
    assert store.table("blobs").count() == 1 and store.raw("blobs").count() == 2


# ------------------------------------------------------------------ the batch is computed once
def test_ingest_computes_its_rows_once(spark):
    from pyspark.sql.types import LongType

    seen = spark.sparkContext.accumulator(0)

    @F.udf(LongType())
    def counted(h):
        seen.add(1)
        return h

    from helpers import BASE
    n = 300
    calls = spark.createDataFrame([tuple({**BASE, "receipt_id": str(i), "block_height": i, "method_name": "__fastdata_kv",
                                          "args": bytearray(b"{}")}[c] for c in S.CALLS_SCHEMA.names) for i in range(n)], S.CALLS_SCHEMA)
    store = Store(spark, scratch_path(spark, "once"))
    ingest_calls(store, calls.withColumn("block_height", F.coalesce(counted.asNondeterministic()("block_height"), F.lit(0))), 0)
    assert seen.value == n and store.raw("blobs").count() == n


# ------------------------------------------------------------------ failure and stop (STR-9)
def test_failed_batch_moves_no_checkpoint_and_a_stopped_query_resumes(spark, monkeypatch):
    src, ckpt, store = scratch_path(spark, "blocks"), scratch_path(spark, "ck"), Store(spark, scratch_path(spark, "st"))
    run = lambda: start_ingest_stream(spark, src, store, ckpt, available_now=True, max_files_per_trigger=1)
    block_file(spark, src, block(20, "__fastdata_kv"))
    run().awaitTermination()
    block_file(spark, src, block(21, "__fastdata_kv"))
    with monkeypatch.context() as m:
        m.setattr(Store, "write_delta", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("disk full")))
        with pytest.raises(Exception, match="disk full"):
            run().awaitTermination()
    assert store.checkpoint_height(S.UNIVERSAL_SUFFIX) == 20 and heights(store.table("blobs")) == [20]
    q = start_ingest_stream(spark, src, store, ckpt, processing_time="1 second")
    q.processAllAvailable()
    q.stop()
    assert not q.isActive and heights(store.table("blobs")) == [20, 21]
    block_file(spark, src, block(22, "__fastdata_kv"))
    run().awaitTermination()
    assert heights(store.table("blobs")) == [20, 21, 22] and store.checkpoint_height(S.UNIVERSAL_SUFFIX) == 22
    assert store.raw("blobs").count() == 3  # the failed file once


def test_derived_stream_rejects_bad_rows(spark):
    src, store = scratch_path(spark, "src"), Store(spark, scratch_path(spark, "st"))
    kv_file(spark, src, [dict(data='{"a":1}', shard_id=-1)], 0)
    q = start_standard_stream(spark, src, store, S.KV_SUFFIX, scratch_path(spark, "ck"), available_now=True)
    with pytest.raises(Exception, match="negative_shard_id"):
        q.awaitTermination()
    assert store.checkpoint_height(S.KV_SUFFIX) is None


# ------------------------------------------------------------------ block ends (STR-3, EXT-1)
def test_block_ends_batch_equals_stream(spark):
    from blocklake.plans.jobs import index_standard
    from blocklake.plans.queries import BLOCK_CALLS

    store = Store(spark, scratch_path(spark, "ends"))
    rows = [dict(data="x", block_height=h, receipt_id=f"{h}-{i}") for h, n in ((5, 2), (6, 1), (9, 3)) for i in range(n)]
    index_standard(store, blobs(spark, rows, "raw"), 0, BLOCK_CALLS, upper_bound=11)
    batch = sorted(tuple(r) for r in store.table("s_block_calls").collect())
    assert batch == [(5, 2), (6, 1), (9, 3), (11, 0)]
    src, streamed = scratch_path(spark, "src"), Store(spark, scratch_path(spark, "ends"))
    streamed.write_meta(S.UNIVERSAL_SUFFIX, 11)
    for i, h in enumerate((9, 5, 6)):
        before = set(glob.glob(f"{src}/*.parquet"))
        blobs(spark, [r for r in rows if r["block_height"] == h], "raw").coalesce(1).write.mode("append").parquet(src)
        assert len(set(glob.glob(f"{src.removeprefix('file:')}/*.parquet")) - before) >= 1
        start_standard_stream(spark, src, streamed, BLOCK_CALLS, f"{src}-ck", available_now=True, raw=streamed).awaitTermination()
    assert sorted(tuple(r) for r in streamed.table("s_block_calls").collect()) == batch


def test_merged_standard_equals_deltas(spark):
    from blocklake.plans.jobs import index_standard, merge_standard

    store = Store(spark, scratch_path(spark, "both"))
    batches = [blobs(spark, [dict(data='{"graph/f/x":1,"b":1.0}', block_height=h, predecessor_id=p) for p in "ab"]) for h in (7, 5)]
    batches.append(blobs(spark, [dict(data='{"graph/f/x":null}', block_height=9, predecessor_id="a")]))
    for i, b in enumerate(batches):
        index_standard(store, b, i, S.KV_SUFFIX)
        touched = merge_standard(store, b, S.KV_SUFFIX)
    assert touched["kv_accounts"] == [] and touched["s_kv_last"] != []
    for name in touched:
        cols = sorted(S.TABLE_SCHEMAS[name].names)
        merged = LatestTable(spark, f"{store.root}/merged", name).snapshot()
        want = store.table(name)
        assert sorted(map(str, merged.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect())), name
