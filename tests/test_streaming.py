"""Stream result = batch result, whatever the arrival order (files fed newest-first, one replayed)."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.operators import kv as K
from blocklake.plans import queries as Q
from blocklake.plans.store import Store
from blocklake.session import scratch_path
from blocklake.sources import fixtures as FX
from blocklake.streaming.registry import Standard, file_standard
from blocklake.streaming.writers import start_standard_stream

SF = "/root/testdata/sf0.001"


def _same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted(a.select(*cols).collect(), key=key) == sorted(b.select(*cols).collect(), key=key)


def test_stream_reversed_and_replayed_equals_batch(spark):
    blobs = Q.event_blobs(spark, SF)
    src = scratch_path(spark, "rev-src")
    blobs.repartitionByRange(4, "block_height").write.parquet(src)
    files = sorted(glob.glob(f"{src.removeprefix('file:')}/*.parquet"))
    assert len(files) > 1
    # Newest blocks arrive first: the file source takes files in modification-time order.
    for i, f in enumerate(reversed(files)):
        os.utime(f, (1_000_000 + i, 1_000_000 + i))
    store = Store(spark, scratch_path(spark, "rev-store"))
    ckpt = scratch_path(spark, "rev-ckpt")
    q = start_standard_stream(spark, src, store, S.KV_SUFFIX, ckpt, available_now=True, max_files_per_trigger=1)
    q.awaitTermination()
    assert len(q.recentProgress) == len(files)  # one micro-batch per file
    # Replay the newest file once more: the restarted query (same checkpoint) reads only that file.
    spark.read.parquet(files[-1]).coalesce(1).write.mode("append").parquet(src)
    q = start_standard_stream(spark, src, store, S.KV_SUFFIX, ckpt, available_now=True, max_files_per_trigger=1)
    q.awaitTermination()
    assert len(q.recentProgress) == 1

    kv = K.explode_kv(blobs.where("suffix = 'kv'"))
    last = K.kv_last(kv)
    assert _same(store.table("s_kv_last"), last)
    assert _same(K.live_edges(store.table("kv_edges")), K.kv_edges(last))
    assert _same(store.table("s_kv"), K.kv_history(kv))
    assert _same(store.table("s_kv_by_block"), K.kv_by_block(kv))
    assert _same(store.table("mv_kv_key"), K.mv_kv_key(K.kv_history(kv)))
    assert _same(store.table("mv_kv_cur_key"), K.mv_kv_cur_key(K.kv_history(kv)))
    assert store.checkpoint_height(S.KV_SUFFIX) is not None


def test_ingest_stream_equals_batch(spark):
    from blocklake.operators.routing import to_blobs
    from blocklake.sources import fixtures as FX
    from blocklake.sources.blocks import flatten_blocks
    from blocklake.streaming.writers import start_ingest_stream

    src = scratch_path(spark, "blocks-src")
    FX.blocks_from_orders(spark, SF).repartition(3).write.json(src)
    store = Store(spark, scratch_path(spark, "ingest-store"))
    q = start_ingest_stream(spark, src, store, scratch_path(spark, "ingest-ckpt"), available_now=True,
                            max_files_per_trigger=1)
    q.awaitTermination()
    expected = to_blobs(flatten_blocks(FX.blocks_from_orders(spark, SF)))
    got = store.table("blobs").drop("ingest_ts_us", "ingest_day")
    assert _same(got.withColumn("data", got.data.cast("string")),
                 expected.withColumn("data", expected.data.cast("string")))
    assert store.checkpoint_height(S.UNIVERSAL_SUFFIX) == expected.agg({"block_height": "max"}).first()[0]


def test_derived_stream_tails_the_stored_blobs_table(spark):
    from blocklake.plans.jobs import ingest_calls

    raw = Store(spark, scratch_path(spark, "two-raw"))
    ingest_calls(raw, Q.event_calls(spark, SF), 0)
    derived = Store(spark, scratch_path(spark, "two-derived"))
    q = start_standard_stream(spark, raw.path("blobs"), derived, S.KV_SUFFIX, scratch_path(spark, "two-ck"),
                              available_now=True)
    q.awaitTermination()
    assert _same(derived.table("s_kv_last"), Q.event_last(spark, SF))
    assert derived.checkpoint_height(S.KV_SUFFIX) <= raw.checkpoint_height(S.UNIVERSAL_SUFFIX)


def test_store_read_gives_user_facing_tables(spark):
    from blocklake.plans.jobs import index_standard

    store = Store(spark, scratch_path(spark, "read-store"))
    index_standard(store, Q.event_blobs(spark, SF), 0, S.KV_SUFFIX)
    last = Q.event_last(spark, SF)
    assert _same(store.read("kv_edges"), K.kv_edges(last))
    assert _same(store.read("all_accounts"), K.all_accounts(last))
    assert _same(store.read("kv_reverse"), K.kv_reverse(last))


@pytest.mark.parametrize("standard", ["files", "kv"])
def test_a_larger_stream_has_more_files_of_bounded_size_and_as_many_batches(spark, monkeypatch, standard):
    blobs, std, name = {
        "files": (Q.doc_blobs(spark, SF), Standard(S.FILES_SUFFIX, file_standard(FX.DOC_ALIGNMENT), (S.FILE_CHUNKS_TABLE,)),
                  S.FILE_CHUNKS_TABLE),
        "kv": (Q.event_blobs(spark, SF), S.KV_SUFFIX, "s_kv_last")}[standard]
    total = blobs.agg(F.sum(F.octet_length("data") + Q.BLOB_ID_BYTES)).first()[0]
    monkeypatch.setattr(Q, "STREAM_FILE_BYTES", total // 18)
    src, files, each = Q._stream_files(spark, blobs)
    assert each == 5 and 16 <= len(files) <= 20
    stored = spark.read.schema(S.BLOBS_SCHEMA).parquet(src).withColumn("file", F.input_file_name())
    size = F.sum(F.octet_length("data") + Q.BLOB_ID_BYTES)
    assert stored.groupBy("file").agg(size.alias("b")).agg(F.max("b")).first()[0] < total / 4
    assert stored.groupBy("block_height").agg(F.countDistinct("file").alias("n")).where("n > 1").count() == 0
    store = Q._stream_store(spark, SF, blobs, std)
    assert 4 <= len(store.batch_ids(name)) <= 5
    expected = Q.doc_chunks(spark, SF) if standard == "files" else Q.event_last(spark, SF)
    assert _same(store.table(name), expected)


def test_the_event_view_is_computed_once_for_a_stream(spark):
    blobs = Q.written_event_blobs(spark, SF)
    assert blobs.inputFiles() and not any("events.parquet" in f for f in blobs.inputFiles())
    assert blobs.schema.names == S.BLOBS_SCHEMA.names and _same(blobs, Q.event_blobs(spark, SF).select(*blobs.columns))


def test_edges_of_a_stream_of_many_files_equal_the_batch(spark, monkeypatch):
    monkeypatch.setattr(Q, "STREAM_FILE_BYTES", 16 << 10)
    assert _same(Q.stream_kv_edges(spark, SF), Q.kv_edges(spark, SF))


def test_the_event_view_reads_each_json_text_once(spark):
    plan = Q.event_calls(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("get_json_object(") == 1 and plan.count("timestampdiff(") == 1


def test_a_quarter_of_the_files_is_a_micro_batch_even_where_blocks_are_few(spark, monkeypatch):
    blobs = Q.event_blobs(spark, SF).withColumn("block_height", F.col("block_height") % 10)
    monkeypatch.setattr(Q, "STREAM_FILE_BYTES", 1 << 10)
    _, files, each = Q._stream_files(spark, blobs)
    assert 4 < len(files) <= 10 and -(-len(files) // each) == 4


def test_tables_of_the_history_are_begun_before_the_latest_rows(spark):
    from blocklake.plans.jobs import index_standard
    from blocklake.streaming.registry import Cache

    order = []
    cache = Cache(lambda name, df: order.append(name) or df, lambda name, df: order.append(name))
    tables = K.derive_kv_tables(Q.event_kv(spark, SF), cache)
    assert order[0] == "s_kv" and order[-1] == "s_kv_last"
    assert set(order[1:-1]) == {"mv_kv_key", "mv_kv_cur_key", "s_kv_by_block"} and set(order) == cache.written
    store = Store(spark, scratch_path(spark, "begun-store"))
    index_standard(store, Q.event_blobs(spark, SF), 0, S.KV_SUFFIX)
    for name, df in K.derive_kv_tables(Q.event_kv(spark, SF)).items():
        assert name in tables and _same(store.table(name), df)


def test_a_failed_table_fails_its_batch_and_moves_no_checkpoint(spark, monkeypatch):
    from blocklake.plans.jobs import index_standard

    store = Store(spark, scratch_path(spark, "failed-store"))
    write = store.write_delta

    def failing(name, df, batch_id):
        if name == "mv_kv_key":
            raise OSError("disk full")
        write(name, df, batch_id)

    monkeypatch.setattr(store, "write_delta", failing)
    with pytest.raises(OSError):
        index_standard(store, Q.event_blobs(spark, SF), 0, S.KV_SUFFIX)
    assert store.checkpoint_height(S.KV_SUFFIX) is None
