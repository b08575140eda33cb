"""The semantic decisions of SURVEY §1.5 (D1-D21) on small literal inputs."""

import json

import pytest
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.functions.binary import encode_partial, encode_simple
from blocklake.functions.columns import is_valid_suffix
from blocklake.operators import files as FS
from blocklake.operators import kv as K
from blocklake.operators.latest import latest_by
from blocklake.operators.routing import suffix_rejects, to_blobs
from blocklake.plans.store import scan_suffix
from blocklake.sources.blocks import flatten_blocks
from tests.helpers import blobs, rows


def test_d1_positions_before_filtering(spark):
    block = {
        "block": {"header": {"height": 7, "timestamp": 70}},
        "shards": [{"shard_id": 3, "receipt_execution_outcomes": [
            {"tx_hash": "t0", "receipt": {"receipt_id": "data-receipt", "predecessor_id": "a", "receiver_id": "b",
                                          "receipt": {"Action": None}}},
            {"tx_hash": None, "receipt": {"receipt_id": "r1", "predecessor_id": "a", "receiver_id": "c",
                                          "receipt": {"Action": {"signer_id": "s", "actions": [
                                              {"FunctionCall": None},
                                              {"FunctionCall": {"method_name": "__fastdata_kv", "args": "e30="}},
                                          ]}}}},
        ]}],
    }
    df = spark.createDataFrame([block], S.BLOCK_SCHEMA)
    got = flatten_blocks(df).collect()
    assert [(r.receipt_id, r.shard_id, r.receipt_index, r.action_index, bytes(r.args)) for r in got] == [
        ("r1", 3, 1, 1, b"{}")]


@pytest.mark.parametrize("suffix,ok", [("kv", True), ("a-b_C9", True), ("x" * 64, True), ("x" * 65, False),
                                       ("*", False), ("", False), ("kv\n", False), ("a b", False), ("é", False)])
def test_d3_suffix(spark, suffix, ok):
    assert spark.createDataFrame([(suffix,)], "suffix string").select(is_valid_suffix()).first()[0] is ok


def test_d3_routing_and_rejects(spark):
    calls = spark.createDataFrame(
        [("r1", 0, None, "s", "p", "c", 1, 1, 0, 0, m, bytearray(b"{}"))
         for m in ["__fastdata_kv", "__fastdata_*", "__fastdata_", "transfer", "__fastdata_a b"]],
        S.CALLS_SCHEMA)
    assert [r.suffix for r in to_blobs(calls).collect()] == ["kv"]
    assert sorted(r.detail for r in suffix_rejects(calls).collect()) == ["", "*", "a b"]


def test_d4_order_id_range_drops_blob(spark):
    b = blobs(spark, [dict(data='{"a":1}', receipt_index=100_000), dict(data='{"a":1}', action_index=1000),
                      dict(data='{"b":1}', shard_id=2, receipt_index=5, action_index=7)])
    kv = K.explode_kv(b)
    assert rows(kv, "key", "order_id") == [("b", (2 * 100_000 + 5) * 1000 + 7)]
    assert sorted(r.reason for r in K.kv_rejects(b).collect()) == ["order_id_overflow"] * 2


def test_d5_guards_and_key_count_before_key_checks(spark):
    many = json.dumps({f"k{i}": i for i in range(256)})
    too_many = json.dumps({**{f"k{i}": i for i in range(256)}, "": 1})  # 257 keys, one of them invalid
    b = blobs(spark, [dict(data=many, receipt_id="ok"), dict(data=too_many, receipt_id="big"),
                      dict(data="[1]", receipt_id="arr"), dict(data="{bad", receipt_id="bad"),
                      dict(data=b"\xff\xfe", receipt_id="utf8")])
    assert K.explode_kv(b).count() == 256
    assert dict(rows(K.kv_rejects(b), "receipt_id", "reason")) == {
        "big": "too_many_keys", "arr": "not_object", "bad": "invalid_json", "utf8": "invalid_json"}


def test_d5_duplicate_keys_last_wins(spark):
    b = blobs(spark, [dict(data='{"a":1,"a":2}')])
    assert rows(K.explode_kv(b), "key", "value") == [("a", "2")]


def test_d6_d7_key_checks(spark):
    keys = {"x" * 1024: True, "x" * 1025: False, "é" * 512: True, "é" * 513: False, "": False,
            "a\u0085b": False, "a\tb": False, "a b": True}
    b = blobs(spark, [dict(data=json.dumps({k: 1}), receipt_id=str(i)) for i, k in enumerate(keys)])
    kept = {r.key for r in K.explode_kv(b).collect()}
    assert kept == {k for k, ok in keys.items() if ok}


def test_d8_value_text(spark):
    b = blobs(spark, [dict(data='{"s":"x","n":null,"q":"null","i":5,"o":{"a":[1,2]}}')])
    assert dict(rows(K.explode_kv(b), "key", "value")) == {
        "s": '"x"', "n": "null", "q": '"null"', "i": "5", "o": '{"a":[1,2]}'}


def test_d9_null_does_not_delete_latest(spark):
    b = blobs(spark, [dict(data='{"k":1}', block_height=1), dict(data='{"k":null}', block_height=2)])
    assert rows(K.kv_last(K.explode_kv(b)), "key", "value") == [("k", "null")]


def test_d10_struct_version_not_packed_long(spark):
    # (5, 2e9) < (6, 0) as a tuple, although 5*1e9 + 2e9 > 6*1e9 as a packed long.
    df = spark.createDataFrame([("k", 5, 2_000_000_000, "old"), ("k", 6, 0, "new")],
                               "key string, block_height long, order_id long, v string")
    assert latest_by(df, ["key"], ["block_height", "order_id"]).first().v == "new"


def test_d11_d12_edges(spark):
    b = blobs(spark, [
        dict(data='{"graph/follow/bob.near": 1}', block_height=1, current_account_id="a1.near"),
        dict(data='{"graph/follow/bob.near": 2}', block_height=2, current_account_id="a2.near", receipt_id="r2"),
        # same blob writes the same edge twice (leading '/'): the deletion wins the tie
        dict(data='{"/x/carol.near": 1, "x/carol.near": null}', block_height=3, receipt_id="r3"),
        dict(data='{"/y/dan.near": "b", "y/dan.near": "a"}', block_height=3, receipt_id="r4", action_index=1),
    ])
    last = K.kv_last(K.explode_kv(b))
    assert rows(K.kv_edges(last), "edge_type", "target", "source", "current_account_id", "value") == [
        ("graph/follow", "bob.near", "alice.near", "a2.near", "2"),
        ("y", "dan.near", "alice.near", "app.near", '"b"'),
    ]


def test_d14_by_block_highest_order_id(spark):
    b = blobs(spark, [dict(data='{"k":1}', receipt_index=1), dict(data='{"k":2}', receipt_index=2, receipt_id="b")])
    assert rows(K.kv_by_block(K.explode_kv(b)), "key", "value") == [("k", "2")]


def _file_blobs(spark, recs):
    return blobs(spark, [dict(data=bytes(spark.range(1).select(col).first()[0]), **prov) for col, prov in recs],
                 suffix="fastfs")


def test_d15_d16_reupload_and_deletion(spark):
    lit = F.lit
    recs = [
        (encode_simple(lit("a.txt"), lit("text/plain"), F.unhex(lit("01"))), dict(block_height=1)),
        (encode_simple(lit("a.txt"), lit("text/plain"), F.unhex(lit("0202"))), dict(block_height=2, receipt_id="2")),
        (encode_simple(lit("b.txt"), lit("text/plain"), F.unhex(lit("03"))), dict(block_height=1, receipt_id="3")),
        (encode_simple(lit("b.txt"), None, None), dict(block_height=5, receipt_id="4")),
    ]
    latest = FS.latest_chunks(FS.decode_files(_file_blobs(spark, recs)))
    got = {r.relative_path: (r.full_size, None if r.content is None else bytes(r.content), r.mime_type)
           for r in latest.collect()}
    assert got == {"a.txt": (2, b"\x02\x02", "text/plain"), "b.txt": (0, None, None)}


def test_d19_assembly_zero_fills_short_chunks(spark):
    lit = F.lit
    a = 4
    recs = [
        (encode_partial(lit("f"), lit(0), lit(10), lit("m"), F.unhex(lit("0102")), lit(7)), dict(receipt_id="1")),
        (encode_partial(lit("f"), lit(4), lit(10), lit("m"), F.unhex(lit("03040506")), lit(7)), dict(receipt_id="2")),
        (encode_partial(lit("f"), lit(8), lit(10), lit("m"), F.unhex(lit("07")), lit(7)), dict(receipt_id="3")),
        (encode_partial(lit("g"), lit(0), lit(10), lit("m"), F.unhex(lit("01")), lit(9)), dict(receipt_id="4")),
    ]
    chunks = FS.latest_chunks(FS.decode_files(_file_blobs(spark, recs), alignment=a))
    out = {r.relative_path: r for r in FS.assemble_files(chunks, alignment=a).collect()}
    assert bytes(out["f"].content) == bytes([1, 2, 0, 0, 3, 4, 5, 6, 7, 0]) and out["f"].complete
    assert out["g"].complete is False and out["g"].content is None


@pytest.mark.parametrize("data", [b"", b"\x00", b"\x02abc", b"\x00\x05\x00\x00\x00ab",
                                  b"\x00\x01\x00\x00\x00a\x00trailing", b"\x01\xff\xff\xff\xffa",
                                  b"\x00\x01\x00\x00\x00\xff\x00"])
def test_malformed_records_are_rejected(spark, data):
    b = blobs(spark, [dict(data=data)], suffix="fastfs")
    assert [r.reason for r in FS.classify_uploads(b).collect()] == ["undecodable"]


def test_d20_bucket_span_guard(spark):
    b = blobs(spark, [dict(data="{}")])
    scan_suffix(b, "kv", 0, 10_000 * 1000)
    with pytest.raises(ValueError):
        scan_suffix(b, "kv", 0, 10_000 * 1001)


def test_value_text_and_acceptance(spark):
    """KV-1/KV-5: one whole, finite, not too deep JSON text; numbers as the shortest text that reads back."""
    nest = lambda n: '{"a":' + "[" * (n - 1) + "]" * (n - 1) + "}"
    bad = {"trailing": '{"a":1} x', "two": '{"a":1}{"b":2}', "inf": '{"a":1e400}', "surrogate": '{"a":"\\ud800"}',
           "nan": '{"a":NaN}', "deep": nest(128), "empty": "", "zero": '{"a":01}'}
    good = {"plain": ('{"a":12}', "12"), "float": ('{"a":1.0}', "1.0"), "minus": ('{"a":-0}', "-0.0"),
            "places": ('{"a":1e15}', "1000000000000000.0"), "exponent": ('{"a":1e16}', "1e16"), "small": ('{"a":1e-6}', "1e-6"),
            "unsigned": ('{"a":18446744073709551615}', "18446744073709551615"), "beyond": ('{"a":18446744073709551616}', "1.8446744073709552e19"),
            "order": ('{"a": {"z": 1.50, "b": [ ]}}', '{"b":[],"z":1.5}'), "escape": ('{"a":"\\u0041\\u001f"}', '"A\\u001f"'),
            "last": ('{"a":1,"a":2.0}', "2.0"), "deepest": (nest(127), "[" * 126 + "]" * 126)}
    rows_ = [dict(data=v, receipt_id=k) for k, v in bad.items()] + [dict(data=v, receipt_id=k) for k, (v, _) in good.items()]
    b = blobs(spark, rows_)
    assert dict(rows(K.explode_kv(b), "receipt_id", "value")) == {k: v for k, (_, v) in good.items()}
    assert dict(rows(K.kv_rejects(b), "receipt_id", "reason")) == dict.fromkeys(bad, "invalid_json")


def test_overflow_fails_instead_of_vanishing(spark):
    block = {"block": {"header": {"height": 7, "timestamp": 70}}, "shards": [{
        "shard_id": 3_000_000_000, "receipt_execution_outcomes": [{"tx_hash": None, "receipt": {
            "receipt_id": "r", "predecessor_id": "a", "receiver_id": "c", "receipt": {"Action": {"signer_id": "s", "actions": [
                {"FunctionCall": {"method_name": "__fastdata_kv", "args": "e30="}}]}}}}]}]}
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        flatten_blocks(spark.createDataFrame([block], S.BLOCK_SCHEMA)).collect()


def test_malformed_line_fails_or_is_kept(spark):
    from blocklake.session import scratch_path
    from blocklake.sources.blocks import read_blocks, split_malformed

    path = scratch_path(spark, "lines")
    line = '{"block":{"header":{"height":5,"timestamp":1}},"shards":[]}'
    spark.createDataFrame([(line,), (line[:30],), (line,)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception):
        read_blocks(spark, path).collect()
    good, bad = split_malformed(read_blocks(spark, path, on_error="keep"))
    assert good.count() == 2 and [(r.reason, r.detail) for r in bad.collect()] == [("malformed_block", line[:30])]


def test_a_block_stays_in_one_file(spark):
    from blocklake.plans.queries import event_calls
    from blocklake.plans.jobs import ingest_calls
    from blocklake.plans.store import Store
    from blocklake.session import scratch_path

    store = Store(spark, scratch_path(spark, "heights"))
    ingest_calls(store, event_calls(spark, "/root/testdata/sf0.01"), 0)
    at = store.raw("blobs").select("suffix", "block_height", F.input_file_name().alias("file")).distinct()
    assert at.groupBy("suffix", "block_height").count().where("count > 1").count() == 0
    assert at.select("file").distinct().count() > 4


def test_validate_rows(spark):
    from blocklake.sources.validate import validate_rows

    b = blobs(spark, [dict(data="{}", receipt_id="good"), dict(data="{}", receipt_id="bad", shard_id=-1)])
    good, bad = validate_rows(b, "reject")
    assert [r.receipt_id for r in good.collect()] == ["good"]
    assert [(r.receipt_id, r.reason) for r in bad.collect()] == [("bad", "negative_shard_id")]
    with pytest.raises(Exception):
        validate_rows(b, "fail")[0].collect()


def test_merge_keeps_the_table(spark):
    from blocklake.plans.jobs import index_standard
    from blocklake.plans.store import Store
    from blocklake.session import scratch_path

    b = blobs(spark, [dict(data='{"k":1,"graph/f/x.near":1}', block_height=1),
                      dict(data='{"k":2,"graph/f/x.near":null}', block_height=2, receipt_id="b"),
                      dict(data='{"j":3}', block_height=3, receipt_id="c")])
    store = Store(spark, scratch_path(spark, "compact"))
    for i, h in enumerate([2, 1, 3, 2]):  # out of order, one replay
        index_standard(store, b.where(f"block_height = {h}"), i, "kv")
    before = {n: sorted(map(tuple, store.table(n).collect())) for n in ["s_kv", "s_kv_last", "kv_edges"]}
    assert store.batch_ids("s_kv_last") == [0, 1, 2, 3]
    assert store.merge("s_kv_last") == -1 and store.batch_ids("s_kv_last") == [-1]
    store.merge("s_kv")
    store.merge("kv_edges")
    after = {n: sorted(map(tuple, store.table(n).collect())) for n in ["s_kv", "s_kv_last", "kv_edges"]}
    assert after == before
    assert dict(rows(store.table("s_kv_last"), "key", "value")) == {"k": "2", "graph/f/x.near": "null", "j": "3"}
    assert store.checkpoint_height("kv") == 3  # never moves backwards, whatever the arrival order


def test_numeric_suffix_stays_a_string(spark):
    from blocklake.plans.jobs import ingest_calls, index_standard
    from blocklake.plans.store import Store
    from blocklake.session import scratch_path
    from blocklake.streaming.registry import register_standard

    calls = spark.createDataFrame([("r1", 0, None, "s", "p", "c", 5, 5, 0, 0, "__fastdata_123", bytearray(b"x"))],
                                  S.CALLS_SCHEMA)
    store = Store(spark, scratch_path(spark, "numsuffix"))
    ingest_calls(store, calls, 0)
    register_standard("123", lambda blobs, cache: {})
    index_standard(store, store.blobs_feed(), 0, "123")
    assert [r.suffix for r in store.table("blobs").collect()] == ["123"]
    assert store.checkpoint_height("123") == 5 and store.checkpoint_height(S.UNIVERSAL_SUFFIX) == 5


def test_tables_match_declared_schemas(spark):
    b = blobs(spark, [dict(data='{"graph/follow/bob.near": 1, "k": "v"}')])
    kv = K.explode_kv(b)
    last = K.kv_last(kv)

    def shape(df):
        return [(f.name, f.dataType) for f in df.schema.fields]

    assert shape(kv) == shape(spark.createDataFrame([], S.S_KV_SCHEMA))
    assert shape(K.kv_history(kv)) == [(f.name, f.dataType) for f in S.S_KV_SCHEMA.fields]
    assert shape(last) == [(f.name, f.dataType) for f in S.S_KV_SCHEMA.fields]
    assert shape(K.kv_edges(last)) == [(f.name, f.dataType) for f in S.KV_EDGES_SCHEMA.fields]
    fb = blobs(spark, [dict(data=bytes(spark.range(1).select(
        encode_simple(F.lit("a.txt"), F.lit("text/plain"), F.unhex(F.lit("01")))).first()[0]))], suffix="fastfs")
    assert shape(FS.latest_chunks(FS.decode_files(fb))) == [(f.name, f.dataType) for f in S.FILE_CHUNKS_SCHEMA.fields]
    assert [f.name for f in to_blobs(spark.createDataFrame([], S.CALLS_SCHEMA)).schema.fields] == \
        S.BLOBS_SCHEMA.fieldNames()


def test_purge_expired_blob_deltas(spark):
    from blocklake.plans.jobs import ingest_calls
    from blocklake.plans.store import Store
    from blocklake.session import scratch_path

    calls = spark.createDataFrame([("r1", 0, None, "s", "p", "c", 5, 5, 0, 0, "__fastdata_kv", bytearray(b"{}"))],
                                  S.CALLS_SCHEMA)
    store = Store(spark, scratch_path(spark, "ttl"))
    ingest_calls(store, calls, 0)
    ingest_calls(store, calls.withColumn("receipt_id", F.lit("r2")), 1)
    # Written again as of two days before: a day of its own, dropped alone.
    old = store.raw("blobs").where("batch_id = 0").drop("batch_id").withColumn(
        "ingest_ts_us", F.col("ingest_ts_us") - 2 * 86_400_000_000).withColumn(
        "ingest_day", F.date_format(F.timestamp_micros("ingest_ts_us"), "yyyy-MM-dd")).checkpoint()
    store.write_delta("blobs", old, 2)
    newest = store.raw("blobs").agg(F.max("ingest_ts_us")).first()[0]
    assert len(store.purge_expired(newest, ttl_seconds=86_400)) == 1 and store.batch_ids("blobs") == [0, 1]
    assert store.purge_expired(newest, ttl_seconds=86_400) == []


def test_writers_get_disjoint_delta_ids(spark):
    from blocklake.plans.store import Store
    from blocklake.session import scratch_path

    store = Store(spark, scratch_path(spark, "writers"))
    ck1, ck2 = scratch_path(spark, "ck1"), scratch_path(spark, "ck2")
    a = store.allocate_writer(ck1)
    assert store.allocate_writer(ck1) == a  # a restart keeps its span
    store.write_delta("kv_accounts", spark.createDataFrame([("c", "k", "p")],
                                                           "current_account_id string, key string, "
                                                           "predecessor_id string"), a + 5)
    b = store.allocate_writer(ck2)
    assert b > a + 5


def test_key_level_reject_reasons(spark):
    b = blobs(spark, [dict(data=json.dumps({"ok": 1, "x" * 1025: 1, "": 2, "a\u0001": 3}))])
    assert sorted(r.reason for r in K.kv_rejects(b).collect()) == ["invalid_key", "invalid_key", "key_too_long"]
    assert [r.key for r in K.explode_kv(b).collect()] == ["ok"]


def test_stall_detection(spark):
    from blocklake.operators.reports import stalls
    from blocklake.plans.store import Store
    from blocklake.session import scratch_path

    store = Store(spark, scratch_path(spark, "stall"))
    store.write_meta("*", 10)
    store.write_meta("kv", 8)
    store.record_reading(1)
    store.write_meta("*", 20)  # the raw stage moved on, the kv stage did not
    store.record_reading(2)
    got = {r.suffix: (r.last_processed_block_height, r.previous_height, r.stalled)
           for r in stalls(store.readings()).collect()}
    assert got == {"*": (20, 10, False), "kv": (8, 8, True)}
    store.write_meta("kv", 20)
    store.record_reading(3)
    store.record_reading(4)  # nothing new: caught up, so idle and not stalled
    assert {r.suffix: r.stalled for r in stalls(store.readings()).collect()} == {"*": False, "kv": False}
