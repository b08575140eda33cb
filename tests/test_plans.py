"""Plan shape: the properties the design relies on at scale, asserted on the physical plans."""

import pytest
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.operators import kv as K
from blocklake.plans import jobs
from blocklake.plans import lookups as L
from blocklake.plans import queries as Q
from blocklake.plans.store import Store, scan_suffix
from blocklake.session import scratch_path

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def store(spark):
    st = Store(spark, scratch_path(spark, "plans"))
    jobs.ingest_calls(st, Q.event_calls(spark, SF), 0)
    jobs.index_standard(st, st.blobs_feed(), 0, S.KV_SUFFIX)
    return st


def test_range_scan_prunes_bucket_directories(store):
    p = plan(scan_suffix(store.table("blobs"), "kv", Q.SCAN_LO, Q.SCAN_HI))
    assert "PartitionFilters: [" in p and "(suffix" in p and "block_height_bucket" in p.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(block_height" in p


def test_point_lookup_pushes_key_into_scan(store):
    p = plan(L.get_latest(store.table("s_kv_last"), Q.PRED, Q.CONTRACT, "click"))
    pushed = p.split("PushedFilters: [")[1].split("]")[0]
    for col in ["predecessor_id", "current_account_id", "key"]:
        assert f"EqualTo({col}," in pushed


def test_prefix_lookup_pushes_starts_with(store):
    p = plan(L.key_prefix(store.table("s_kv_last"), Q.PRED, Q.CONTRACT, "graph/"))
    assert "StringStartsWith(key,graph/)" in p


def test_latest_is_one_exchange_with_partial_aggregation(spark):
    p = plan(K.kv_last(Q.event_kv(spark, SF)))
    assert "partial_max_by" in p
    assert "Broadcast" not in p
    exchanges = [line for line in p.splitlines() if "Arguments: hashpartitioning(" in line]
    assert len(exchanges) == 1 and "predecessor_id" in exchanges[0] and "key" in exchanges[0]


def test_json_parsed_once(spark):
    p = plan(K.explode_kv(Q.event_blobs(spark, SF)))
    body = p.split("\n\n", 1)[1]  # node details, not the tree outline
    assert body.count("parseJson") == 1


def test_single_delta_table_reads_without_shuffle(store):
    # `store` holds one KV batch: every derived table has exactly one delta.
    assert "Exchange" not in plan(store.table("s_kv_last"))
    assert "Exchange" in plan(store.table("blobs"))  # raw deltas are not unique per delta


def test_account_filter_sinks_below_the_parse(spark):
    """Only the parsed value is fenced: the account filter of a lookup reaches the Parquet scan."""
    blobs = spark.read.schema(S.BLOBS_SCHEMA).parquet(_blob_files(spark))
    df = L.get_latest(K.kv_last(K.explode_kv(blobs)), Q.PRED, Q.CONTRACT, "click")
    scan = plan(df).split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(predecessor_id," in scan and "EqualTo(current_account_id," in scan


def test_account_filter_sinks_below_the_decode(spark):
    from blocklake.operators import files as FS

    blobs = spark.read.schema(S.BLOBS_SCHEMA).parquet(_blob_files(spark))
    df = L.list_files(FS.latest_chunks(FS.decode_files(blobs)), "a", "b")
    assert "EqualTo(predecessor_id,a)" in plan(df)


def _blob_files(spark):
    path = scratch_path(spark, "blob-files")
    Q.event_blobs(spark, SF).write.parquet(path)
    return path


def test_lookup_opens_one_bucket(store):
    for name, equal in {"mv_kv_key": dict(key="view"), "mv_kv_cur_key": dict(current_account_id="app0.near"),
                        "kv_reverse": dict(current_account_id=Q.CONTRACT, key="click"),
                        "s_kv_last": dict(predecessor_id=Q.PRED, current_account_id=Q.CONTRACT),
                        "kv_edges": dict(edge_type="graph/follow", target="user3.near")}.items():
        df = store.lookup(name, **equal)
        filters = plan(df).split("PartitionFilters: [")[1].split("]")[0]
        assert "bucket" in filters, name
        read = df.select(F.input_file_name()).distinct().collect() if "Exchange" not in plan(df) else []
        assert len({r[0].split("bucket=")[1].split("/")[0] for r in read}) <= 1


def test_chunks_are_no_aggregate_state(spark):
    """Content goes through one exchange; one row per key and task, by a limit inside a sort."""
    from blocklake.operators import files as FS

    p = plan(FS.latest_chunks(spark.createDataFrame([], S.FILE_CHUNKS_SCHEMA).repartition(2)))
    assert "Aggregate" not in p and "WindowGroupLimit" in p and p.count("Arguments: hashpartitioning(") == 1


def test_assembly_has_no_growing_concat(spark):
    from blocklake.operators import files as FS

    chunks = spark.createDataFrame([], S.FILE_CHUNKS_SCHEMA)
    p = plan(FS.assemble_files(chunks))
    assert "listagg" in p and "aggregate(" not in p
