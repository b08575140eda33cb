"""Tables kept merged by touched buckets (SNK-7) and published in Spark's bucketed layout (SNK-4, SRC-7)."""

import glob
import random
import re

import pytest
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.operators import kv as K
from blocklake.plans.bucketed import bucket_files
from blocklake.plans.latest_table import LatestTable
from blocklake.plans.published import publish
from blocklake.session import scratch_path
from helpers import BASE


def kv_rows(spark, rows):
    """(pred, contract, key, height, order, value) as `s_kv_last` rows."""
    full = [tuple({**BASE, "predecessor_id": p, "current_account_id": c, "block_height": h, "order_id": o, "key": k,
                   "value": v}[f] for f in S.S_KV_SCHEMA.names) for p, c, k, h, o, v in rows]
    return spark.createDataFrame(full, S.S_KV_SCHEMA)


def shown(df):
    cols = ["predecessor_id", "current_account_id", "key", "block_height", "order_id", "value"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def newest(rows):
    best = {}
    for r in rows:
        if r[:3] not in best or r[3:5] > best[r[:3]][3:5]:
            best[r[:3]] = r
    return sorted(best.values())


def folders(table):
    return set(glob.glob(f"{table.store.path(table.name).removeprefix('file:')}/bucket=*/version=*"))


@pytest.fixture
def table(spark):
    t = LatestTable(spark, scratch_path(spark, "latest"), "s_kv_last")
    t.upsert(kv_rows(spark, [(f"p{i}", "c", f"k{i}", 5, 0, "v") for i in range(200)]))
    return t


def test_batch_on_two_keys_rewrites_at_most_two_buckets(spark, table):
    before = folders(table)
    touched = table.upsert(kv_rows(spark, [("p1", "c", "k1", 6, 0, "new"), ("p2", "c", "k2", 6, 0, "new")]))
    added = folders(table) - before
    assert len(before) == 16 and 1 <= len(added) <= 2 and len(touched) == len(added)
    assert {int(re.search(r"bucket=(\d+)", f).group(1)) for f in added} == set(touched)
    got = {r[0]: r[5] for r in shown(table.snapshot())}
    assert len(got) == 200 and got["p1"] == got["p2"] == "new" and got["p3"] == "v"


def test_old_and_replayed_rows_write_nothing(spark, table):
    before = folders(table)
    assert table.upsert(kv_rows(spark, [("p1", "c", "k1", 4, 9, "old"), ("p2", "c", "k2", 5, 0, "v")])) == []
    assert table.upsert(kv_rows(spark, [])) == []
    assert folders(table) == before and table.head().version == 1


def test_reader_keeps_its_snapshot_until_vacuum(spark, table):
    opened = table.snapshot()
    for h in (6, 7, 8):
        table.upsert(kv_rows(spark, [("p1", "c", "k1", h, 0, f"at {h}")]))
    assert {r[5] for r in shown(opened)} == {"v"}
    assert [r[5] for r in shown(table.lookup(predecessor_id="p1", current_account_id="c"))] == ["at 8"]
    now = shown(table.snapshot())
    gone = table.vacuum(keep=1)
    assert len([g for g in gone if "_head" not in g]) == 3 and shown(table.snapshot()) == now
    table.upsert(kv_rows(spark, [("p1", "c", "k1", 9, 0, "at 9")]))
    assert table.head().version == 5


def test_crash_before_the_commit_is_invisible_and_retried(spark, table, monkeypatch):
    before = shown(table.snapshot())
    batch = kv_rows(spark, [("p1", "c", "k1", 6, 0, "new"), ("p9", "c", "k9", 6, 0, "new")])
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            table.upsert(batch)
    assert shown(table.snapshot()) == before and table.head().version == 1
    table.upsert(batch)
    assert {r[5] for r in shown(table.snapshot()) if r[0] in ("p1", "p9")} == {"new"}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_equal_the_argmax_of_all_rows(spark, seed):
    rng = random.Random(seed)
    t = LatestTable(spark, scratch_path(spark, "latest"), "s_kv_last")
    every = []
    for _ in range(4):
        batch = [(f"p{rng.randint(0, 5)}", f"c{rng.randint(0, 1)}", f"k{rng.randint(0, 6)}", rng.randint(1, 9), rng.randint(0, 9), str(i))
                 for i in range(30)]
        batch = [b for b in batch if b[:5] not in {e[:5] for e in every}]
        every += {b[:5]: b for b in batch}.values()
        t.upsert(kv_rows(spark, list({b[:5]: b for b in batch}.values())))
    assert shown(t.snapshot()) == newest(every)
    t.resize(40)
    assert shown(t.snapshot()) == newest(every) and len(t.head().versions) == 40
    t.upsert(kv_rows(spark, [("p0", "c0", "k0", 99, 0, "last")]))
    assert ("p0", "c0", "k0", 99, 0, "last") in shown(t.snapshot())


def test_second_batch_of_known_accounts_writes_no_row(spark):
    from blocklake.plans.jobs import index_standard
    from blocklake.plans.store import Store
    from helpers import blobs

    store = Store(spark, scratch_path(spark, "known"))
    b = blobs(spark, [dict(data='{"a":1,"b":2}'), dict(data='{"a":3}', block_height=101)])
    index_standard(store, b, 0, S.KV_SUFFIX)
    index_standard(store, b.withColumn("block_height", F.col("block_height") + 50), 1, S.KV_SUFFIX)
    assert store.raw("kv_accounts").groupBy("batch_id").count().collect() == [(0, 2)]
    index_standard(store, b, 0, S.KV_SUFFIX)  # the first batch once more: its rows stay
    assert store.table("kv_accounts").count() == 2
    known = store.table("kv_accounts")
    assert K.unknown_accounts(known.limit(0), known).count() == 0


# ------------------------------------------------------------------ published tables
@pytest.fixture(scope="module")
def served(spark):
    """One account with 3,000 of 4,000 rows, the others rare."""
    rows = [("hot", "c", f"k{i:04d}", i, 0, "v") for i in range(3000)]
    rows += [(f"p{i % 100}", "c", f"k{i:04d}", i, 0, "v") for i in range(1000)]
    df = kv_rows(spark, rows)
    return publish(df, "s_kv_last", scratch_path(spark, "served"), rows_per_bucket=250), df


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture
def bucketed_scans(spark):
    """Plans name the buckets they select only in a bucketed scan, which Spark leaves where nothing else gains by it."""
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_published_lookups_open_bounded_files(spark, served):
    pub, _ = served
    assert len(bucket_files(spark, pub.find(predecessor_id="p7", current_account_id="c"))) == 1
    assert len(bucket_files(spark, pub.find(predecessor_id="hot", current_account_id="c"))) <= 12


def test_published_lookups_select_buckets(spark, served, bucketed_scans):
    pub, df = served
    assert pub.buckets == 16 and [tuple(r) for r in pub.hot.collect()] == [("hot", "c", 12)]
    rare = pub.find(predecessor_id="p7", current_account_id="c")
    assert "SelectedBucketsCount: 1 out of 16" in plan(rare)
    hot = pub.find(predecessor_id="hot", current_account_id="c")
    opened = int(re.search(r"SelectedBucketsCount: (\d+) out of 16", plan(hot)).group(1))
    assert opened <= 12 and hot.count() == 3000
    sizes = pub.rows.groupBy("bucket_key").count().agg(F.max("count")).first()[0]
    assert sizes < 400  # no bucket key holds a hot account whole
    assert shown(rare) == shown(df.where("predecessor_id = 'p7'"))


def test_published_access_paths(spark, served):
    pub, df = served
    found = pub.find(predecessor_id="hot", current_account_id="c", starts_with="k001")
    assert [r["key"] for r in found.collect()] == [f"k{i:04d}" for i in range(10, 20)]
    assert "StringStartsWith(key,k001)" in plan(found)
    one = pub.find(predecessor_id="hot", current_account_id="c", key="k0007")
    assert [r["block_height"] for r in one.collect()] == [7]
    page = pub.find(predecessor_id="hot", current_account_id="c", after="k0100", limit=3)
    assert [r["key"] for r in page.collect()] == ["k0101", "k0102", "k0103"] and "TakeOrdered" in plan(page)
    span = pub.find(predecessor_id="hot", current_account_id="c", between=("k0005", "k0007"))
    assert span.count() == 3
    assert pub.find(predecessor_id="nobody", current_account_id="c").count() == 0
    with pytest.raises(ValueError):
        pub.find(predecessor_id="hot")
    with pytest.raises(ValueError):
        pub.find(predecessor_id="hot", current_account_id="c", block_height=3)


def test_published_descending_order_and_lone_key(spark):
    by_block = spark.createDataFrame([("p", "c", h, k, "v", 0, 0, "r", None) for h in (1, 2, 3) for k in "ba"],
                                     S.TABLE_SCHEMAS["s_kv_by_block"])
    pub = publish(by_block, "s_kv_by_block", scratch_path(spark, "served"))
    got = pub.find(predecessor_id="p", current_account_id="c", between=(2, None)).select("block_height", "key").collect()
    assert [tuple(r) for r in got] == [(3, "a"), (3, "b"), (2, "a"), (2, "b")]
    accounts = spark.createDataFrame([(f"p{i}", 1, 1, 1) for i in range(50)], S.TABLE_SCHEMAS["all_accounts"])
    pub = publish(accounts, "all_accounts", scratch_path(spark, "served"), rows_per_bucket=10)
    assert pub.find(predecessor_id="p7").count() == 1
    empty = publish(accounts.limit(0), "all_accounts", scratch_path(spark, "served"))
    assert empty.find(predecessor_id="p7").count() == 0


def test_published_chunks_are_dealt_by_bytes(spark):
    """320 chunks of 16 KiB, 300 of them of one account: too few rows for a second bucket, too many bytes for one."""
    n, size = 320, 16 << 10
    owner = F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 5))
    chunks = spark.range(n).select(*[{
        "predecessor_id": owner, "relative_path": F.format_string("f%03d", F.col("id").cast("int")), "offset": F.lit(0),
        "content": F.encode(F.repeat(F.lit("x"), size), "UTF-8"), "mime_type": F.lit("text/plain"), "full_size": F.lit(size),
        "nonce": F.lit(0)}.get(f.name, F.lit(BASE.get(f.name))).cast(f.dataType).alias(f.name) for f in S.FILE_CHUNKS_SCHEMA])
    pub = publish(chunks, S.FILE_CHUNKS_TABLE, scratch_path(spark, "served"), bytes_per_bucket=128 * size)
    assert pub.buckets == 3 and [r[0] for r in pub.hot.select("predecessor_id").collect()] == ["hot"]
    a_key = pub.rows.groupBy("bucket_key").agg(F.sum(F.octet_length("content")).alias("b")).agg(F.max("b")).first()[0]
    assert a_key < 64 * size  # 32 chunks on average: no bucket key holds the account whole
    hot = pub.find(predecessor_id="hot", current_account_id="app.near").select("relative_path", F.octet_length("content"))
    assert [tuple(r) for r in hot.collect()] == [(f"f{i:03d}", size) for i in range(300)]
    one = pub.find(predecessor_id="hot", current_account_id="app.near", relative_path="f007", nonce=0)
    assert [r["offset"] for r in one.collect()] == [0]
    assert pub.find(predecessor_id="p0", current_account_id="app.near").count() == 4
