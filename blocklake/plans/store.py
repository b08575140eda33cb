"""Parquet table store (SNK-1..8, SRC-3/4/6/7): per-batch deltas, merged on read.

Layout: `<root>/<table>/[bucket=../]batch_id=<n>/part-*.parquet`; blobs are at
`blobs/ingest_day=../suffix=../block_height_bucket=../batch_id=..`.

* Every write replaces exactly its own `batch_id` partition (dynamic partition overwrite), so a retried
  or replayed batch is idempotent and a failed one leaves no partial table behind it.
* A versioned table's delta is the batch's argmax already (pre-aggregated before the write shuffle);
  reading a table applies the same argmax across deltas (merge on read). Because the argmax is
  order-insensitive, late or reordered batches give the same table.
* Derived tables are clustered in hash buckets of their lookup columns and sorted inside, so a lookup
  (`Store.lookup`) opens one bucket of each delta and row-group statistics prune within it.
* `blobs` is directory-partitioned by ingest day (dropped whole when expired), suffix and 10,000-block
  bucket, which range scans prune; a block is never split over files.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake import schemas as S
from blocklake.operators.latest import latest_by
from blocklake.session import checkpoint_root, configure
from blocklake.sources.validate import validate_rows


BLOBS_STORED = T.StructType(S.BLOBS_SCHEMA.fields + [
    T.StructField("ingest_ts_us", T.LongType()), T.StructField("ingest_day", T.StringType()),
    T.StructField("batch_id", T.LongType())])
BUCKETS = 16
BLOCKS_TOGETHER = 100  # neighbouring blocks that one task writes


def bucket_of(*cols: Column, buckets: int = BUCKETS) -> Column:
    """Hash bucket of a table's lookup columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(p)

    # ---------------------------------------------------------------- writes
    def write_delta(self, name: str, df: DataFrame, batch_id: int) -> None:
        """Replace table `name`'s delta for `batch_id` with `df` (idempotent on retry).

        A derived table is written in hash buckets of its lookup columns, rows sorted inside, so a lookup
        opens one bucket of each delta; AQE splits a heavy bucket over tasks and joins light ones. `blobs`
        is dealt to tasks by runs of blocks, which never splits a block over two files (STR-3).
        """
        spec = S.CATALOG[name]
        out = df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        dirs = [c for c in spec.partition_by if c != "batch_id"]
        if spec.bucket_by:
            out = out.withColumn("bucket", bucket_of(*[F.col(c) for c in spec.bucket_by])).hint("rebalance", "bucket")
            dirs = ["bucket", *dirs]
        elif dirs:
            # Dealt by hash, a run of blocks together: the batch is computed once, a block stays in one file.
            out = out.repartition(*dirs, F.expr(f"block_height div {BLOCKS_TOGETHER}"))
        sort_cols = [F.col(c).desc() if c in spec.descending else F.col(c) for c in (spec.sort_by or spec.key)]
        out = out.sortWithinPartitions(*[F.col(c) for c in dirs], *sort_cols)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*dirs, "batch_id").parquet(self.path(name)))

    def write_tables(self, tables: dict[str, DataFrame], batch_id: int, parallelism: int = 8) -> None:
        """Write a batch's tables as concurrent Spark jobs (they share cached inputs)."""
        if len(tables) <= 1 or parallelism <= 1:
            for name, df in tables.items():
                self.write_delta(name, df, batch_id)
            return
        with ThreadPoolExecutor(max_workers=min(parallelism, len(tables))) as pool:
            futures = [pool.submit(self.write_delta, name, df, batch_id) for name, df in tables.items()]
            for f in futures:
                f.result()

    def write_meta(self, suffix: str, height: int) -> None:
        """SNK-2: checkpoint row for `suffix`, written after all data of the batch.

        One directory per standard, replaced by dynamic partition overwrite: a single small job that
        never reads or rewrites other standards' checkpoints.
        """
        # Files may arrive out of block order: a checkpoint never moves backwards.
        cur = self.checkpoint_height(suffix)
        height = max(int(height), cur) if cur is not None else int(height)
        row = self.spark.createDataFrame([(suffix, height)], S.META_SCHEMA)
        (row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("suffix").parquet(self.path("meta")))

    def batch_ids(self, name: str) -> list[int]:
        """Delta ids of table `name`."""
        if not self.exists(name):
            return []
        return sorted(r[0] for r in self.raw(name).select("batch_id").distinct().collect())

    def delta(self, name: str, batch_id: int) -> DataFrame:
        """One delta of a table, by directory (empty if the batch had no rows)."""
        return self.raw(name).where(F.col("batch_id") == batch_id)

    def pending_deltas(self, suffix: str) -> list[int]:
        """Ids of the blobs deltas that standard `suffix` has not indexed."""
        have = self.raw("blobs").select("batch_id").distinct()
        if self.exists("indexed"):
            have = have.join(self._indexed().where(F.col("suffix") == suffix), "batch_id", "left_anti")
        return sorted(r[0] for r in have.collect())

    def mark_indexed(self, suffix: str, ids: list[int]) -> None:
        rows = self.spark.createDataFrame([(suffix, i) for i in ids], S.INDEXED_SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(self.path("indexed"))

    # Source files of the raw stage (STR-1/8): what has been read decides what is new, not heights.
    def ingested_files(self) -> DataFrame:
        if not self.exists("ingested"):
            return self.spark.createDataFrame([], S.INGESTED_SCHEMA)
        return self.spark.read.schema(S.INGESTED_SCHEMA).parquet(self.path("ingested"))

    def mark_ingested(self, files: DataFrame, batch_id: int) -> None:
        (files.select("path", F.lit(int(batch_id)).alias("batch_id")).coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.path("ingested")))

    # Blobs a stream has read beyond the raw stage's checkpoint (STR-2), by the delta that held them.
    def hold_blobs(self, suffix: str, delta: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self.path(f"held/{suffix}/delta={delta}"))

    def held_blobs(self, suffix: str, first: int, delta: int) -> DataFrame:
        """What the micro-batch before `delta` held (none before a writer's first)."""
        before = f"held/{suffix}/delta={delta - 1}"
        if delta <= first or not self.exists(before):
            return self.spark.createDataFrame([], S.BLOBS_SCHEMA)
        return self.spark.read.schema(S.BLOBS_SCHEMA).parquet(self.path(before))

    def _indexed(self) -> DataFrame:
        return self.spark.read.schema(S.INDEXED_SCHEMA).parquet(self.path("indexed"))

    def merge(self, name: str) -> int | None:
        """Fold every delta of a derived table into one; run it while nobody reads the table.

        The whole table is written again (`latest_table` rewrites touched buckets alone, beside its readers). The merged rows are checkpointed, written as a new delta and the folded deltas' directories removed. A
        crash in between leaves both, which the merge on read resolves to the same table; a reader that listed
        the old files fails on them and reads again.
        """
        if name == "blobs":
            raise ValueError("blobs keep their ingest day; they are purged by day, not merged")
        ids = self.batch_ids(name)
        if len(ids) <= 1:
            return ids[0] if ids else None
        target = min(ids[0], 0) - 1  # writers own the non-negative ids
        checkpoint_root(self.spark)
        self.write_delta(name, self.table(name).checkpoint(), target)
        self._delete(f"{name}/*/batch_id={{{','.join(map(str, ids))}}}")
        return target

    def _delete(self, pattern: str) -> list[str]:
        """Remove the directories that match `pattern` below the root; their names."""
        return sorted(p.rpartition("/")[2] for p in self.delete_where(pattern, lambda _: True))

    def delete_where(self, pattern: str, doomed: Callable[[str], bool]) -> list[str]:
        """Remove the directories that match `pattern` below the root and whose path is `doomed`; their paths."""
        jvm = self.spark.sparkContext._jvm
        glob = jvm.org.apache.hadoop.fs.Path(self.path(pattern))
        fs = glob.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        gone = [st.getPath() for st in fs.globStatus(glob) or [] if st.isDirectory() and doomed(st.getPath().toString())]
        for p in gone:
            fs.delete(p, True)
        return sorted(p.toString() for p in gone)

    def purge_expired(self, now_us: int, ttl_seconds: int = S.BLOBS_TTL_SECONDS) -> list[str]:
        """SNK-3, physical side: drop the ingest days whose last moment is past the time-to-live.

        Rows never leave their ingest day, so this holds whatever was rewritten since; rows of a day that is
        not yet wholly expired stay hidden by `expire`.
        """
        last = dt.datetime.fromtimestamp((now_us - ttl_seconds * 1_000_000) / 1e6, dt.timezone.utc).date()
        if not self.exists("blobs"):
            return []
        days = [r[0] for r in self.raw("blobs").select("ingest_day").distinct().collect()]
        old = sorted(d for d in days if dt.date.fromisoformat(d) < last)
        return [x for d in old for x in self._delete(f"blobs/ingest_day={d}")]

    def allocate_writer(self, checkpoint_location: str) -> int:
        """First delta id of a streaming writer: the nanosecond it first started, above all earlier ids.

        Kept in a small file inside the stream's checkpoint location, so a restarted query goes on with its
        ids (its replayed micro-batches overwrite their own deltas) and a new query never reuses another's.
        """
        jvm = self.spark.sparkContext._jvm
        marker = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_location.rstrip('/')}/_blocklake_writer")
        fs = marker.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(marker):
            stream = fs.open(marker)
            try:
                return int(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip())
            finally:
                stream.close()
        base = time.time_ns()
        out = fs.create(marker, True)
        try:
            out.write(bytearray(str(base).encode("utf-8")))
        finally:
            out.close()
        return base

    # ----------------------------------------------------------------- reads
    def raw(self, name: str) -> DataFrame:
        """All deltas of `name` as stored, read with their declared schema: nothing is inferred. Only a table that a
        registered standard adds without a schema is read as its files say."""
        schema = BLOBS_STORED if name == "blobs" else S.TABLE_SCHEMAS.get(name)
        if schema is None:
            return self.spark.read.parquet(self.path(name))
        if name != "blobs":
            schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(schema).parquet(self.path(name))

    def _merged(self, name: str, raw: DataFrame) -> DataFrame:
        spec = S.CATALOG[name]
        df = raw.drop("batch_id", "bucket")
        # Counted on the very files this read listed, so the two cannot disagree.
        deltas = {p for f in raw.inputFiles() for p in f.split("/") if p.startswith("batch_id=")}
        if spec.unique_per_delta and len(deltas) <= 1:
            # One delta (a single batch, or a merged table) is unique on its key already: no shuffle needed.
            return df
        if not spec.version:
            return df.dropDuplicates(list(spec.key))
        return latest_by(df, spec.key, spec.version)

    def table(self, name: str) -> DataFrame:
        """Table `name` with its semantics applied across all deltas (merge on read)."""
        return self._merged(name, self.raw(name))

    def lookup(self, name: str, **equal: object) -> DataFrame:
        """The rows of `name` with these values: one bucket of each delta is opened, then merged."""
        spec = S.CATALOG[name]
        raw = self.raw(name)
        if spec.bucket_by and set(spec.bucket_by) <= set(equal):
            raw = raw.where(F.col("bucket") == bucket_of(*[F.lit(equal[c]) for c in spec.bucket_by]))
        for c, v in equal.items():
            if c in spec.key:
                raw = raw.where(F.col(c) == F.lit(v))
        df = self._merged(name, raw)
        for c, v in equal.items():
            df = df.where(F.col(c) == F.lit(v))
        return df.where(~F.col("is_deletion")).drop("is_deletion") if name == "kv_edges" else df

    def read(self, name: str) -> DataFrame:
        """Table `name` as users query it: live edges only (tombstones hidden), the account registry
        with its published columns, every other table as merged."""
        from blocklake.operators import kv as K

        if name == "kv_edges":
            return K.live_edges(self.table(name))
        if name == "all_accounts":
            return K.all_accounts_view(self.table(name))
        return self.table(name)

    def blobs_feed(self, deltas: list[int] | None = None) -> DataFrame:
        """Blobs as written (all, or of some deltas), without the read-side dedup: what the stages consume.

        Every derived table is idempotent per key and version, so a replayed blob changes nothing and
        the stages need not shuffle payloads to deduplicate them first. Rows are checked on the way (SRC-8).
        """
        raw = self.raw("blobs")
        if deltas is not None:
            raw = raw.where(F.col("batch_id").isin(deltas))
        return validate_rows(raw.select(*S.BLOBS_SCHEMA.fieldNames()))[0]

    def record_reading(self, now_us: int) -> None:
        """Append the current checkpoints, stamped `now_us`, to `meta_readings` (for stall checks)."""
        snap = self.meta().withColumn("reading_ts_us", F.lit(int(now_us)).cast("long"))
        snap.coalesce(1).write.mode("append").parquet(self.path("meta_readings"))

    def readings(self) -> DataFrame:
        return self.spark.read.schema(S.READINGS_SCHEMA).parquet(self.path("meta_readings"))

    def _checkpoints(self) -> DataFrame:
        return self.spark.read.schema(S.META_SCHEMA).parquet(self.path("meta"))

    def meta(self) -> DataFrame:
        """Checkpoints of the raw stage and the standards (not the store's start position)."""
        return self._checkpoints().where(~F.col("suffix").startswith("*") | (F.col("suffix") == S.UNIVERSAL_SUFFIX))

    def checkpoint_height(self, suffix: str) -> int | None:
        """SRC-6: last processed height of `suffix` (None when absent; negative is an error)."""
        if not self.exists("meta"):
            return None
        rows = self._checkpoints().where(F.col("suffix") == suffix).limit(1).collect()
        if not rows:
            return None
        h = rows[0]["last_processed_block_height"]
        if h < 0:
            raise ValueError(f"negative checkpoint {h} for suffix {suffix!r}")
        return h


def scan_suffix(blobs: DataFrame, suffix: str, lo: int, hi: int,
                max_bucket_span: int = S.MAX_BUCKET_SPAN) -> DataFrame:
    """SRC-3/4: blobs of `suffix` with lo <= block_height <= hi, in log order.

    The bucket range is derived from the height range so a directory-partitioned table is pruned to
    the touched buckets (Catalyst does not derive it from the height predicate alone).
    """
    lo_b, hi_b = lo // S.BLOCK_HEIGHT_BUCKET_SIZE, hi // S.BLOCK_HEIGHT_BUCKET_SIZE
    if hi_b - lo_b > max_bucket_span:
        raise ValueError(f"heights {lo}..{hi} span {hi_b - lo_b} buckets; at most {max_bucket_span} are scanned at once")
    return (
        blobs.where((F.col("suffix") == suffix) & F.col("block_height_bucket").between(lo_b, hi_b)
                    & F.col("block_height").between(lo, hi))
        .orderBy("block_height", "shard_id", "receipt_index", "action_index", "receipt_id")
    )


def expire(df: DataFrame, now_us: int, ttl_seconds: int = S.BLOBS_TTL_SECONDS,
           ingest_col: str = "ingest_ts_us") -> DataFrame:
    """SNK-3: rows still alive at `now_us` (microseconds) under a time-to-live counted from ingest."""
    return df.where(F.col(ingest_col) > F.lit(now_us - ttl_seconds * 1_000_000))
