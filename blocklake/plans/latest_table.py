"""A derived table kept merged (SNK-7): an upsert rewrites the hash buckets its rows change, and no others.

Layout: `<root>/<table>/bucket=<b>/version=<v>`, one folder per bucket and version, and `<root>/<table>_head/version=<v>`,
one row per commit that names each bucket's newest version. An upsert reads the touched buckets at the head,
takes the newest row of every key (KV-7's argmax), and writes the result as a new version of those buckets by dynamic
partition overwrite; then it commits the head. Files that a reader has listed stay: it sees the snapshot it opened
until `vacuum` drops versions that no kept head names. A crash before the commit leaves folders that no head
names, and the retry writes them again; a replayed batch changes no row and writes nothing. One writer a table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake import schemas as S
from blocklake.operators.latest import latest_by
from blocklake.plans.bucketed import buckets_for
from blocklake.plans.store import Store, bucket_of

ROWS_PER_BUCKET = 1_000_000
HEAD_SCHEMA = T.StructType([T.StructField("versions", T.ArrayType(T.LongType())), T.StructField("version", T.LongType())])


@dataclass(frozen=True)
class Head:
    """A commit: its number and, per bucket, the version that holds it (0: the bucket is empty)."""

    version: int
    versions: tuple[int, ...]


class LatestTable:
    def __init__(self, spark: SparkSession, root: str, name: str, rows_per_bucket: int = ROWS_PER_BUCKET):
        self.store = Store(spark, root)
        self.spark, self.name, self.spec = spark, name, S.CATALOG[name]
        self.schema = S.TABLE_SCHEMAS[name]
        self.rows_per_bucket = rows_per_bucket

    def head(self) -> Head | None:
        """The newest commit (None before the first)."""
        if not self.store.exists(f"{self.name}_head"):
            return None
        heads = self.spark.read.schema(HEAD_SCHEMA).parquet(self.store.path(f"{self.name}_head"))
        row = heads.orderBy(F.col("version").desc()).limit(1).collect()
        return Head(row[0]["version"], tuple(row[0]["versions"])) if row else None

    def _read(self, head: Head | None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the table (or of some buckets) at a commit."""
        held = [b for b in (range(len(head.versions)) if buckets is None else buckets) if head.versions[b]] if head else []
        if not held:
            return self.spark.createDataFrame([], self.schema)
        base = self.store.path(self.name)
        paths = [f"{base}/bucket={b}/version={head.versions[b]}" for b in held]
        stored = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("version", T.LongType())])
        return self.spark.read.schema(stored).option("basePath", base).parquet(*paths).drop("bucket", "version")

    def snapshot(self) -> DataFrame:
        """The table at its newest commit: unique on its key, no merge on read; later upserts do not change it."""
        return self._read(self.head())

    def lookup(self, **equal: object) -> DataFrame:
        """Rows with these values; equality on all bucket columns opens one bucket."""
        head, by = self.head(), self.spec.bucket_by
        buckets = None
        if head and set(by) <= set(equal):
            at = bucket_of(*[F.lit(equal[c]) for c in by], buckets=len(head.versions))
            buckets = [self.spark.sql("SELECT 1").select(at).first()[0]]
        df = self._read(head, buckets)
        for c, v in equal.items():
            df = df.where(F.col(c) == F.lit(v))
        return df

    def _bucketed(self, df: DataFrame, n: int) -> DataFrame:
        return df.withColumn("bucket", bucket_of(*[F.col(c) for c in self.spec.bucket_by], buckets=n))

    def _newest(self, df: DataFrame) -> DataFrame:
        keys = [*self.spec.key]
        return latest_by(df, keys, self.spec.version) if self.spec.version else df.dropDuplicates(keys)

    def changes(self, rows: DataFrame, current: DataFrame) -> DataFrame:
        """The rows that are new to `current`, or newer than what it holds under their key."""
        keys, version = [*self.spec.key], [*self.spec.version]
        have = current.select(*[F.col(k).alias(f"_{k}") for k in keys],
                              F.struct(*[F.col(c).alias(c) for c in version or keys[:1]]).alias("_version"))
        same = [F.col(k) == F.col(f"_{k}") for k in keys]
        if version:
            same.append(F.col("_version") >= F.struct(*[F.col(c).alias(c) for c in version]))
        on = same[0]
        for s in same[1:]:
            on = on & s
        return rows.join(have, on, "left_anti")

    def upsert(self, rows: DataFrame) -> list[int]:
        """Merge `rows` (any order, any number a key); returns the rewritten buckets.

        The bucket count is set by the first batch's size; `resize` changes it later.
        """
        head = self.head()
        batch = self._newest(rows.select(*self.schema.names)).persist(StorageLevel.MEMORY_AND_DISK)
        changed = None
        try:
            n = len(head.versions) if head else buckets_for(batch.count(), self.rows_per_bucket, 16)
            batch_in = self._bucketed(batch, n)
            near = [r[0] for r in batch_in.select("bucket").distinct().collect()]  # at most one number a bucket
            current = self._read(head, sorted(near))
            changed = self.changes(batch_in, current).persist(StorageLevel.MEMORY_AND_DISK)
            touched = sorted(r[0] for r in changed.select("bucket").distinct().collect())
            if touched:
                merged = self._newest(self._read(head, touched).unionByName(changed.drop("bucket")))
                self._commit(merged, n, touched, head)
            return touched
        finally:
            batch.unpersist()
            if changed is not None:
                changed.unpersist()

    def resize(self, buckets: int) -> None:
        """Write the whole table again in another number of buckets (when buckets have outgrown `rows_per_bucket`)."""
        head = self.head()
        if head:
            rows = self._read(head)
            full = [r[0] for r in self._bucketed(rows, buckets).select("bucket").distinct().collect()]
            self._commit(rows, buckets, full, Head(head.version, (0,) * buckets))

    def _commit(self, rows: DataFrame, n: int, touched: list[int], head: Head | None) -> None:
        version = head.version + 1 if head else 1
        sort = [F.col(c).desc() if c in self.spec.descending else F.col(c) for c in (self.spec.sort_by or self.spec.key)]
        out = self._bucketed(rows, n).hint("rebalance", "bucket").sortWithinPartitions("bucket", *sort)
        (out.withColumn("version", F.lit(version).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(self.store.path(self.name)))
        versions = list(head.versions) if head else [0] * n
        for b in touched:
            versions[b] = version
        row = self.spark.createDataFrame([(versions, version)], HEAD_SCHEMA)
        (row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("version").parquet(self.store.path(f"{self.name}_head")))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Drop folders that none of the newest `keep` commits names, and older commits; readers of those must reopen."""
        heads = self.spark.read.schema(HEAD_SCHEMA).parquet(self.store.path(f"{self.name}_head"))
        rows = heads.orderBy(F.col("version").desc()).limit(keep).collect()
        named = {(b, v) for r in rows for b, v in enumerate(r["versions"]) if v}
        oldest = min(r["version"] for r in rows)
        gone = self.store.delete_where(f"{self.name}/bucket=*/version=*", lambda p: _place(p) not in named)
        return gone + self.store.delete_where(f"{self.name}_head/version=*", lambda p: int(p.rpartition("=")[2]) < oldest)


def _place(path: str) -> tuple[int, int]:
    bucket, version = path.rstrip("/").split("/")[-2:]
    return int(bucket.partition("=")[2]), int(version.partition("=")[2])
