"""Serving copies of derived tables in Spark's own bucketed layout (SNK-4), and their access path (SRC-7).

A published table is bucketed by `bucket_key`, a hash of its partition key and a salt, into as many buckets as its size
asks for, in rows and in bytes, and sorted by its clustering columns inside. The salt is 0 for an ordinary account. An
account with more rows than a bucket should hold, or more than a quarter of its bytes, is dealt over several, by the
rest of its key; those accounts, at most five for each bucket, are listed beside the table. A lookup by partition key
is then a filter on one or a few bucket keys: Spark opens those buckets alone (SelectedBucketsCount in the plan), and
row groups sorted by the clustering columns prune prefixes and ranges inside.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.plans.bucketed import buckets_for, in_buckets, write_bucketed

ROWS_PER_BUCKET = 1_000_000
# One task writes a bucket, and rows differ in size: a file chunk holds up to 1 MiB.
BYTES_PER_BUCKET = 128 << 20
# A heavy account's bucket keys hold this part of a bucket's bytes: small ones fill the buckets evenly, wherever hashes fall.
KEYS_A_BUCKET = 4


def _row_bytes(df: DataFrame):
    """About the bytes of a row: those of its texts and binaries, and eight for any other column."""
    wide = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    n = F.lit(8 * (len(df.columns) - len(wide))).cast("long")
    for c in wide:
        n = n + F.coalesce(F.octet_length(c), F.lit(0))
    return n


def _bucket_key(columns, salt):
    return F.xxhash64(*columns, salt)


@dataclass(frozen=True)
class Published:
    """A table as published: `rows` with `bucket_key`, `hot` with the accounts dealt over several buckets."""

    spec: S.TableSpec
    rows: DataFrame
    hot: DataFrame
    buckets: int

    def _keys(self, equal: dict[str, object]) -> list[int]:
        """The bucket keys of one partition key."""
        mine = self.hot
        for c in self.spec.bucket_by:
            mine = mine.where(F.col(c) == F.lit(equal[c]))
        found = mine.select("salts").collect()  # at most one row
        salts = found[0][0] if found else 1
        one = self.rows.sparkSession.sql("SELECT 1")
        values = [F.lit(equal[c]) for c in self.spec.bucket_by]
        each = one.select(F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        return [r[0] for r in each.select(_bucket_key(values, F.col("salt"))).collect()]

    def find(self, starts_with: str | None = None, between: tuple | None = None, after: object = None,
             limit: int | None = None, **equal: object) -> DataFrame:
        """Rows by partition key and clustering prefix, in stored order.

        `equal` names the partition key and any number of clustering columns after it, without a gap. The next
        clustering column may be narrowed by a prefix, by an inclusive range (None: open) or to values `after` one;
        the rest of the clustering columns order the result, as the catalog says. A `limit` keeps the first rows of
        that order; each task sorts out its own first.
        """
        given = [c for c in self.spec.key if c in equal]
        if set(self.spec.bucket_by) - set(equal) or set(given) != set(equal) or given != [*self.spec.key[: len(given)]]:
            raise ValueError(f"{self.spec.name} is found by {self.spec.bucket_by} and what follows of {self.spec.key}")
        df = self.rows.where(in_buckets("bucket_key", self._keys(equal))).drop("bucket_key")
        for c, v in equal.items():
            df = df.where(F.col(c) == F.lit(v))
        rest = [*self.spec.key[len(given):]]
        if rest:
            nxt = F.col(rest[0])
            low, high = between or (None, None)
            for bound, cond in [(starts_with, lambda v: nxt.startswith(v)), (low, lambda v: nxt >= F.lit(v)),
                                (high, lambda v: nxt <= F.lit(v)), (after, lambda v: nxt > F.lit(v))]:
                if bound is not None:
                    df = df.where(cond(bound))
        elif starts_with is not None or between is not None or after is not None:
            raise ValueError("every clustering column is given already")
        df = df.orderBy(*[F.col(c).desc() if c in self.spec.descending else F.col(c) for c in rest]) if rest else df
        return df if limit is None else df.limit(limit)


def publish(df: DataFrame, name: str, path: str, rows_per_bucket: int = ROWS_PER_BUCKET,
            bytes_per_bucket: int = BYTES_PER_BUCKET) -> Published:
    """Write table `name` (unique on its key, as merged) to `path` in its bucketed layout."""
    spec = S.CATALOG[name]
    by = [*spec.bucket_by]
    spread = [c for c in spec.key if c not in by]
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b"))
    sizes.write.mode("overwrite").parquet(f"{path}-sizes")
    sizes = df.sparkSession.read.schema(sizes.schema).parquet(f"{path}-sizes")
    rows_in, bytes_in = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    key_bytes = max(bytes_per_bucket // KEYS_A_BUCKET, 1)
    # Accounts above a bucket's share: at most rows_in / rows_per_bucket + bytes_in / key_bytes of them. None where
    # nothing is left to deal by.
    hot = sizes.where(F.lit(bool(spread)) & ((F.col("n") > rows_per_bucket) | (F.col("b") > key_bytes))).select(
        *by, F.greatest(F.ceil(F.col("n") / rows_per_bucket), F.ceil(F.col("b") / key_bytes)).cast("int").alias("salts"))
    hot.write.mode("overwrite").parquet(f"{path}-hot")
    hot = df.sparkSession.read.schema(hot.schema).parquet(f"{path}-hot")
    salts = F.coalesce("salts", F.lit(1))
    salt = F.pmod(F.xxhash64(*spread), salts).cast("int") if spread else F.lit(0)
    rows = df.join(F.broadcast(hot), by, "left").withColumn("bucket_key", _bucket_key([F.col(c) for c in by], salt)).select(
        "bucket_key", *df.columns)
    n = max(buckets_for(rows_in, rows_per_bucket), buckets_for(bytes_in, bytes_per_bucket))
    return Published(spec, write_bucketed(rows, path, "bucket_key", n, [*spec.sort_by]), hot, n)
