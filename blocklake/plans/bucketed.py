"""Spark's own bucketed tables: rows hashed to a fixed number of buckets and sorted inside them.

A join or aggregate on the bucket column reads such a table without an exchange, and an equality on it opens one
bucket. The table is external: its files stay at `path`, the catalog only knows their layout.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BUCKETS = 100_000  # Spark's own limit


def buckets_for(rows: int, rows_per_bucket: int, least: int = 1) -> int:
    """Bucket count that keeps a bucket at about `rows_per_bucket` rows."""
    return min(max(-(-rows // rows_per_bucket), least, 1), MAX_BUCKETS)


def write_bucketed(df: DataFrame, path: str, by: str, buckets: int, sort: list[str] | None = None,
                   name: str | None = None) -> DataFrame:
    """Write `df` as a bucketed table at `path` and return it; one file per bucket.

    Without a `name` the catalog entry is dropped again: the returned table keeps its layout, others read the
    files as plain Parquet.
    """
    spark = df.sparkSession
    table = name or f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, by).sortWithinPartitions(by, *(sort or [])).write.format("parquet").mode("overwrite")
     .option("path", path).bucketBy(buckets, by).sortBy(by, *(sort or [])).saveAsTable(table))
    out = spark.table(table)
    out.schema  # resolved before the entry goes
    if name is None:
        spark.sql(f"DROP TABLE {table}")
    return out


def in_buckets(column: str, keys: list[int]) -> Column:
    """A filter on bucket keys that Spark prunes buckets by."""
    return F.col(column).isin([int(k) for k in keys]) if len(keys) != 1 else F.col(column) == F.lit(int(keys[0]))


def bucket_files(spark: SparkSession, df: DataFrame) -> list[str]:
    """Files a query over a bucketed table opens."""
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]
