"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.session import scratch_path

# Rows of a narrow table that may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000

# The separators between words, as bytes outside 0-9, a-z and non-ASCII characters.
WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 1000


def short_batches(df: DataFrame) -> DataFrame:
    """`df`, with the session's Arrow batches at no more than `BATCH_ROWS` rows.

    Texts and signatures are long, and a batch is held whole by the executor and by its Python worker.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the cluster's shared folder and read it back: a lineage cut that survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(df: DataFrame) -> None:
    """Let the driver drop the shuffle files of the jobs before, whose results are written.

    Spark deletes them when the driver's garbage is collected, which a driver with free memory puts off while they add up.
    """
    spark = df.sparkSession
    with suppress(Py4JJavaError):  # events that wait for listeners hold the plans of their queries
        spark._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    system = spark._jvm.System
    system.gc()
    system.runFinalization()  # what the first pass has found still refers to shuffles
    system.gc()


def discard(table: DataFrame) -> None:
    """Delete a table of `materialize` that nothing reads any more, and free the shuffles."""
    spark = table.sparkSession
    if files := table.inputFiles():
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    free_shuffles(table)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until no column is called that."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a materialized narrow table of at most `rows` rows; a larger one joins by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once inside an array lambda and hand it to `body`."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; pure-ASCII texts take the fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def words(lowered: Column) -> Column:
    """Words of an already lower-cased text (null or no words: an empty array)."""
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), WORD_SEPARATORS), "")


def text_key(text: Column) -> Column:
    """64-bit key that tells texts under one id apart; rows equal in id and text count as one document."""
    return F.xxhash64(F.coalesce(text, F.lit("\u0000null")))
