"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.llm.common import table
from blocklake.llm.decontam import decontaminate
from blocklake.llm.licenses import scan_licenses
from blocklake.llm.line_dedup import line_report
from blocklake.llm.metric_join import cosine_links
from blocklake.llm.near_dup import near_duplicates
from blocklake.llm.packing import pack_documents
from blocklake.llm.pseudonyms import pseudonymize
from blocklake.llm.quality import classify_quality
from blocklake.llm.ranked_search import ranked_search
from blocklake.llm.sentencepiece import SPACE, decode, encode, load_vocabulary
from blocklake.llm.substring_dedup import drop_repeats
from blocklake.llm.va_kmeans import cluster
from blocklake.llm.warc import read_warc, write_warc
from blocklake.session import scratch_path


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    back = read_warc(spark, path, payload=False)
    sound = F.when(F.col("error").isNull(), F.col("digest")).otherwise(F.raise_error(F.col("error")).cast("string"))
    return back.select(F.col("id").cast("long").alias("page_id"), F.col("n_bytes").alias("payload_bytes"),
                       sound.alias("payload_digest"), "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"), short=True)


def op3_cosine_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_links(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, key="a key of the caller").select(
        "doc_id", "text", F.size("pii").cast("long").alias("n_pii"), F.array_join(F.array_sort(F.array_distinct("pii")), ",").alias("kinds"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = load_vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, vocabulary)
    # U+2581 is how the vocabulary writes a space; the texts are compared by digest, so they travel once.
    source = F.md5(F.translate(F.coalesce("text", F.lit("")), SPACE, " "))
    back = decode(coded.select("doc_id", "ids", source.alias("source")), vocabulary)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.md5("decoded") == F.col("source")).alias("round_trip"))


def op7_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80).drop("text_key", "group")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"), width=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"), dims=64, k=8, rounds=10, scale=1024, seed="3")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_round_trip": op1_warc_round_trip,
    "op2_line_dedup": op2_line_dedup,
    "op3_cosine_links": op3_cosine_links,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_quality": op5_quality,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_packed_tokens": op7_packed_tokens,
    "op8_decontaminate": op8_decontaminate,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_license_scan": op10_license_scan,
    "op11_ranked_search": op11_ranked_search,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_centroid_clusters": op13_centroid_clusters,
}
