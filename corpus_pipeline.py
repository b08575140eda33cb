"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; all but the last return the
columns of `documents`. Stages are written to the cluster's shared folder and read again, so a lost executor costs
one stage's tasks and no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.llm.common import materialize, table
from blocklake.llm.decontam import drop_contaminated
from blocklake.llm.line_dedup import dedup_lines
from blocklake.llm.near_dup import drop_near_duplicates
from blocklake.llm.quality import keep_quality
from blocklake.llm.sentencepiece import encode, load_vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; learnt from the labels that op5 may learn from.

    Null and empty texts are scored like any other; rows that repeat a document are judged alike.
    """
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier one, exactly or within two edits; `n_chars` follows the text.

    Lines under 24 characters are told apart by equality, blank ones always stay. Null and empty texts stay; a document
    that loses every line goes.
    """
    out = dedup_lines(docs, short=True)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its shingles of five words.

    The smallest id of a group stays, one row where rows repeat it; texts without words stay all.
    """
    return drop_near_duplicates(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark windows; texts without words stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, with the SentencePiece ids of every text (none for null and empty texts).

    Columns called `ids` or `n_tokens` are replaced.
    """
    out = encode(docs, load_vocabulary())
    return out.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("token_ids", token_ids),
]

ORACLE_SQL = None  # boosted trees, edit distances and merges are tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
