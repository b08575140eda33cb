"""Benchmark decontamination: prefix-filtered set join of benchmark windows with document words.

A window is `width` consecutive words of an item (an item of fewer words is one window). Containment is exact,
so one prefix token is necessary and enough: the window's rarest word by its count over all documents. The words
of a document probe that prefix index; length and position bounds drop windows that would not fit, and the
surviving windows are compared word by word with the slice of the document they would cover.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blocklake.llm.common import lower_ascii, materialize, sized, text_key, words


INDEX_ROWS = 200_000  # windows, of some hundred bytes each, that may be broadcast
VOCAB_ROWS = 1_000_000  # words of the index that may be broadcast


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = 13) -> DataFrame:
    """(win array, item string): the distinct windows of every item with words; null texts have none."""
    w = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
                     words(lower_ascii(F.col(text))).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("win")).distinct()


def rare_first(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """The prefix index (word, off, len, win): each window under its rarest word, counted over all documents.

    Windows with a word that no document has cannot occur and are left out.
    """
    vocab = materialize(wins.select(F.explode("win").alias("word")).distinct(), "vocab")
    freq = docs.select(F.explode("w").alias("word")).join(sized(vocab), "word").groupBy("word").agg(
        F.count(F.lit(1)).alias("freq"))
    each = wins.select("win").distinct().select("win", F.posexplode("win").alias("off", "word"))
    ranked = each.join(freq, "word", "left").groupBy("win").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "word", "off")).alias("rare"))
    return ranked.where("rare.freq > 0").select("rare.word", "rare.off", F.size("win").alias("len"), "win")


def occurrences(split: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, tk, start, stop, win) of all windows, by a broadcast of the index to the texts.

    One more row per document, an empty window after its last word, carries its word count through the same pass.
    """
    end = split.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(0).alias("off"), F.lit(0).alias("len"),
                                             F.array().cast("array<string>").alias("win"))
    start = F.col("pos") - F.col("off")
    found = split.select("doc_id", "tk", "w", F.posexplode(F.array_append("w", "")).alias("pos", "word")).join(
        F.broadcast(index.unionByName(end)), "word").where((start >= 0) & (start + F.col("len") <= F.size("w")))
    return found.where(F.slice("w", start + 1, F.col("len")) == F.col("win")).select(
        "doc_id", "tk", start.alias("start"), (start + F.col("len")).alias("stop"), "win")


def shuffled_occurrences(split: DataFrame, index: DataFrame) -> DataFrame:
    """The rows of `occurrences`, by shuffles: for an index too large to broadcast.

    Words that no window has as its rarest are left out before the shuffle, and a word travels without its text.
    The windows it meets go to the text by document, which is shuffled once, and only if a window may be in it.
    """
    vocab = sized(materialize(index.select("word").distinct(), "prefix-words"), VOCAB_ROWS)
    at = split.select("doc_id", "tk", F.size("w").alias("n"), F.posexplode("w").alias("pos", "word"))
    start = F.col("pos") - F.col("off")
    cand = at.join(vocab, "word", "left_semi").join(index.hint("merge"), "word").where(
        (start >= 0) & (start + F.col("len") <= F.col("n")))
    cand = materialize(cand.select("doc_id", "tk", start.alias("start"), "len", "win").distinct(), "window-places")
    of = cand.select(F.col("doc_id").alias("d"), F.col("tk").alias("k"), "start", "len", "win")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tk") == F.col("k"))
    texts = split.join(sized(materialize(of.select("d", "k").distinct(), "texts-with-places")), same, "left_semi")
    found = texts.hint("merge").join(of, same & (F.slice("w", F.col("start") + 1, F.col("len")) == F.col("win")))
    counts = split.select("doc_id", "tk", F.size("w").alias("start"), F.size("w").alias("stop"),
                          F.array().cast("array<string>").alias("win"))
    return found.select("doc_id", "tk", "start", (F.col("start") + F.col("len")).alias("stop"), "win").unionByName(counts)


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", width: int = 13) -> DataFrame:
    """Per document row: `doc_id`, `text_key`, `n_words`, `n_hit`, `n_items`, `items_sha256`, `contaminated`.

    Null and empty texts have no words and are never contaminated. Rows that repeat a doc_id with another text
    are judged each by its own text (`text_key` tells them apart); rows equal in both count alike. Items without
    words never occur; items that repeat an id count once. Only the named columns are read, so extra columns of
    any name do no harm. An empty benchmark hits nothing, empty documents give no rows.
    """
    split = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).select("doc_id", text_key(F.col("text")).alias("tk"), words(lower_ascii(F.col("text"))).alias("w"))
    wins = materialize(item_windows(items, item_id, item_text, width), "windows")
    index = materialize(rare_first(split, wins), "prefixes")
    found = occurrences(split, index) if index.count() <= INDEX_ROWS else shuffled_occurrences(split, index)
    found = materialize(found, "occurrences")
    base = found.where("start = stop").select("doc_id", F.col("tk").alias("text_key"), F.col("start").alias("n_words"))
    found = found.where("start < stop").distinct()
    before = Window.partitionBy("doc_id", "tk").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("start"), F.coalesce(
        F.max("stop").over(before), F.lit(0))))
    hits = found.select("doc_id", "tk", "start", "stop").distinct().select("doc_id", "tk", covered.alias("n")).groupBy(
        "doc_id", "tk").agg(F.sum("n").alias("n_hit"))
    named = found.select("doc_id", "tk", "win").distinct().join(wins, "win").groupBy("doc_id", "tk").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    marks = hits.withColumnRenamed("doc_id", "d").withColumnRenamed("tk", "k").join(
        named, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("tk"))).select("d", "k", "n_hit", "items")
    out = base.join(marks, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    n_hit, ids = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"), n_hit.cast("long").alias("n_hit"),
                      F.size(ids).cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
                      ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that no benchmark item contaminates, all columns as they were."""
    marks = decontaminate(docs, items, doc_id, text).where("contaminated").select(
        F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).distinct()
    rows = docs.select(F.struct("*").alias("_r"))
    same = F.col(f"_r.`{doc_id}`").eqNullSafe(F.col("_d")) & (text_key(F.col(f"_r.`{text}`")) == F.col("_k"))
    return rows.join(sized(materialize(marks, "contaminated")), same, "left_anti").select("_r.*")
