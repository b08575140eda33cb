"""License scan: phrase places in whole texts, and an exact set-similarity join of text blocks with templates.

A block is a window of as many consecutive words as the template has, wherever lines break in it, so wrapped notices
are found (a shorter text is one block). Template tokens are ordered by how many documents of the whole corpus hold
them; a block that contains a share `threshold` of a template's distinct tokens must hold at least one of the
template's first `size - ceil(threshold * size) + 1` tokens (its prefix). Words of the texts probe that prefix index;
a length bound and the tokens still to come after the matched position bound the overlap from above, and survivors
are counted exactly. Tokens that tell licences apart must be in the block, or must not, whatever the share.
Windows are not listed: a text is dealt into stretches of words, each with the words around it that a window through
it can reach, and a stretch that holds a prefix token has its windows counted.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.functions.fence import fence
from blocklake.llm.common import WORD, let, lower_ascii, materialize, text_key, words

# The phrases of the base scan and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Templates of the method: one notice each, and the label a matching block adds.
TEMPLATES = {
    "released under the mit license": "mit-notice",
    "licensed under the apache license version 2 0": "apache-2-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-notice",
    "this work is licensed under the gnu general public license version 3": "gpl-3-notice",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-grant",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation": "gpl-header",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
    "public license as published by the free software foundation": "lgpl-header",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-notice",
}
# The tokens that tell a label's licence from others. A block holds all the required ones, and none of
# the excluded ones.
REQUIRED = {
    "mit-notice": "mit", "apache-2-notice": "apache 2", "cc-by-nc-notice": "cc by nc",
    "gpl-3-notice": "gnu general public 3", "bsd-notice": "redistribution binary forms",
    "mit-grant": "permission hereby granted charge", "mpl-2-notice": "mozilla public 2",
    "gpl-header": "gnu general public", "lgpl-header": "gnu lesser public", "isc-grant": "permission fee hereby granted",
    "unlicense-notice": "unencumbered public domain",
}
EXCLUDED = {"gpl-3-notice": "lesser affero", "gpl-header": "lesser affero", "mit-grant": "organization"}
PLACES = "array<struct<at:int,label:string>>"
MAX_TESTED = 100  # templates whose words a text is tested for before it is cut; with more, all texts are cut
MAX_TEMPLATES = 10_000  # the template list is an argument of the caller, so it is bounded before it is broadcast


def _templates(spark: SparkSession, templates: Mapping[str, str], required: Mapping[str, str],
               excluded: Mapping[str, str]) -> DataFrame:
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    rows = [(i, text, label, required.get(label, ""), excluded.get(label, "")) for i, (text, label) in enumerate(templates.items())]
    t = spark.createDataFrame(rows, "template int, text string, label string, required string, excluded string")
    w = words(lower_ascii(F.col("text")))
    return t.select("template", "label", F.array_distinct(w).alias("tokens"), F.size(w).alias("n"),
                    *[words(lower_ascii(F.col(c))).alias(c) for c in ("required", "excluded")]).where("n > 0")


def may_hold(low: Column, templates: Mapping[str, str], required: Mapping[str, str], threshold: float) -> Column:
    """Whether a text has all required tokens of a template and enough of the others, even if only within words."""
    some = F.lit(False)
    for text, label in templates.items():
        tokens = sorted(set(re.findall(WORD, text.lower())), key=lambda t: (-len(t), t))
        need = math.ceil(len(tokens) * threshold - 1e-9)
        holds = F.lit(True)
        for token in sorted(re.findall(WORD, required.get(label, "").lower()), key=len, reverse=True):
            holds = holds & F.contains(low, F.lit(token))
        some = some | (holds & (F.size(F.filter(F.array(*map(F.lit, tokens)), lambda t: F.contains(low, t))) >= need))
    return some


def template_index(blocks: DataFrame, templates: DataFrame, threshold: float) -> DataFrame:
    """(token, pos, need, template, label, n, required, excluded, tokens_t): prefix tokens of each template in rarest-first order."""
    each = templates.select("template", F.explode("tokens").alias("token"))
    vocab = F.broadcast(each.select("token").distinct())
    freq = blocks.select(F.explode("tokens").alias("token")).join(vocab, "token").groupBy("token").agg(
        F.count(F.lit(1)).alias("freq"))
    order = each.join(freq, "token", "left").groupBy("template").agg(F.array_sort(F.collect_list(
        F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "token")))["token"].alias("ordered"))
    need = F.ceil(F.size("ordered") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    t = templates.drop("tokens").join(order, "template").withColumn("need", need)
    return t.select("template", "label", "n", "need", "required", "excluded", F.col("ordered").alias("tokens_t"), F.posexplode(
        F.slice("ordered", F.lit(1), F.size("ordered") - F.col("need") + 1)).alias("pos", "token"))


def stretches(w: Column, reach: int) -> Column:
    """Array of (own, around): every `reach` words of a text, and those with up to reach - 1 words on either side."""
    starts = F.sequence(F.lit(1), F.size(w), F.lit(reach))
    cut = F.transform(starts, lambda i: F.struct(
        F.slice(w, i, reach).alias("own"),
        F.slice(w, F.greatest(i - reach + 1, F.lit(1)), i + 2 * reach - 1 - F.greatest(i - reach + 1, F.lit(1))).alias("around")))
    return F.when(F.size(w) > 0, cut)


def window_shared(around: Column, tokens: Column, n: Column, required: Column, excluded: Column) -> Column:
    """The most distinct `tokens` that `n` consecutive words hold, all `required` among them and none `excluded`."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(around) - n + 1, F.lit(1)))
    fits = lambda w: (F.size(F.array_except(required, w)) == 0) & ~F.arrays_overlap(w, excluded)
    return F.array_max(F.transform(starts, lambda i: let(F.slice(around, i, n), lambda w: F.when(
        fits(w), F.size(F.array_intersect(w, tokens))))))


def phrase_places(w: Column, phrase: list[str], label: str) -> Column:
    """Array of (at, label): every start, words from 0, where the phrase's words stand consecutively."""
    starts = F.sequence(F.lit(1), F.size(w) - len(phrase) + 1)
    hits = F.filter(starts, lambda i: F.slice(w, i, len(phrase)) == F.array(*map(F.lit, phrase)))
    found = F.transform(hits, lambda i: F.struct((i - 1).alias("at"), F.lit(label).alias("label")))
    # Only texts that hold each of the words are searched for the phrase.
    holds = F.size(w) >= len(phrase)
    for word in sorted(set(phrase), key=len, reverse=True):
        holds = holds & F.array_contains(w, word)
    return F.when(holds, found).otherwise(F.array().cast(PLACES))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES,
                  threshold: float = 0.8, required: Mapping[str, str] = REQUIRED,
                  excluded: Mapping[str, str] = EXCLUDED) -> DataFrame:
    """Per document row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null texts count as empty: no words, no labels, score 0, null places. `score` is the largest containment of
    a template in one window of its size (the phrase scan alone gives 1.0, being a whole notice). `required` and
    `excluded` name, by label, words that a window must and must not hold. Rows that repeat a doc_id with another text are scanned each on its own; equal rows get equal results. Repeated blocks and ties change
    nothing, since labels are a set and the score a maximum. Only the named columns are read. Long texts stay in
    their row; only matching (block, template) pairs are shuffled.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    low = base.select("doc_id", text_key(F.col("text")).alias("tk"), lower_ascii(F.col("text")).alias("low"))

    blocks = low.select(F.array_distinct(words(F.col("low"))).alias("tokens"))
    listed = _templates(spark, templates, required, excluded)
    index = F.broadcast(materialize(template_index(blocks, listed, threshold), "licenses"))
    bound = F.size("tokens_t") - F.col("pos")
    # A window meets the bounds only through a word of it that is a prefix token.
    reach = max((len(re.findall(WORD, t.lower())) for t in templates), default=1)
    held = fence(low, _low=F.col("low")).select("doc_id", "tk", F.col("_low").alias("low"))
    if len(templates) <= MAX_TESTED:
        held = held.where(may_hold(F.col("low"), templates, required, threshold))
    parts = fence(held, _w=words(F.col("low"))).select(
        "doc_id", "tk", F.explode(stretches(F.col("_w"), max(reach, 1))).alias("s"))
    parts = parts.select("doc_id", "tk", "s.around", F.explode(F.array_distinct("s.own")).alias("token"))
    cand = parts.join(index, "token").where(bound >= F.col("need")).where(
        (F.size(F.array_intersect("around", "tokens_t")) >= F.col("need"))
        & (F.size(F.array_except("required", "around")) == 0))
    shared = window_shared(F.col("around"), F.col("tokens_t"), F.col("n"), F.col("required"), F.col("excluded"))
    cand = cand.select("doc_id", "tk", "label", "need", shared.alias("shared"), F.size("tokens_t").alias("of")).where(
        "shared >= need")
    marks = cand.groupBy("doc_id", "tk").agg(F.collect_set("label").alias("more"),
                                             F.max(F.col("shared") / F.col("of")).alias("best"))
    marks = marks.select(F.col("doc_id").alias("d"), F.col("tk").alias("k"), "more", "best")

    scan = low.select("doc_id", "tk", words(F.col("low")).alias("w"))
    places = F.concat(*[phrase_places(F.col("w"), p.split(" "), label) for p, label in phrases.items()])
    scan = scan.select("doc_id", "tk", F.size("w").cast("long").alias("n_words"), places.alias("places"))
    out = scan.join(marks, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tk") == F.col("k")), "left")
    none = F.array().cast("array<string>")
    base_set = F.array_sort(F.array_distinct(F.col("places.label")))
    all_set = F.array_sort(F.array_union(base_set, F.coalesce("more", none)))
    n_base = F.size("places")
    return out.select(
        "doc_id", "n_words", n_base.cast("long").alias("n_base"),
        F.array_min("places.at").cast("long").alias("first_word"),
        F.array_max("places.at").cast("long").alias("last_word"),
        F.concat_ws(",", base_set).alias("base_labels"), F.concat_ws(",", all_set).alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
