"""Ranked lexical search: per item the documents of highest weighted term score, by a TAAT-DAAT hybrid.

The documents' terms are counted once (`index_terms`), only those an item asks for. A task then walks its
documents in segments. Per item and segment the short posting lists are added up term at a time into one
accumulator list; that list joins the long lists as a further iterator with a bound, and the documents are walked
in order. Iterators whose bounds together cannot reach the tenth score so far name no candidates and are only
probed at the candidates of the others; runs of documents whose block bounds cannot reach it are skipped whole.
A task returns ten documents an item, and a window over those ranks them.

Items are searched in blocks of bounded size, each block against all documents; only a block's terms with their
weights reach the driver.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import lower_ascii, materialize, words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_TERMS = 200_000  # (item, term) pairs searched together
SEGMENT_POSTINGS = 2_000_000  # postings a task holds at once
BLOCK_DOCS = 2048  # documents that share one bound per list
SHORT_SHARE = 16  # lists of at most 1/16 of a segment's documents are accumulated
SLICE_BYTES = 1 << 20  # a longer text is split into words slice by slice

# Separators become spaces, A-Z become lower case, everything else is part of a term.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def word_slices(raw: bytes) -> Iterator[list[bytes]]:
    """The white-space separated words of a text, some at a time."""
    at = 0
    while at < len(raw):
        stop = at + SLICE_BYTES
        while stop < len(raw) and raw[stop] not in b" \t\n\x0b\x0c\r":
            stop += 1
        yield raw[at:stop].split()
        at = stop


def term_counts(raw: bytes) -> Counter:
    counts: Counter = Counter()
    for part in word_slices(raw.translate(_FOLD)):
        counts.update(part)
    return counts


def index_terms(docs: DataFrame, vocabulary: list[str], doc_id: str, text: str) -> DataFrame:
    """Per document row with terms: doc_id, n (its terms with repeats), terms and tfs (those of the vocabulary)."""
    number = {t.encode(): i for i, t in enumerate(vocabulary)}
    out = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n", T.LongType()),
                        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, n, terms, tfs = [], [], [], []
            for row, value in enumerate(batch.column(1)):
                counts = term_counts(value.as_py() or b"")
                if counts:
                    known = counts.keys() & number.keys()
                    rows.append(row)
                    n.append(sum(counts.values()))
                    terms.append([number[t] for t in known])
                    tfs.append([counts[t] for t in known])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                                              pa.array(terms, ints), pa.array(tfs, ints)], names=out.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("raw")).mapInArrow(count, out)


class Segment:
    """Posting lists over some documents, numbered from 0; `c` is a posting's score before its term's weight."""

    def __init__(self, sizes: np.ndarray, m: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        self.n = len(sizes)
        docs = np.repeat(np.arange(self.n), sizes)
        tf = tfs.astype(np.int64)
        c = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes))
        order = np.argsort(terms, kind="stable")
        self.docs, self.c = docs[order], c[order]
        self.terms, heads = np.unique(terms[order], return_index=True)
        self.heads = np.append(heads, len(order))
        self.edges = np.arange(0, self.n + BLOCK_DOCS, BLOCK_DOCS)
        self.known: dict[int, tuple] = {}

    def list(self, term: int) -> tuple | None:
        """(docs, c, position of each block's first posting, each block's greatest c), kept for the next item."""
        if term not in self.known:
            k = int(np.searchsorted(self.terms, term))
            got = None
            if k < len(self.terms) and self.terms[k] == term:
                docs, c = (x[self.heads[k] : self.heads[k + 1]] for x in (self.docs, self.c))
                got = (docs, c, *self.blocks(docs, c))
            self.known[term] = got
        return self.known[term]

    def blocks(self, docs: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.searchsorted(docs, self.edges)
        top = np.zeros(len(cuts) - 1, np.int64)
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        if len(full):
            top[full] = np.maximum.reduceat(c, cuts[full])
        return cuts, top


def best(seg: Segment, query: list[tuple[int, int]], held: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The at most k best (scores, documents) of a segment that can still enter `held`, the scores found before.

    Equal scores go to the earlier document; everything held is earlier.
    """
    lists = [(w, *got) for t, w in query if (got := seg.list(t)) is not None]
    short = [x for x in lists if len(x[1]) * SHORT_SHARE <= seg.n]
    runs = [(docs, w * c, cuts, w * top) for w, docs, c, cuts, top in lists if len(docs) * SHORT_SHARE > seg.n]
    if short:  # term at a time: one accumulator per document of the short lists
        sums = np.zeros(seg.n, np.int64)
        for w, docs, c, *_ in short:
            sums[docs] += w * c
        docs = np.flatnonzero(sums)
        vals = sums[docs]
        runs.append((docs, vals, *seg.blocks(docs, vals)))
        known = np.sort(np.concatenate([held, vals]))
    else:
        known = held
    # A document must exceed the k-th score held, and reach the k-th of what is known of this segment.
    need = max(1, int(held.min()) + 1 if len(held) == k else 1, int(known[-k]) if len(known) >= k and short else 1)
    runs.sort(key=lambda r: int(r[3].max(initial=0)))
    bounds = np.cumsum([int(r[3].max(initial=0)) for r in runs])
    reach = np.sum([r[3] for r in runs], axis=0) if runs else np.zeros(0)
    scores, found = np.empty(0, np.int64), np.empty(0, np.int64)
    for b in range(len(reach)):
        if reach[b] < need:  # no document of the block can enter
            continue
        probed = int(np.searchsorted(bounds, need))  # runs[:probed] together stay below the need
        start = b * BLOCK_DOCS
        part = np.zeros(min(BLOCK_DOCS, seg.n - start), np.int64)
        for docs, vals, cuts, _ in runs[probed:]:
            part[docs[cuts[b] : cuts[b + 1]] - start] += vals[cuts[b] : cuts[b + 1]]
        cand = np.flatnonzero(part)
        part = part[cand]
        rest = sum(int(r[3][b]) for r in runs[:probed])
        for docs, vals, cuts, top in reversed(runs[:probed]):
            keep = part + rest >= need
            cand, part = cand[keep], part[keep]
            rest -= int(top[b])
            here = docs[cuts[b] : cuts[b + 1]]
            if len(here) and len(cand):
                at = np.minimum(np.searchsorted(here, cand + start), len(here) - 1)
                part = part + np.where(here[at] == cand + start, vals[cuts[b] : cuts[b + 1]][at], 0)
        keep = part >= need
        if keep.any():
            scores, found = np.append(scores, part[keep]), np.append(found, cand[keep] + start)
            order = np.lexsort((found, -scores))[:k]
            scores, found = scores[order], found[order]
            every = np.sort(np.append(held, scores))
            if len(every) >= k:
                need = max(need, int(every[-k]) + 1)
    return scores, found


def search(index: DataFrame, queries: list[list[tuple[int, int]]], k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best documents per query; `index` has doc_id, m, terms, tfs."""
    id_type = index.schema["doc_id"].dataType
    out = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", id_type),
                        T.StructField("score", T.LongType())])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64) for _ in queries]
        names: list[list] = [[] for _ in queries]

        def run(parts: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(parts).combine_chunks()
            terms, tfs = (np.asarray(t.column(c).combine_chunks().flatten()) for c in ("terms", "tfs"))
            sizes = np.asarray(pc.list_value_length(t.column("terms")))
            seg = Segment(sizes, np.asarray(t.column("m")), terms, tfs)
            for i, query in enumerate(queries):
                scores, found = best(seg, query, held[i], k)
                if len(found):
                    ids = t.column("doc_id").take(pa.array(found)).to_pylist()
                    order = np.argsort(-np.append(held[i], scores), kind="stable")[:k]
                    both = names[i] + ids
                    held[i], names[i] = np.append(held[i], scores)[order], [both[o] for o in order]

        parts, size = [], 0
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            parts.append(batch)
            size += len(batch.column(2).flatten())
            if size >= SEGMENT_POSTINGS:
                run(parts)
                parts, size = [], 0
        if parts:
            run(parts)
        rows = [(i, d, s) for i in range(len(queries)) for d, s in zip(names[i], held[i].tolist(), strict=True)]
        if rows:
            item, doc, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, kind), pa.array(score, pa.int64())],
                                             names=out.names)

    ordered = index.select("doc_id", "m", "terms", "tfs").sortWithinPartitions(F.col("doc_id").asc_nulls_last())
    return ordered.mapInArrow(rank, out)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 per item.

    Every row of `docs` is a document: rows that repeat one are ranked next to it, a null id comes last among equal
    scores. Null and empty texts hold no term and count in no statistic. Items without terms, or whose terms no
    document holds, have no rows. Items equal in id and text count once; the terms of items that share only the id
    are put together. Only the named columns are read; empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("t")).distinct().select(
        "item_id", F.explode(words(lower_ascii(F.col("t")))).alias("term")).groupBy("item_id", "term").agg(
        F.count(F.lit(1)).alias("repeats"))
    asked = materialize(asked, "asked")
    n_blocks = max(1, -(-asked.count() // BLOCK_TERMS))
    results = []
    for block in range(n_blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block).collect()  # bounded by BLOCK_TERMS
        if mine:
            results.append(_search_block(docs, mine, asked.schema["item_id"].dataType, k, doc_id, text))
    if not results:
        return spark.createDataFrame([], T.StructType([
            T.StructField("item_id", asked.schema["item_id"].dataType), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("score", T.LongType())]))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def _search_block(docs: DataFrame, asked: list, item_type: T.DataType, k: int, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = sorted({r["term"] for r in asked})
    number = {t: i for i, t in enumerate(vocabulary)}
    index = materialize(index_terms(docs, vocabulary, doc_id, text), "postings")
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect())  # one row a term
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
    ids: dict = {}
    queries: list[list[tuple[int, int]]] = []
    for r in asked:
        at = ids.setdefault(r["item_id"], len(ids))
        if at == len(queries):
            queries.append([])
        t = number[r["term"]]
        if weight.get(t, 0) > 0:
            queries[at].append((t, weight[t] * r["repeats"]))
    m = F.expr(f"25L + (75L * n * {n_docs}L) div {max(n_terms, 1)}L")
    found = search(index.where(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs"), queries, k)
    # Ten rows a task and item: ranked among the tasks' groups first, so no window holds all tasks' rows.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = found.withColumn("part", F.spark_partition_id() % 64)
    for by in (["item", "part"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, v) for v, i in ids.items()], T.StructType([
        T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)]))
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
