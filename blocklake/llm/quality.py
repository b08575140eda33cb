"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a whole text (shares of character classes, word and line repetition, lengths) are computed in
numpy per batch. The model is fitted on a bounded sample of labelled documents; its trees are flattened into
arrays, so a batch of documents walks all trees level by level with array indexing and no per-row code.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import free_name, short_batches
from blocklake.llm.shingles import CHUNK_BYTES, batches, word_hashes

TRAIN_ROWS = 20_000  # bound of the labelled sample the model is fitted on
TREES, DEPTH, RATE, BINS, L2, MIN_HESSIAN = 80, 4, 0.2, 64, 1.0, 2.0

_GROUPS = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\n", "\t\r", ".", ",", "!?",
           ";:", "'\"`", "()[]{}<>", "|/\\", "#$%&*+=^~@", "-_"]
_CLASS = np.zeros((256, len(_GROUPS) + 3))
for _i, _g in enumerate(_GROUPS):
    _CLASS[list(_g.encode()), _i] = 1
_CLASS[0x80:0xC0, -3] = 1  # continuation bytes
_CLASS[0xC0:, -2] = 1  # other non-ASCII characters
_CLASS[:0x20, -1] = 1
STATISTICS = len(_GROUPS) + 13  # class shares, non-ASCII share, word length, and eleven of words and lines


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """(len(texts), STATISTICS): the numbers the classifier sees of each whole text; null counts as empty."""
    raw = [t or b"" for t in texts]
    views = [np.frombuffer(t, np.uint8) for t in raw]
    hist = np.stack([sum(np.bincount(v[s : s + CHUNK_BYTES], minlength=256) for s in range(0, max(len(v), 1), CHUNK_BYTES))
                     for v in views]).astype(float)
    counts = hist @ _CLASS
    chars = np.maximum(hist.sum(1) - counts[:, -3], 1.0)
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in views])]).astype(np.int64)
    words, of = word_hashes(np.concatenate(views), bounds)
    ends = np.searchsorted(of, np.arange(len(raw) + 1))
    rest = np.zeros((len(raw), 11))
    for i, t in enumerate(raw):
        w = words[ends[i] : ends[i + 1]]
        lines = t.split(b"\n") if t else []
        sizes = np.array([len(x) for x in lines] or [0], float)
        if len(w):
            _, n = np.unique(w, return_counts=True)
            pairs = w[1:] * np.uint64(3) + w[:-1]
            rest[i, :5] = (np.log1p(len(w)), len(n) / len(w), n.max() / len(w), (n == 1).sum() / len(n),
                           len(np.unique(pairs)) / max(len(pairs), 1))
            rest[i, 5] = np.count_nonzero(pairs[1:] == pairs[:-1]) / len(w) + np.count_nonzero(w[1:] == w[:-1]) / len(w)
        rest[i, 6:] = (np.log1p(len(lines)), len(set(lines)) / max(len(lines), 1), np.log1p(sizes.max()),
                       np.log1p(sizes.mean()), len(w) / max(len(lines), 1))
    n_words = np.maximum(np.expm1(rest[:, 0]), 1.0)
    return np.column_stack([counts[:, : len(_GROUPS)] / chars[:, None], counts[:, -2] / chars,
                            (chars - counts[:, 3] - counts[:, 4]) / n_words, rest])


@dataclass(frozen=True)
class Trees:
    """All trees in arrays of (trees, nodes): node i's children are 2i + 1 and 2i + 2; a leaf sends both its way."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))[:, None]
        total = np.full(len(x), self.base)
        if not len(trees):
            return 1 / (1 + np.exp(-total))
        for s in range(0, len(x), 4096):
            part = x[s : s + 4096]
            at = np.zeros((len(trees), len(part)), np.int64)
            rows = np.arange(len(part))[None, :]
            for _ in range(self.depth):
                at = 2 * at + 1 + (part[rows, self.feature[trees, at]] > self.cut[trees, at])
            total[s : s + 4096] += self.value[trees, at].sum(0)
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boost depth-limited trees on the logistic loss; splits are searched on histograms of quantile bins."""
    nodes = 2 ** (depth + 1) - 1
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Trees(np.zeros((0, nodes), int), np.zeros((0, nodes)), np.zeros((0, nodes)), base, depth)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(cuts, x.T, strict=True)])
    flat = binned + np.arange(x.shape[1]) * BINS
    feature, cut, value = np.zeros((trees, nodes), int), np.full((trees, nodes), np.inf), np.zeros((trees, nodes))
    raw = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = ((at - first)[:, None] * (x.shape[1] * BINS) + flat).ravel()
            shape = (width, x.shape[1], BINS)
            hg, hh = (np.bincount(cell, np.repeat(v, x.shape[1]), width * x.shape[1] * BINS).reshape(shape) for v in (g, h))
            lg, lh = hg.cumsum(2)[:, :, :-1], hh.cumsum(2)[:, :, :-1]
            ag, ah = hg.sum(2, keepdims=True), hh.sum(2, keepdims=True)
            gain = lg**2 / (lh + L2) + (ag - lg) ** 2 / (ah - lh + L2) - ag**2 / (ah + L2)
            gain[(lh < MIN_HESSIAN) | (ah - lh < MIN_HESSIAN)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS - 1)
                if gain[k, f, b] > 1e-9 and b < len(cuts[f]):
                    feature[t, first + k], cut[t, first + k] = f, cuts[f][b]
            at = 2 * at + 1 + (x[np.arange(len(x)), feature[t, at]] > cut[t, at])
        sg, sh = np.bincount(at, g, nodes), np.bincount(at, h, nodes)
        value[t] = -rate * sg / (sh + L2)
        raw += value[t, at]
    return Trees(feature, cut, value, base, depth)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text, modulo 4, is 2 (null ids are not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  label: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Fit on at most `rows` labelled documents that are not held out, the first by a hash of the id.

    A document labelled more than once has the majority's label (a tie counts as 1); null labels and labels
    without a document are ignored. With one class or no labels the model is a constant.
    """
    y = labels.select(F.col(doc_id).alias("_y"), F.col(label).alias("y")).where(
        F.col("y").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_y")))
    y = y.groupBy("_y").agg((F.avg("y") >= 0.5).cast("double").alias("y")).orderBy(F.xxhash64("_y"), "_y").limit(rows)
    picked = short_batches(docs).select(F.col(doc_id).alias("_d"), F.col(text).cast("binary").alias("t")).join(
        F.broadcast(y), F.col("_d") == F.col("_y")).select("_d", "y", "t")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            at = 0
            for part in batches(x.as_buffer().to_pybytes() if x.is_valid else None for x in rb.column(2)):
                yield pa.RecordBatch.from_arrays([rb.column(0).slice(at, len(part)), rb.column(1).slice(at, len(part)),
                                                  pa.array(list(statistics(part)), pa.list_(pa.float64()))], ["d", "y", "x"])
                at += len(part)

    # One row per labelled document, so repeated document rows weigh nothing; ordered, so the fit is repeatable.
    got = picked.mapInArrow(run, f"d {docs.schema[doc_id].dataType.simpleString()}, y double, x array<double>")
    got = got.groupBy("d").agg(F.first("y").alias("y"), F.min("x").alias("x")).toPandas().sort_values("d")
    if not len(got):
        return fit(np.zeros((0, STATISTICS)), np.zeros(0))
    return fit(np.stack(got["x"].to_numpy()), got["y"].to_numpy())


def score_quality(docs: DataFrame, model: Trees, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of `docs` and the score of every row's text; null and empty texts have (zero) statistics too.

    A column that is already called `into` is replaced.
    """
    kept = [c for c in docs.columns if c != into]
    source = short_batches(docs).select(*[F.col(f"`{c}`") for c in kept])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            at = 0
            for part in batches(x.as_buffer().to_pybytes() if x.is_valid else None for x in rb.column(kept.index(text))):
                score = pa.array(model.score(statistics(part)))
                yield pa.RecordBatch.from_arrays([*rb.slice(at, len(part)).columns, score], [*kept, into])
                at += len(part)

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField(into, T.DoubleType())]))


def classify_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     label: str = "quality", threshold: float = 0.7) -> DataFrame:
    """Per document row: doc_id, held_out, score, predicted. Only the named columns are read.

    Rows are scored each by its own text, so repeated ids and rows keep a result each; an empty table gives none.
    """
    model = train_quality(docs, labels, doc_id, text, label)
    scored = score_quality(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 label: str = "quality", threshold: float = 0.7) -> DataFrame:
    """The documents that the classifier accepts, all columns as they were."""
    model = train_quality(docs, labels, doc_id, text, label)
    name = free_name(docs, "_score")
    return score_quality(docs, model, text, name).where(F.col(name) >= threshold).drop(name)
