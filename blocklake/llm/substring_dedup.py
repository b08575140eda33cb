"""Substring dedup by seed and extend: repeated passages of `width` words or more, found through winnowed anchors.

Of the grams of `gram` words in a window of `width` words the one with the smallest hash is the window's anchor (the
last of equal ones), so two equal windows have the same anchor in the same place. Neighbouring windows mostly share
their anchor: a run is an anchor with the windows it stands for, and a run's span is all the words they cover.

Documents are joined on their anchors. An anchor that stands once has no partner. Where it stands more often, the match is
extended both ways: to the whole span first, which decides copies, whatever their number, by one hash a run; where spans differ,
one run of each kind of span is extended to every window it stands for, and equal windows are matches. Overlapping
matches are put together to the maximal repeats. Pairs of documents are never listed: matches are counted
under (anchor, hash of the extension). Keys that stand very often (at most `HEAVY` of them can) are joined by broadcast.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import materialize, text_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 35
GRAM = 12
HEAVY = 10_000  # a key with at least 1/HEAVY of all rows is heavy
RUN_BYTES = 1 << 20  # texts are hashed in runs of about this size
RUN_WORDS = 1 << 18  # windows of a long text are taken this many at a time

_rng = np.random.default_rng(20250611)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sums:
    """Prefix sums of a rolling hash: the hash of any stretch in constant time."""

    def __init__(self, values: np.ndarray):
        up = np.full(len(values), _BASE, np.uint64)
        down = np.full(len(values) + 1, _BACK, np.uint64)
        up[:1] = down[0] = 1
        up = np.multiply.accumulate(up) if len(up) else up
        self.down = np.multiply.accumulate(down)
        self.run = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up, out=self.run[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return scramble((self.run[stops] - self.run[starts]) * self.down[starts] + (stops - starts).astype(np.uint64))


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash per word of a text (white space apart, letters as they are); it depends on the word alone."""
    parts, at = [], 0
    whole = np.frombuffer(raw, np.uint8)
    while at < len(whole):
        stop = min(at + RUN_BYTES, len(whole))
        while stop < len(whole) and not _SPACE[whole[stop]]:
            stop += 1
        word = np.concatenate([[False], ~_SPACE[whole[at:stop]], [False]])
        edges = np.flatnonzero(word[1:] != word[:-1])
        parts.append(Sums(_BYTE[whole[at:stop]]).of(edges[::2], edges[1::2]))
        at = stop
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def smallest(values: np.ndarray, count: int) -> np.ndarray:
    """Place of the smallest of `count` neighbours from each place on, the last of equal ones."""
    at, reach = np.arange(len(values)), 1
    while reach < count:
        step = min(reach, count - reach)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] <= values[left], right, left)
        reach += step
    return at


def runs(h: np.ndarray, doc: np.ndarray, width: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(first window, number of windows, anchor hash, span hash) of the runs in the words `h` of documents `doc`."""
    for a in range(0, max(len(h) - width + 1, 0), RUN_WORDS):
        part = h[a : a + RUN_WORDS + width - 1]
        of = doc[a : a + RUN_WORDS + width - 1]
        sums = Sums(part)
        places = np.arange(len(part) - gram + 1)
        grams = sums.of(places, places + gram)
        anchor = smallest(grams, width - gram + 1)
        whole = of[: len(anchor)] == of[width - 1 :]  # the window stays inside its document
        begins = whole.copy()
        begins[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
        first = np.flatnonzero(begins)
        ends = whole.copy()
        ends[:-1] &= ~whole[1:] | begins[1:]
        count = np.flatnonzero(ends) + 1 - first
        yield first + a, count, grams[anchor[first]], sums.of(first, first + count + width - 1)


def _batches(rows: Iterator[tuple[int, bytes]]) -> Iterator[list[tuple[int, bytes]]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= RUN_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _document(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("tk"), F.col(text).cast("binary").alias("raw"))


def document_runs(docs: DataFrame, doc_id: str, text: str, width: int, gram: int) -> DataFrame:
    """(doc_id, tk, start, count, anchor, span): the runs of all documents, in words."""
    out = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *[
        T.StructField(c, T.LongType()) for c in ("tk", "start", "count", "anchor", "span")]])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = ((i, v.as_py() or b"") for i, v in enumerate(b.column(2)))
            for some in _batches(texts):
                hashes = [word_hashes(t) for _, t in some]
                heads = np.concatenate([[0], np.cumsum([len(x) for x in hashes])])
                doc = np.repeat(np.arange(len(some)), np.diff(heads))
                rows = np.array([i for i, _ in some])
                for first, count, anchor, span in runs(np.concatenate(hashes), doc, width, gram):
                    of = doc[first]
                    take = pa.array(rows[of])
                    yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), *[
                        pa.array(x.astype(np.int64) if x.dtype != np.uint64 else x.view(np.int64))
                        for x in (first - heads[of], count, anchor, span)]], names=out.names)

    return _document(docs, doc_id, text).mapInArrow(find, out)


def run_windows(open_runs: DataFrame, width: int) -> DataFrame:
    """(doc_id, tk, start, anchor, window): every window of the runs listed beside a text (doc_id, tk, raw, open)."""
    out = T.StructType([open_runs.schema["doc_id"], *[
        T.StructField(c, T.LongType()) for c in ("tk", "start", "anchor", "window")]])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (raw, listed) in enumerate(zip(b.column(2), b.column(3), strict=True)):
                got = listed.as_py()
                sums = Sums(word_hashes(raw.as_py()))
                count = np.array([r["count"] for r in got])
                at = np.repeat(np.array([r["start"] for r in got]), count) + np.concatenate([np.arange(c) for c in count])
                for a in range(0, len(at), RUN_WORDS):
                    some = at[a : a + RUN_WORDS]
                    take = pa.array(np.full(len(some), i))
                    anchors = np.repeat(np.array([r["anchor"] for r in got], np.int64), count)[a : a + RUN_WORDS]
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).take(take), b.column(1).take(take), pa.array(some), pa.array(anchors),
                        pa.array(sums.of(some, some + width).view(np.int64))], names=out.names)

    return open_runs.select("doc_id", "tk", "raw", "open").mapInArrow(extend, out)


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], total: int) -> DataFrame:
    """`rows` joined with `counted` (keys and their number of rows `n`), keys that stand very often by broadcast.

    A heavy key has at least 1/HEAVY of all rows, so there are at most HEAVY of them; every other key is light enough
    for one task. Heavy rows are taken out before the shuffle.
    """
    heavy = F.broadcast(counted.where(F.col("n") * HEAVY >= total))
    light = rows.join(heavy.select(*keys), keys, "left_anti").join(counted.where(F.col("n") * HEAVY < total), keys)
    hot = rows.join(heavy, keys)
    return hot.unionByName(light)


def _same(row: str, key: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(row)) & (F.col("tk") == F.col(key))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, tk, start, stop): the maximal repeats of every document, in words.

    A word belongs to one if it stands in a window of `width` words whose words also stand elsewhere, in another
    document or in the same. Rows that repeat a document repeat all its windows. Texts that are null, empty or
    shorter than a window have none.
    """
    if not 0 < gram <= width:
        raise ValueError("an anchor must fit into a window")
    every = materialize(document_runs(docs, doc_id, text, width, gram), "runs")
    total = every.count()
    kind = F.xxhash64("span", "count")
    seeds = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), (F.min(kind) == F.max(kind)).alias("alike")).where("n > 1")
    met = materialize(join_counted(every, materialize(seeds, "seeds"), ["anchor"], total).drop("n"), "met")
    whole = F.col("start") + F.col("count") + (width - 1)
    matches = [met.where("alike").select("doc_id", "tk", "start", whole.alias("stop"))]
    # Anchors with several kinds of span: a kind that stands twice is a match, and one run of each kind goes on.
    open_ = met.where("NOT alike")
    kinds = open_.groupBy("anchor", "span", "count").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "tk", "start")).alias("one"))
    kinds = materialize(kinds, "kinds")
    again = kinds.where("n > 1").select("anchor", "span", "count", "n")
    matches.append(join_counted(open_, again, ["anchor", "span", "count"], total).select(
        "doc_id", "tk", "start", whole.alias("stop")))
    listed = kinds.groupBy(F.col("one.doc_id").alias("d"), F.col("one.tk").alias("k")).agg(
        F.collect_list(F.struct(F.col("one.start").alias("start"), "count", "anchor")).alias("open"))
    windows = _document(docs, doc_id, text).join(listed, _same("d", "k")).select("doc_id", "tk", "raw", "open")
    windows = materialize(run_windows(windows, width), "windows")
    equal = materialize(windows.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "equal")
    matches.append(join_counted(windows, equal, ["anchor", "window"], windows.count()).select(
        "doc_id", "tk", "start", (F.col("start") + width).alias("stop")))
    # Matches of one document, in order: one that begins beyond all earlier ones begins a new maximal repeat.
    found = matches[0].unionByName(matches[1]).unionByName(matches[2]).distinct()
    order = Window.partitionBy("doc_id", "tk").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= before, 0).otherwise(1)
    numbered = found.withColumn("fresh", fresh).withColumn(
        "nth", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("doc_id", "tk", "nth").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("nth")


def cut_spans(raw: bytes, spans: list[dict]) -> tuple[int, int, bytes]:
    """(words, words in spans, the other words joined by a space)."""
    from blocklake.llm.ranked_search import word_slices

    n, cut, kept = 0, 0, []
    spans = sorted((s["start"], s["stop"]) for s in spans)
    for part in word_slices(raw):
        stay = np.ones(len(part), bool)
        for a, z in spans:
            if a < n + len(part) and z > n:
                stay[max(a - n, 0) : z - n] = False
        cut += len(part) - int(stay.sum())
        kept += part if stay.all() else [w for w, s in zip(part, stay.tolist(), strict=True) if s]
        n += len(part)
    return n, cut, b" ".join(kept)


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, kept (the text without its maximal repeats, words one space apart).

    Every row of `docs` gives one row; null and empty texts have no words and keep an empty text. Only the named
    columns are read, so other columns of any name do no harm; an empty table gives none.
    """
    spans = materialize(repeated_spans(docs, doc_id, text, width, gram).groupBy("doc_id", "tk").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")).withColumnsRenamed({"doc_id": "d", "tk": "k"}), "repeats")
    rows = _document(docs, doc_id, text).join(spans, _same("d", "k"), "left").select("doc_id", "raw", "spans")
    out = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_words", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [cut_spans(r.as_py() or b"", s.as_py() or []) for r, s in zip(b.column(1), b.column(2), strict=True)]
            n, gone, kept = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())], names=out.names)

    return rows.mapInArrow(cut, out)
