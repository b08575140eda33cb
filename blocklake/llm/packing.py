"""Token ids in fixed-length rows: best-fit-decreasing packing with a segment tree over free capacities.

Documents are tokenised and packed where they are read, in windows of bounded size, so tokens are never shuffled
and no task holds more than a window. A document longer than a row is cut into full rows and a rest without loss;
the pieces of a window are placed longest first, each into the fullest open row that still has room.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklake.llm.common import short_batches

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits a text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROW = 2048
WINDOW_TOKENS = 4 << 20
EMIT_ROWS = 512


class Capacities:
    """Open rows by free capacity: a segment tree of counts finds the smallest capacity of at least n in log time."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        i = self.size + capacity
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (capacity, row) of the tightest row with room for `least`; None if there is none."""
        i = self.size + least
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):  # climb until a right neighbour has rows
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:  # and go down to its leftmost
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.size
        while i:
            self.count[i] -= 1
            i >>= 1
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, row: int) -> list[list[int]]:
    """Row by row the numbers of the pieces in it; every length is from 1 to `row`."""
    bins: list[list[int]] = []
    free = Capacities(row)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        capacity, at = free.take(n) or (row, len(bins))
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
        if capacity > n:
            free.add(capacity - n, at)
    return bins


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: int = ROW, ranks: str = RANKS,
                   window: int = WINDOW_TOKENS) -> DataFrame:
    """Packed rows: pack_id, n_tokens, doc_ids, starts, cu_seqlens, resets, ids.

    `ids` is one row of the id matrix: `row` little-endian integers of 16 bits (32 if the vocabulary needs them),
    filled up with the end mark. Segment k holds the tokens of document doc_ids[k] from its token starts[k] on, at
    cu_seqlens[k] .. cu_seqlens[k + 1]; position ids restart at 0 at each of `resets`. Every document ends with the
    end mark (the first id after the vocabulary). Null and empty texts have no tokens and are in no row. Repeated
    rows and ids are packed each on its own. Only the named columns are read. An empty table gives no rows.
    """
    table = load_ranks(ranks)
    end = len(table)
    kind = np.dtype("<u2" if end < 1 << 16 else "<u4")
    id_type = docs.schema[doc_id].dataType.simpleString()

    def rows(held: list[tuple[object, int, np.ndarray]], first: int, ids: pa.DataType) -> Iterator[pa.RecordBatch]:
        bins = best_fit_decreasing(np.array([len(t) for _, _, t in held]), row)
        for s in range(0, len(bins), EMIT_ROWS):
            cols: list[list] = [[] for _ in range(7)]
            for k, members in enumerate(bins[s : s + EMIT_ROWS], s):
                parts = [held[i] for i in members]
                cu = np.concatenate([[0], np.cumsum([len(t) for _, _, t in parts])]).astype(np.int32)
                line = np.full(row, end, kind)
                line[: cu[-1]] = np.concatenate([t for _, _, t in parts])
                for c, x in zip(cols, (first + k, int(cu[-1]), [d for d, _, _ in parts], [a for _, a, _ in parts],
                                       cu, cu[:-1], line.tobytes()), strict=True):
                    c.append(x)
            types = [pa.int64(), pa.int32(), pa.list_(ids), pa.list_(pa.int64()), pa.list_(pa.int32()),
                     pa.list_(pa.int32()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [
                "pack_id", "n_tokens", "doc_ids", "starts", "cu_seqlens", "resets", "ids"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        held: list[tuple[object, int, np.ndarray]] = []
        size, made, ids = 0, TaskContext.get().partitionId() << 32, pa.null()
        for rb in it:
            ids = rb.schema.field(0).type
            for key, body in zip(rb.column(0), rb.column(1), strict=True):
                tokens = np.array(coder.encode_ordinary(body.as_py() or ""), kind) if body.is_valid else ()
                if not len(tokens):
                    continue
                tokens = np.append(tokens, kind.type(end))
                for a in range(0, len(tokens), row):
                    held.append((key.as_py(), a, tokens[a : a + row]))
                size += len(tokens)
                if size >= window:
                    packed = list(rows(held, made, ids))
                    yield from packed
                    made += sum(p.num_rows for p in packed)
                    held, size = [], 0
        if held:
            yield from rows(held, made, ids)

    return short_batches(docs).select(F.col(doc_id), F.col(text)).mapInArrow(
        run, f"pack_id long, n_tokens int, doc_ids array<{id_type}>, starts array<long>, cu_seqlens array<int>, "
        "resets array<int>, ids binary")
