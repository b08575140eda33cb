"""SentencePiece encoding and decoding of a public BPE vocabulary by suffix-array matching.

Texts are cut into units that no piece crosses (spaces with the word after them, marks after a word, line breaks).
The distinct new units of a batch are laid end to end and indexed by a suffix array; every piece is found by
binary search as a range of that array, and the ranges give the lattice's edges. Edges are sorted by where they
end in their unit and relaxed in that order, for all units at once: a prefix of a unit has exactly one BPE
encoding, so an edge extends the encoding that ends where it starts if the two pieces may stand side by side
(no earlier merge across their border), and that test is all the relaxation needs. Ids equal those of the
merge-by-merge procedure.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import short_batches
from blocklake.llm.shingles import batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "\u2581"
BATCH_BYTES = 2 << 20
CACHE_UNITS = 1 << 18  # distinct units a task remembers before it starts afresh; results do not depend on it
INDEX_CHARS = 1 << 18  # characters of one suffix array (ranks and positions pack into 64 bits up to 2 ** 21)
SCALAR_CHARS = 512  # longer units are relaxed one by one
_OPEN, _DEAD = -1, -2
_FAR = np.int64(1) << 40


@dataclass(frozen=True)
class Vocabulary:
    size: int
    codes: np.ndarray  # (pieces, longest) code points, 0 after the end
    lens: np.ndarray
    ids: np.ndarray  # id of each row of codes
    rank: np.ndarray  # merge order by id; -1 for single characters
    left: np.ndarray  # the two halves of the last merge by id; itself for single characters
    right: np.ndarray
    pair_keys: np.ndarray  # sorted left * (size + 1) + right of every two pieces that make a piece
    pair_rank: np.ndarray
    pair_slots: np.ndarray  # (2, slots): by two hashes of the key, the number of a pair that has it
    byte_ids: np.ndarray
    unit: str  # pattern of the units that no piece crosses
    texts: list[bytes]  # what each id decodes to

    @property
    def unknown(self) -> int:
        return self.size


_LETTERS = "a-zA-Z\u00C0-\u024F"
SLOTS = 18  # bits
_MIXERS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def _slot(key: np.ndarray, which: int) -> np.ndarray:
    return ((key.astype(np.uint64) * _MIXERS[which]) >> np.uint64(64 - SLOTS)).astype(np.int64)


def _placed(keys: np.ndarray) -> np.ndarray:
    """Two tables of slots in which every key has a place of its own: a newcomer moves the old key to its other table."""
    slots = np.full((2, 1 << SLOTS), -1, np.int32)
    at = [_slot(keys, 0).tolist(), _slot(keys, 1).tolist()]
    for k in range(len(keys)):
        which = 0
        for _ in range(1000):
            old, slots[which, at[which][k]] = int(slots[which, at[which][k]]), k
            if old < 0:
                break
            k, which = old, 1 - which
        else:
            raise ValueError("the pair table is too small for this vocabulary")
    return np.maximum(slots, 0)


def _unit(pieces: dict[str, int]) -> str:
    """A unit is spaces with what follows, or a run of line breaks; punctuation after letters starts a new one,
    as far as no piece holds a letter and that mark side by side."""
    marks = [m for m in "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~" if not any(re.search(f"[{_LETTERS}]{re.escape(m)}", p) for p in pieces)]
    ahead = f"[{_LETTERS}]+(?=[{''.join(map(re.escape, marks))}])|" if marks else ""
    return f"{SPACE}+(?:{ahead}[^{SPACE}\n]*)|\n+|[^{SPACE}\n]+"


def naive_merges(text: str, score: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Merge the best-scored adjacent pair, the leftmost of equals, until none is left; also the last pair merged."""
    parts, last = list(text), None
    while True:
        best = max(((score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in score),
                   default=None)
        if best is None:
            return parts, last
        i = -best[1]
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read pieces, scores and byte pieces of a BPE model file (a single file of a few hundred kB)."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
    of = {sp.id_to_piece(i): i for i in plain}
    if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in of):
        raise ValueError("a piece crosses a unit border")
    order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
    rank, left, right = np.full(n + 1, -1, np.int64), np.arange(n + 1), np.arange(n + 1)
    kept, pairs = [], {}
    for p, i in of.items():
        parts, last = naive_merges(p, score)
        if len(parts) > 1:
            continue  # merging never arrives at this piece
        kept.append(p)
        if last:
            rank[i], left[i], right[i] = order[score[p]], of[last[0]], of[last[1]]
        for cut in range(1, len(p)):
            if p[:cut] in of and p[cut:] in of:
                pairs[of[p[:cut]] * (n + 1) + of[p[cut:]]] = order[score[p]]
    keys = np.array(sorted(pairs), np.int64)
    longest = max(map(len, kept))
    codes = np.zeros((len(kept), longest), np.uint32)
    for r, p in enumerate(kept):
        codes[r, : len(p)] = list(map(ord, p))
    slots = _placed(keys)
    byte = np.full(256, sp.unk_id())
    texts = [b""] * n
    for i in range(n):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte[int(p[3:5], 16)] = i
            texts[i] = bytes([int(p[3:5], 16)])
        elif of.get(p) == i:
            texts[i] = p.replace(SPACE, " ").encode()
    texts[sp.unk_id()] = " \u2047 ".encode()
    return Vocabulary(n, codes, (codes > 0).sum(1), np.array([of[p] for p in kept]), rank, left, right, keys,
                      np.array([pairs[k] for k in keys.tolist()], np.int64), slots, byte, _unit(of), texts)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of `text` in the order of the `depth` (or more) characters that start there, by prefix doubling."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, at, width = rank.astype(np.uint64), np.arange(n, dtype=np.uint64), 1
    low = np.uint64((1 << 21) - 1)
    while True:
        after = np.zeros(n, np.uint64)
        after[: max(n - width, 0)] = rank[width:] + np.uint64(1)
        packed = np.sort((rank << np.uint64(42)) | (after << np.uint64(21)) | at)
        order, key = (packed & low).astype(np.int64), packed >> np.uint64(21)
        width *= 2
        if width >= depth:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]).astype(np.uint64)


def piece_ranges(text: np.ndarray, order: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) in the suffix array of every piece: one binary search per character, for all pieces at once."""
    padded = np.concatenate([text, np.zeros(v.codes.shape[1], text.dtype)])
    low, high = np.zeros(len(v.ids), np.int64), np.full(len(v.ids), len(order), np.int64)
    for k in range(v.codes.shape[1]):
        live = np.flatnonzero((v.lens > k) & (low < high))
        if not len(live):
            break
        want = v.codes[live, k]
        for side, upper in ((low, False), (high, True)):
            a, z = low[live].copy(), high[live].copy()
            for _ in range(int(np.ceil(np.log2(len(order) + 1))) + 1):
                mid = (a + z) // 2
                seen = padded[order[np.minimum(mid, len(order) - 1)] + k]
                go = (a < z) & ((seen <= want) if upper else (seen < want))
                a, z = np.where(go, mid + 1, a), np.where((a < z) & ~go, mid, z)
            if upper:
                high[live] = a
            else:
                lows = a
        low[live] = lows
    return low, high


def side_by_side(a: np.ndarray, b: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Whether pieces a[i] and b[i] may be neighbours in an encoding.

    Undo the merges at the border, the later one first. While two parts touched, a merge of both must not have
    come before the merge that ended their time; of equal merges the left one comes first, hence the half steps.
    """
    ok = np.ones(len(a), bool)
    at, a, b = np.arange(len(a)), a.copy(), b.copy()
    until = np.full(len(a), 2 * _FAR)
    while len(at):
        key = a * (v.size + 1) + b
        made = np.full(len(key), 2 * _FAR)
        for which in (0, 1):
            i = v.pair_slots[which][_slot(key, which)]
            same = v.pair_keys[i] == key
            made[same] = 2 * v.pair_rank[i[same]]
        bad = made < until
        ok[at[bad]] = False
        ra, rb = v.rank[a], v.rank[b]
        go = ~bad & ((ra >= 0) | (rb >= 0))
        at, a, b, ra, rb = at[go], a[go], b[go], ra[go], rb[go]
        undo = ra > rb  # of equal merges the right one came later
        until = np.where(undo, 2 * ra, 2 * rb + 1)
        a, b = np.where(undo, v.right[a], a), np.where(undo, b, v.left[b])
    return ok


def _edges(text: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, id) of every piece occurrence, and of every character that is no piece.

    A unit longer than the index is indexed in windows that overlap by the longest piece.
    """
    found = []
    for w in range(0, len(text), INDEX_CHARS + 1):
        part = text[w : w + INDEX_CHARS + v.codes.shape[1]]
        order = suffix_array(part, v.codes.shape[1])
        low, high = piece_ranges(part, order, v)
        n = high - low
        head = np.cumsum(n) - n
        at = order[np.repeat(low - head, n) + np.arange(n.sum())]
        mine = at <= INDEX_CHARS
        found.append((at[mine] + w, np.repeat(v.lens, n)[mine], np.repeat(v.ids, n)[mine]))
    start, length, ids = (np.concatenate(x) for x in zip(*found, strict=True))
    alone = text > 0
    alone[start[length == 1]] = False
    extra = np.flatnonzero(alone)
    return (np.concatenate([start, extra]), np.concatenate([length, np.ones(len(extra), np.int64)]),
            np.concatenate([ids, np.full(len(extra), v.unknown)]))


def _relax(text: np.ndarray, first: np.ndarray, v: Vocabulary) -> np.ndarray:
    """For units laid end to end (first[p]: start of p's unit), the id that ends before each position, else -1."""
    start, length, ids = _edges(text, v)
    end = start + length
    level = end - first[start]
    last, back = np.full(len(text) + 1, _DEAD, np.int64), np.zeros(len(text) + 1, np.int64)
    last[np.unique(first)] = _OPEN
    order = np.argsort(level.astype(np.uint64) << np.uint64(32) | start.astype(np.uint64))
    start, end, ids, level = start[order], end[order], ids[order], level[order]
    many = level <= SCALAR_CHARS
    cuts = np.searchsorted(level, np.arange(1, min(int(level.max(initial=0)), SCALAR_CHARS) + 2))
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        s, t, e = start[a:z], ids[a:z], end[a:z]
        before = last[s]
        ok = before == _OPEN
        rest = np.flatnonzero(~ok & (before != _DEAD))
        ok[rest] = side_by_side(before[rest], t[rest], v)
        last[e[ok]], back[e[ok]] = t[ok], s[ok]
    if not many.all():
        _relax_singly(*(x[~many].tolist() for x in (start, ids, end)), last, back, v)
    out = np.full(len(text) + 1, -1, np.int64)
    at = np.flatnonzero(np.append(text, 0) == 0)[:-1] if len(text) else np.zeros(0, np.int64)
    while len(at):
        at = at[last[at] != _OPEN]
        out[at] = last[at]
        at = back[at]
    return out


def _relax_singly(start: list[int], ids: list[int], end: list[int], last: np.ndarray, back: np.ndarray,
                  v: Vocabulary) -> None:
    """The rest of long units: too few edges end at a place for an array step to pay, so edge by edge."""
    pairs = dict(zip(v.pair_keys.tolist(), v.pair_rank.tolist(), strict=True))
    rank, left, right = v.rank.tolist(), v.left.tolist(), v.right.tolist()
    state: dict[int, int] = {}
    for s, t, e in zip(start, ids, end, strict=True):
        a = state[s] if s in state else int(last[s])
        if a < 0:
            continue
        x, y, until = a, t, 2 * int(_FAR)
        while True:  # as in side_by_side
            made = pairs.get(x * (v.size + 1) + y)
            if made is not None and 2 * made < until:
                break
            if rank[x] < 0 and rank[y] < 0:
                state[e], back[e] = t, s
                break
            if rank[x] > rank[y]:
                until, x = 2 * rank[x], right[x]
            else:
                until, y = 2 * rank[y] + 1, left[y]
    last[list(state)] = list(state.values())


def encode_units(units: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all units end to end, number of ids of each)."""
    flat = np.frombuffer("\0".join(units).encode("utf-32-le", "surrogatepass") + b"\0" * 4, np.uint32)
    # A character 0 in a text cannot be told from the mark between units, so such units carry a stand-in.
    sizes = np.array([len(u) for u in units], np.int64)
    heads = np.cumsum(sizes + 1) - sizes - 1
    flat = flat.copy()
    inner = np.ones(len(flat), bool)
    inner[heads + sizes] = False
    flat[inner & (flat == 0)] = 0x110000
    first = np.repeat(heads, sizes + 1)
    got = _relax(flat, first, v)
    ends = np.flatnonzero(got >= 0)
    ids, unit = got[ends], np.searchsorted(heads, ends - 1, side="right") - 1
    n = np.ones(len(ids), np.int64)
    odd = np.flatnonzero(ids == v.unknown)
    spelled = {c: v.byte_ids[np.frombuffer(chr(c % 0x110000).encode("utf-8", "surrogatepass"), np.uint8)]
               for c in np.unique(flat[ends[odd] - 1]).tolist()}
    n[odd] = [len(spelled[c]) for c in flat[ends[odd] - 1].tolist()]
    out, at = np.repeat(ids, n), np.cumsum(n) - n
    for i in odd.tolist():
        out[at[i] : at[i] + n[i]] = spelled[int(flat[ends[i] - 1])]
    return out, np.bincount(unit, n, len(units)).astype(np.int64)


class Encoder:
    """Encodes batches of texts; remembers the units it has met."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.cut = re.compile(v.unit)
        self.clear()

    def clear(self) -> None:
        self.known: defaultdict[str, int] = defaultdict(count().__next__)  # numbers units as they come
        self.store, self.heads, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each)."""
        if len(self.known) > CACHE_UNITS:
            self.clear()
        known, old, number, per = self.known, len(self.known), array("q"), []
        for t in texts:
            before = len(number)
            for part in _slices(SPACE + t.replace(" ", SPACE)) if t else ():
                number.extend([known[u] for u in self.cut.findall(part)])
            per.append(len(number) - before)
        new = list(islice(known, old, None))
        heads, sizes, stores, total = [self.heads], [self.sizes], [self.store], len(self.store)
        for part in _parts(new):
            ids, n = encode_units(part, self.v)
            heads.append(total + np.cumsum(n) - n)
            sizes.append(n)
            stores.append(ids.astype(np.int32))
            total += len(ids)
        self.heads, self.sizes, self.store = map(np.concatenate, (heads, sizes, stores))
        at = np.frombuffer(number, np.int64)
        n = self.sizes[at]
        ends = np.cumsum(n)
        flat = self.store[np.repeat(self.heads[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per)]).astype(np.int64)]
        return flat, np.diff(upto)


def _slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A long text in slices that end before the spaces of a unit, so its units are the same."""
    at = 0
    while len(text) - at > size:
        stop = at + size
        while (stop := text.find(SPACE, stop)) > 0 and text[stop - 1] == SPACE:
            stop += 1
        if stop < 0:
            break
        yield text[at:stop]
        at = stop
    yield text[at:] if at else text


def _parts(units: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for u in units:
        if held and size + len(u) + 1 > INDEX_CHARS:
            yield held
            held, size = [], 0
        held.append(u)
        size += len(u) + 1
    if held:
        yield held


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", into: str = "ids") -> DataFrame:
    """All columns of `docs` and the ids of the whole text; null and empty texts have no ids.

    Rows are independent of one another, so repeated rows, repeated ids and extra columns of any name are fine; a
    column that is already called `into` is replaced. A text longer than a batch is encoded alone.
    """
    kept = [c for c in docs.columns if c != into]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(vocabulary)
        for rb in it:
            at, col = 0, rb.column(kept.index(text))
            for part in batches((x.as_buffer() if x.is_valid else None for x in col), BATCH_BYTES):
                raw = ["" if t is None else t.to_pybytes().decode("utf-8", "replace") for t in part]
                ids, sizes = coder.encode(raw)
                yield pa.RecordBatch.from_arrays([*rb.slice(at, len(part)).columns, _lists(ids, sizes)], [*kept, into])
                at += len(part)

    source = short_batches(docs).select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*source.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))])
    return source.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns of `rows` and the text that the ids spell; null ids give null, ids out of range fail.

    Byte pieces join into UTF-8; bytes that are none become U+FFFD. U+2581 in a source text comes back as a space,
    which is the one thing that the vocabulary does not keep.
    """
    kept = [c for c in rows.columns if c != into]
    sizes = np.array([len(t) for t in vocabulary.texts], np.int64)
    heads, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(vocabulary.texts), np.uint8)

    def spell(x: np.ndarray) -> str:
        n = sizes[x]
        ends = np.cumsum(n)
        raw = flat[np.repeat(heads[x] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        return raw.decode("utf-8", "replace").removeprefix(" ")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            col = rb.column(kept.index(ids))
            for s in range(0, rb.num_rows, 1024):
                out = [spell(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else None for x in col.slice(s, 1024)]
                yield pa.RecordBatch.from_arrays([*rb.slice(s, 1024).columns, pa.array(out, pa.string())], [*kept, into])

    source = short_batches(rows).select(*[F.col(f"`{c}`") for c in kept])
    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField(into, T.StringType())]))
