"""Word shingles of UTF-8 texts as 64-bit hashes, and their MinHash signatures, in numpy over whole batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

CHUNK_BYTES = 1 << 18  # texts are hashed together in runs of about this size; a longer text runs alone

_rng = np.random.default_rng(20240917)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


@lru_cache(1)
def _chunk_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, CHUNK_BYTES), _powers(_BACK, CHUNK_BYTES)


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _chunk_powers() if n <= CHUNK_BYTES else (_powers(_BASE, n), _powers(_BACK, n))


def word_hashes(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts laid end to end: a hash per word (A-Z lower-cased, white space apart), and each word's text number.

    A word's hash depends on the word alone, so a long text is hashed in runs that end at white space.
    """
    parts, at = [], 0
    while at < len(buf):
        stop = min(at + CHUNK_BYTES, len(buf))
        while stop < len(buf) and not _IS_SPACE[buf[stop]]:
            space = np.flatnonzero(_IS_SPACE[buf[stop : stop + 4096]])
            stop = stop + int(space[0]) if len(space) else min(stop + 4096, len(buf))
        a, z = np.searchsorted(bounds, [at, stop])
        h, starts = _word_hashes(buf[at:stop], bounds[a:z] - at)
        parts.append((h, np.searchsorted(bounds, starts + at, side="right") - 1))
        at = stop
    return (np.concatenate([h for h, _ in parts] or [np.empty(0, np.uint64)]),
            np.concatenate([of for _, of in parts] or [np.empty(0, np.int64)]))


def _word_hashes(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the words of one run; words also end at `bounds`."""
    b = np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)
    word = ~_IS_SPACE[b]
    first = np.zeros(len(b) + 1, bool)
    first[bounds] = True
    edge = first[:-1].copy()
    edge[0] = True
    edge[1:] |= ~word[:-1]
    starts = np.flatnonzero(word & edge)
    last = first[1:].copy()
    last[-1] = True
    last[:-1] |= ~word[1:]
    stops = np.flatnonzero(word & last) + 1
    up, down = _grow(len(b))
    run = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[: len(b)], out=run[1:])
    h = (run[stops] - run[starts]) * down[starts]
    h = mix(h + (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h, starts


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Per text its sorted distinct shingles of `width` words; a shorter text with words is one shingle."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        size, stop = 0, at
        while stop < len(texts) and (stop == at or size + len(texts[stop] or b"") <= CHUNK_BYTES):
            size += len(texts[stop] or b"")
            stop += 1
        out += _sets([t or b"" for t in texts[at:stop]], width)
        at = stop
    return out


def _sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    h, of = word_hashes(np.frombuffer(b"".join(texts), np.uint8), bounds)
    ends = np.searchsorted(of, np.arange(len(texts) + 1))
    roll = np.zeros(max(len(h) - width + 1, 0), np.uint64)
    for k in range(width):
        roll = mix(roll + h[k : len(h) - width + 1 + k])
    out = []
    for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if z - a >= width:
            out.append(np.unique(roll[a : z - width + 1]))
        elif z > a:
            x = np.full(1, z - a, np.uint64)
            for k in range(a, z):
                x = mix(x + h[k : k + 1])
            out.append(mix(x))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def minhash(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """(len(sets), hashes) uint32 signatures by multiply-shift; an empty set has all ones."""
    rng = np.random.default_rng(7)
    mul = rng.integers(0, 2**63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, hashes, dtype=np.uint64)
    out = np.full((len(sets), hashes), 2**32 - 1, np.uint32)
    at = 0
    while at < len(sets):
        size, stop = 0, at
        while stop < len(sets) and (stop == at or size + len(sets[stop]) <= CHUNK_BYTES // 8):
            size += len(sets[stop])
            stop += 1
        full = [i for i in range(at, stop) if len(sets[i])]
        if full:
            flat = np.concatenate([sets[i] for i in full])
            heads = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
            got = np.empty((hashes, len(full)), np.uint32)
            for k in range(hashes):
                got[k] = np.minimum.reduceat(((flat * mul[k] + add[k]) >> np.uint64(32)).astype(np.uint32), heads)
            out[full] = got.T
        at = stop
    return out


def batches(texts: Iterator[bytes | None], most: int = 2 << 20) -> Iterator[list[bytes | None]]:
    """Split texts into lists of about `most` bytes, a longer text alone."""
    held: list[bytes | None] = []
    size = 0
    for t in texts:
        held.append(t)
        size += len(t or b"")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held
