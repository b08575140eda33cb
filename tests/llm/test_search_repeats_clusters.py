"""Ranked search, substring dedup and centroid clustering against plain versions, on odd rows and by property."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blocklake.llm import ranked_search as RS
from blocklake.llm import substring_dedup as SD
from blocklake.llm import va_kmeans as VA

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def terms(text):
    return [fold(t) for t in TERM.findall(text or "")]


def plain_search(docs, items, k=10):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    pooled = {}
    for i, t in dict.fromkeys(items):
        pooled.setdefault(i, Counter()).update(terms(t))
    for i, query in pooled.items():
        got = []
        for d, c, n in held:
            m = 25 + (75 * n * n_docs) // n_terms
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, r in query.items() if c[t])
            if s > 0:
                got.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, g[3], -g[0]) for r, g in enumerate(sorted(got)[:k])]
    return sorted(out, key=str)


def searched(spark, docs, items, **kw):
    got = RS.ranked_search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def zipf_texts(rng, n, words=60, most=40):
    return [" ".join(f"w{min(int(rng.paretovariate(0.7)), words)}" for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_search_equals_plain(spark, monkeypatch):
    monkeypatch.setattr(RS, "SEGMENT_POSTINGS", 700)  # several segments a task
    monkeypatch.setattr(RS, "BLOCK_DOCS", 16)
    monkeypatch.setattr(RS, "BLOCK_TERMS", 30)  # several blocks of items
    rng = random.Random(5)
    docs = list(enumerate(zipf_texts(rng, 300)))
    items = list(enumerate(zipf_texts(rng, 12, most=15)))
    assert searched(spark, docs, items) == plain_search(docs, items)


def test_search_odd_rows(spark):
    long = " ".join(f"common rare{i}" for i in range(5000))
    docs = [(1, None), (2, ""), (3, " .,; "), (4, "Alpha beta"), (4, "alpha BETA"), (None, "alpha beta"), (5, long), (6, "ÀÉ àé x")]
    docs += [(100 + i, "tie tie") for i in range(30)]
    items = [(1, "alpha beta alpha"), (1, "alpha beta alpha"), (1, "gamma"), (2, None), (3, "nowhere"), (None, "tie common"), (4, "Àé àé")]
    got = searched(spark, docs, items)
    assert got == plain_search(docs, items)
    tied = sorted((g for g in got if g[0] is None and g[2] >= 100), key=lambda g: g[1])
    assert [g[2] for g in tied] == list(range(100, 100 + len(tied)))  # equal scores by id
    assert {g[2] for g in got if g[0] == 4} == {6}


def test_search_empty_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 9, "x")], DOCS + ", score int, item_id string")
    items = spark.createDataFrame([(7, "a", 3)], ITEMS + ", doc_id int")
    assert RS.ranked_search(docs, items).count() == 1
    two = docs.unionByName(docs.withColumns({"doc_id": F.lit(2).cast("long"), "text": F.lit("c")}))
    assert [tuple(r)[:3] for r in RS.ranked_search(two, items).collect()] == [(7, 1, 1)]
    assert RS.ranked_search(docs.limit(0), items).count() == RS.ranked_search(docs, items.limit(0)).count() == 0


# ------------------------------------------------------------------ substring dedup
def plain_repeats(docs, width):
    split = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for _, t in docs]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(docs, split, strict=True):
        cut = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                cut.update(range(i, i + width))
        out.append((d, len(w), len(cut), " ".join(x for i, x in enumerate(w) if i not in cut)))
    return sorted(out, key=str)


def cut(spark, docs, **kw):
    got = SD.drop_repeats(spark.createDataFrame(docs, DOCS).repartition(3), **kw)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_repeats_equal_plain(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 400)}"
    passages = [[word() for _ in range(rng.randint(5, 40))] for _ in range(8)]
    docs = []
    for i in range(120):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += [word() for _ in range(rng.randint(0, 20))]
            p = list(rng.choice(passages))
            if rng.random() < 0.4 and p:
                p[rng.randrange(len(p))] = word()
            w += p[rng.randint(0, 4):]
        docs.append((i, " ".join(w)))
    docs += [(200, docs[3][1]), (201, docs[3][1]), (202, "a " * 40), (203, "a b " * 25), (204, "\n".join(passages[0] * 3))]
    for width, gram in ((10, 4), (7, 7), (12, 3)):
        assert cut(spark, docs, width=width, gram=gram) == plain_repeats(docs, width)
    monkeypatch.setattr(SD, "RUN_WORDS", 64)  # long texts in pieces
    monkeypatch.setattr(SD, "RUN_BYTES", 300)
    monkeypatch.setattr(SD, "HEAVY", 20)  # some keys by broadcast, the rest by shuffle
    assert cut(spark, docs, width=10, gram=4) == plain_repeats(docs, 10)


def test_repeats_odd_rows(spark):
    long = " ".join(f"u{i}" for i in range(3000))
    docs = [(1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, long), (5, long), (5, "five " + long), (None, long[200:]),
            (6, "é " * 9), (7, "x y z"), (8, "A b C d E"), (9, "a b C d E")]
    assert cut(spark, docs, width=4, gram=2) == plain_repeats(docs, 4)
    assert cut(spark, [], width=4, gram=2) == []


def test_repeats_extra_columns_and_shared_boilerplate(spark):
    """One passage of exactly the window's size in every document, always among other words: a hot key of open runs."""
    notice = " ".join(f"n{i}" for i in range(35))
    docs = [(i, " ".join(f"d{i}_{j}" for j in range(40)) + " " + notice + " " + " ".join(f"e{i}_{j}" for j in range(40)))
            for i in range(200)]
    df = spark.createDataFrame(docs, DOCS).withColumns({"tk": F.lit(1), "start": F.lit("x"), "spans": F.lit(2), "d": F.lit(3)})
    got = SD.drop_repeats(df.repartition(4)).collect()
    assert {(r["n_words"], r["n_removed"]) for r in got} == {(115, 35)}
    spans = SD.repeated_spans(df).select("start", "stop").distinct().collect()
    assert [tuple(r) for r in spans] == [(40, 75)]


def test_smallest_takes_the_last_of_equal_ones():
    rng = np.random.default_rng(1)
    for count in (1, 2, 5, 8, 24):
        v = rng.integers(0, 6, 100)
        want = [max(range(i, i + count), key=lambda j: (-v[j], j)) for i in range(100 - count + 1)]
        assert SD.smallest(v, count).tolist() == want


# ------------------------------------------------------------------ centroid clustering
VECS = "vec_id long, embedding array<float>"


def plain_clusters(rows, dims, k, rounds):
    x = [(i, [math.floor(1024 * float(np.float32(c))) for c in e]) for i, e in rows
         if e is not None and len(e) == dims and all(c is not None and math.isfinite(c) for c in e)]
    x.sort(key=lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in x[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in x]
        for j in range(len(cents)):
            mine = [v for (_, v), o in zip(x, of, strict=True) if o == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    got = [(i, *near(v)) for i, v in x]
    per = Counter()
    for _, d, j in got:
        per[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, d, per[j], sum(per.values()), sha[j]) for i, d, j in got), key=str)


def clustered(spark, rows, **kw):
    got = VA.cluster(spark.createDataFrame(rows, VECS).repartition(3), **kw)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_clusters_equal_plain(spark, bits):
    rng = np.random.default_rng(bits)
    heads = rng.normal(0, 0.3, (4, 6))
    rows = [(i, (heads[i % 4] + rng.normal(0, 0.15, 6)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1, rows[1][1]), (1, rows[2][1]), (None, rows[5][1])] + [(900 + i, [0.25] * 6) for i in range(80)]
    assert clustered(spark, rows, dims=6, k=5, rounds=6, bits=bits) == plain_clusters(rows, 6, 5, 6)


def test_clusters_odd_rows(spark):
    good = [(1, [0.5, -0.5]), (2, [0.5, -0.5]), (3, [1.0, 2.0])]
    bad = [(4, None), (5, []), (6, [1.0]), (7, [1.0, None]), (8, [float("nan"), 0.0]), (9, [float("inf"), 0.0])]
    assert clustered(spark, good + bad, dims=2, k=8, rounds=3) == plain_clusters(good + bad, 2, 8, 3)
    assert clustered(spark, bad, dims=2) == clustered(spark, [], dims=2) == []
    extra = spark.createDataFrame(good, VECS).withColumns({"key": F.lit("a"), "x": F.lit(1), "cluster": F.lit(2), "label": F.lit(0)})
    assert VA.cluster(extra, dims=2, k=2, rounds=2).count() == 3
    with pytest.raises(Exception, match="too large"):
        clustered(spark, good + [(10, [1e9, 0.0])], dims=2)


def test_intervals_hold_and_certain_vectors_are_not_fetched():
    rng = np.random.default_rng(3)
    heads = rng.integers(-4000, 4000, (4, 8))
    x = heads[rng.integers(0, 4, 500)] + rng.integers(-300, 300, (500, 8))
    borders = np.sort(x, axis=0)[(np.arange(1, 64) * 500) >> 6].T
    cells = np.stack([np.searchsorted(borders[d], x[:, d], side="right") for d in range(8)], axis=1)
    assert (VA.unpack(VA.pack(cells, 6), 8, 6) == cells).all()
    least, greatest = VA.lookup_tables(heads, np.ascontiguousarray(borders), x.min(0), x.max(0))
    point = heads.mean(0).astype(np.int64)
    exact = ((x[:, None] - heads[None]) ** 2).sum(2) - ((x - point) ** 2).sum(1)[:, None]
    low = sum(least[d][cells[:, d]] for d in range(8))
    high = sum(greatest[d][cells[:, d]] for d in range(8))
    assert (low <= exact).all() and (exact <= high).all()
    sure = VA.certain(cells, least, greatest)
    assert (sure >= 0).mean() > 0.9 and (sure[sure >= 0] == exact.argmin(1)[sure >= 0]).all()
