"""MinHash near-duplicates with sequential Bayesian verification.

Texts become sets of word shingles; equal sets are one class from then on. Signatures are cut into bands, and
classes that agree on a band are candidates. Their signatures are compared batch by batch: after n hashes with m
matches a pair goes as soon as the posterior probability (uniform prior) that its similarity reaches the threshold
falls below `miss`. Survivors are decided on the full sets.

Components need connectivity, not all pairs. First each bucket of a band is tested as a star around its smallest
class. Buckets whose classes are then all connected are done. In the others every pair of classes that are still
apart and meet in no earlier band is tested, in blocks of bounded size spread over tasks; only edges that join
two components leave a task. So a group of thousands of copies costs its size, and no link between components
is left out because of a bucket's size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklake.llm.common import materialize, short_batches, sized, text_key
from blocklake.llm.components import connected_components
from blocklake.llm.shingles import batches, minhash, shingle_sets

BANDS, ROWS = 30, 5  # a pair of similarity 0.8 shares no band once in 150,000 pairs
BATCH = 25  # hashes compared between two looks at the posterior
MISS = 1e-4  # chance, under the posterior, that a pruned pair reaches the threshold
BLOCK = 1024  # classes of one side of a task in an unresolved bucket


def prune_bounds(hashes: int, batch: int, threshold: float, miss: float) -> dict[int, int]:
    """For each look after n hashes, the fewest matches with posterior P(similarity >= threshold) >= miss.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1); its tail above t is P(Binomial(n + 1, t) <= m).
    """
    out = {}
    for n in [*range(batch, hashes, batch), hashes]:
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def sequential(a: np.ndarray, b: np.ndarray, bounds: dict[int, int]) -> np.ndarray:
    """Row numbers of the signature pairs (a[i], b[i]) that no look prunes."""
    left, matches, at = np.arange(len(a)), np.zeros(len(a), np.int32), 0
    for n, least in bounds.items():
        matches = matches + (a[left, at:n] == b[left, at:n]).sum(1)
        keep = matches >= least
        left, matches, at = left[keep], matches[keep], n
    return left


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity, in integers."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(docs: DataFrame, width: int, hashes: int) -> DataFrame:
    """(doc_id, tk, n, cls, sig) per row: set size, 128-bit digest of the whole set, signature (null: no words)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            at = 0
            for texts in batches(x.as_buffer() if x.is_valid else None for x in rb.column(2)):
                sets = shingle_sets(texts, width)
                sigs = minhash(sets, hashes).view(np.int32)
                part = rb.slice(at, len(texts))
                at += len(texts)
                cls = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(cls, pa.binary()),
                    pa.array([g if len(s) else None for g, s in zip(sigs, sets, strict=True)], pa.list_(pa.int32())),
                ], ["doc_id", "tk", "n", "cls", "sig"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tk long, n long, cls binary, sig array<int>"
    return docs.select("doc_id", text_key(F.col("text")).alias("tk"), F.col("text").cast("binary")).mapInArrow(
        run, schema)


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cid, shingles) of the wanted classes, read again from the text of one of their rows."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            at = 0
            for texts in batches(x.as_buffer() if x.is_valid else None for x in rb.column(1)):
                sets = [s.view(np.int64) for s in shingle_sets(texts, width)]
                yield pa.RecordBatch.from_arrays([rb.column(0).slice(at, len(texts)),
                                                  pa.array(sets, pa.list_(pa.int64()))], ["cid", "shingles"])
                at += len(texts)

    keyed = docs.select(F.col("doc_id").alias("d"), text_key(F.col("text")).alias("k"), "text")
    hit = keyed.join(sized(wanted), (F.col("k") == F.col("tk")) & F.col("d").eqNullSafe(F.col("doc_id")))
    return hit.select("cid", F.col("text").cast("binary")).mapInArrow(run, "cid long, shingles array<long>")


def _bayes(pairs: DataFrame, bounds: dict[int, int]) -> DataFrame:
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in it:
            if len(p):
                left = sequential(np.stack(p["sig_a"].to_numpy()), np.stack(p["sig_b"].to_numpy()), bounds)
                yield p.iloc[left][["a", "b"]]

    return pairs.mapInPandas(run, "a long, b long")


def _block_task(bounds: dict[int, int], bands: int, rows: int, percent: int):
    """Test the pairs of one (rest block, other block) of an unresolved bucket; return the edges that join."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.drop_duplicates(["cid", "side"])
        x, y = g[g["side"] == 0], g[g["side"] == 1]
        if not len(x) or not (len(y) or g["i"].iat[0] == g["j"].iat[0]):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        y = y if len(y) else x
        band = int(g["band"].iat[0])
        sx, sy = (np.stack(s["sig"].to_numpy()).astype(np.int32) for s in (x, y))
        cx, cy = x["comp"].to_numpy(), y["comp"].to_numpy()
        ix, iy = x["cid"].to_numpy(), y["cid"].to_numpy()
        tx, ty = x["shingles"].to_numpy(), y["shingles"].to_numpy()
        nx, ny = np.array([len(t) for t in tx]), np.array([len(t) for t in ty])
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        out = []
        for i in range(len(x)):
            ok = (cy != cx[i]) & (100 * np.minimum(ny, nx[i]) >= percent * np.maximum(ny, nx[i]))
            if y is x:
                ok[: i + 1] = False
            for b in range(band):
                ok &= (sy[:, b * rows : (b + 1) * rows] != sx[i, b * rows : (b + 1) * rows]).any(1)
                if not ok.any():
                    break
            js = np.flatnonzero(ok)
            js = js[sequential(np.broadcast_to(sx[i], (len(js), sx.shape[1])), sy[js], bounds)] if len(js) else js
            for j in js:
                p, q = find(int(cx[i])), find(int(cy[j]))
                if p != q and similar(tx[i], ty[j], percent):
                    root[max(p, q)] = min(p, q)
                    out.append((int(ix[i]), int(iy[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS, batch: int = BATCH, miss: float = MISS) -> DataFrame:
    """Per document row: doc_id, text_key, n_shingles, component_id, kept, group (a number per component).

    Words are split at ASCII white space after lower-casing A-Z; a text of fewer than `width` words is one
    shingle. Null texts and texts without words have no shingles, link with nothing and stay (component_id is
    their own id). Rows with equal sets are always in one component. Repeated ids are judged row by row; the
    component's id is the smallest id among its rows, nulls apart (null if it has no other). Only the named
    columns are read. Long texts cost memory in proportion to themselves, one at a time. Empty tables give none.
    """
    hashes = bands * rows
    docs = short_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    rowsof = materialize(sketch(docs, width, hashes), "sketch")
    classes = rowsof.where("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("least"), F.max("n").alias("n"), F.first(F.struct("doc_id", "tk", "sig")).alias("one"))
    classes = materialize(classes.select("cls", F.monotonically_increasing_id().alias("cid"), "least", "n", "one.*"),
                          "classes")

    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(
        b.alias("band"), F.xxhash64(b, F.slice("sig", b * rows + 1, rows)).alias("key")))
    banded = classes.select("cid", F.inline(keys))
    hubs = materialize(banded.groupBy("band", "key").agg(F.min("cid").alias("rep"), F.count(F.lit(1)).alias("m")).where(
        "m > 1"), "buckets")
    members = materialize(banded.join(sized(hubs), ["band", "key"]), "members")

    bounds = prune_bounds(hashes, batch, percent / 100, miss)
    star = members.where("cid != rep").select(F.col("rep").alias("a"), F.col("cid").alias("b")).distinct()
    side = lambda s: classes.select(F.col("cid").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))
    star = star.join(side("b"), "b").join(side("a"), "a").where(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    left = materialize(_bayes(star.select("a", "b", "sig_a", "sig_b"), bounds), "survivors")

    wanted = materialize(classes.join(members.select("cid").distinct(), "cid").select("cid", "doc_id", "tk"), "wanted")
    sets = materialize(_sets_of(docs, wanted, width), "sets")
    of = lambda s: sets.select(F.col("cid").alias(s), F.col("shingles").alias(f"set_{s}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    edges = materialize(left.join(of("b"), "b").join(of("a"), "a").where(
        both * 100 >= (F.size("set_a") + F.size("set_b") - both) * percent).select("a", "b").distinct(), "links")
    comps = materialize(connected_components(edges), "stars")

    tagged = members.join(comps, F.col("cid") == F.col("node"), "left").select(
        "band", "key", "cid", F.coalesce("component", "cid").alias("comp"))
    parts = tagged.groupBy("band", "key", "comp").agg(F.count(F.lit(1)).alias("c"))
    open_ = materialize(parts.groupBy("band", "key").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"), F.max("c").alias("n_main"), F.sum("c").alias("m"),
        F.count(F.lit(1)).alias("comps")).where("comps > 1 AND m > 2").select(
            "band", "key", "main", F.ceil(F.col("n_main") / BLOCK).cast("int").alias("mains"),
            F.ceil((F.col("m") - F.col("n_main")) / BLOCK).cast("int").alias("rests")), "open")
    if not open_.isEmpty():
        t = tagged.join(sized(open_), ["band", "key"])
        slot = lambda n: F.pmod(F.xxhash64("cid"), n).cast("int")
        spot = lambda i, j, s: F.struct(i.alias("i"), j.alias("j"), F.lit(s).alias("side"))
        rest, mine = F.col("comp") != F.col("main"), slot(F.col("rests"))
        upto = lambda n: F.sequence(F.lit(0), n - 1)
        # A rest block i meets every main block (j < 0) and every rest block j >= i.
        as_main = F.transform(upto(F.col("rests")), lambda i: spot(i, -1 - slot(F.col("mains")), 1))
        as_rest = F.concat(
            F.transform(upto(F.col("mains")), lambda j: spot(mine, -1 - j, 0)),
            F.transform(F.sequence(mine, F.col("rests") - 1), lambda j: spot(mine, j, 0)),
            F.transform(F.filter(upto(F.col("rests")), lambda i: i < mine), lambda i: spot(i, mine, 1)))
        t = t.select("band", "key", "cid", "comp", F.inline(F.when(rest, as_rest).otherwise(as_main)))
        t = t.join(classes.select("cid", "sig"), "cid").join(sets, "cid")
        more = t.groupBy("band", "key", "i", "j").applyInPandas(
            _block_task(bounds, bands, rows, percent), "a long, b long")
        known = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
        comps = materialize(connected_components(known.union(more)), "components")

    named = classes.join(comps, F.col("cid") == F.col("node"), "left").select(
        "cls", "least", F.coalesce("component", "cid").alias("comp"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    found = materialize(named.join(least, "comp").select("cls", "component_id", F.col("comp").alias("group")), "named")
    out = rowsof.select("doc_id", "tk", "n", "cls").join(found, "cls", "left")
    cid = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("tk").alias("text_key"), F.col("n").alias("n_shingles"),
                      cid.alias("component_id"), F.col("doc_id").eqNullSafe(cid).alias("kept"), "group")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5,
                         percent: int = 80) -> DataFrame:
    """The documents with one row left of each group of near-duplicates, all columns as they were.

    The row that stays is the first by (id, text key); of rows that repeat id and text any one. Texts without
    words are in no group and all stay.
    """
    marks = materialize(near_duplicates(docs, doc_id, text, width, percent), "near-marks")
    one = marks.where("n_shingles > 0").groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("one"))
    none = marks.where("n_shingles = 0").select("doc_id", "text_key").distinct()
    keep = one.select("one.*").union(none).select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"))
    rows = docs.select(F.struct("*").alias("_r"))
    rows = rows.join(sized(materialize(keep, "near-kept")), F.col(f"_r.`{doc_id}`").eqNullSafe(F.col("_d"))
                     & (text_key(F.col(f"_r.`{text}`")) == F.col("_k")))
    if not marks.where("n_shingles > 0").groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        full = rows.join(none.select(F.col("doc_id").alias("_e"), F.col("text_key").alias("_f")),
                         F.col("_d").eqNullSafe(F.col("_e")) & (F.col("_k") == F.col("_f")), "left")
        rows = full.where("_f IS NOT NULL").select("_r").union(
            full.where("_f IS NULL").dropDuplicates(["_d", "_k"]).select("_r"))
    return rows.select("_r.*")
