"""Exact range join of embeddings by cosine, partitioned by pivots.

On unit vectors cosine >= c is Euclidean distance <= r = sqrt(2 - 2c), a metric. Every vector is at home in the
cell of its nearest pivot. A vector x can only meet a vector at home in cell j if d(x, p_j) <= d(x, p_home) + 2r
(two triangles over the pivots) and d(x, p_j) <= radius_j + r, so it is replicated to just those cells, and only
to cells numbered below its own: each pair is met once. Cells join independently, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklake.llm.common import materialize
from blocklake.llm.components import connected_components

CELL = 4096  # vectors a cell should hold on average, and rows of a home block
OUTER = 8192  # rows of a block of replicated vectors
PIVOT_BYTES = 32 << 20  # bound of the pivot matrix, which every task holds
STRIP = 512
SLACK = 1e-9  # bounds are widened by this much, so rounding never prunes a link


def unit(vectors: pd.Series, dim: int) -> np.ndarray:
    """Unit rows in double precision, padded with zeros to `dim`; scaled first, so squares stay in range."""
    lens = vectors.str.len().to_numpy()
    if (lens == dim).all():
        x = np.stack(vectors.to_numpy()).astype(np.float64)
    else:
        x = np.zeros((len(vectors), dim))
        for i, v in enumerate(vectors):
            x[i, : len(v)] = v
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ p.T), 0.0))


def _pair_task(dim: int, cosine: float):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        x = g[g["side"] == 0]
        same = bool(g["hb"].iat[0] == -1 - g["ob"].iat[0])
        y = x if same else g[g["side"] == 1]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
        ux, lx = unit(x["embedding"], dim), x["embedding"].str.len().to_numpy()
        uy, ly = (ux, lx) if same else (unit(y["embedding"], dim), y["embedding"].str.len().to_numpy())
        wx, wy = x["w"].to_numpy(), y["w"].to_numpy()
        off = 0 if same else len(x)
        label = np.arange(len(x) + (0 if same else len(y)))
        n = np.zeros(len(label), np.int64)
        for s in range(0, len(x), STRIP):
            hit = (ux[s : s + STRIP] @ uy.T >= cosine) & (lx[s : s + STRIP, None] == ly[None, :])
            if same:
                hit &= np.arange(s, s + len(hit))[:, None] < np.arange(len(y))[None, :]
            i, j = np.nonzero(hit)
            np.add.at(n, i + s, wy[j])
            np.add.at(n, j + off, wx[i + s])
            for k in np.unique(i):
                both = np.append(j[i == k] + off, k + s)
                roots = np.unique(label[both])
                if len(roots) > 1:
                    label[np.isin(label, roots)] = roots[0]
        ids = x["cid"].to_numpy() if same else np.concatenate([x["cid"].to_numpy(), y["cid"].to_numpy()])
        linked = np.flatnonzero(n)
        return pd.DataFrame({"a": ids[linked], "b": ids[label[linked]], "n": n[linked]}, dtype="int64")

    return run


def cosine_links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                 cosine: float = 0.9) -> DataFrame:
    """Per vector row: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of other
    lengths have no cosine and do not link. Rows with equal vectors are one class during the join and count as
    linked with one another. `component_id` is the smallest id reachable (nulls apart). Only the named columns
    are read; an empty table gives no rows. The pivots are a bounded sample (one per 4,096 classes, at most
    32 MiB) and change only the work, never the result: every vector is compared.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    some = F.exists("embedding", lambda v: v != 0)
    exact = F.transform("embedding", lambda v: v + F.lit(0.0).cast("float"))  # -0.0 and 0.0 are one value
    ok = F.coalesce(~bad & some, F.lit(False))
    rows = rows.withColumn("k1", F.when(ok, F.xxhash64(exact))).withColumn("k2", F.when(ok, F.xxhash64(F.lit(1), exact)))
    good = rows.where("k1 IS NOT NULL")
    classes = good.groupBy("k1", "k2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("w"),
                                           F.first("embedding").alias("embedding"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    total, dim = classes.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if not total:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))

    many = max(1, min(-(-total // CELL), PIVOT_BYTES // (8 * dim)))
    picked = classes.orderBy(F.xxhash64("k1"), "k2").limit(many).select("embedding").toPandas()
    pivots = unit(picked["embedding"], dim)
    reach = float(np.sqrt(2.0 - 2.0 * cosine)) + SLACK

    def settle(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in it:
            if len(p):
                d = distances(unit(p["embedding"], dim), pivots)
                yield p.assign(home=d.argmin(1).astype("int32"), dh=d.min(1))

    kind = classes.schema["embedding"].dataType.simpleString()
    homes = materialize(classes.select("cid", "w", "embedding").mapInPandas(
        settle, f"cid long, w long, embedding {kind}, home int, dh double"), "homes")
    radius = np.full(many, -np.inf)
    for r in homes.groupBy("home").agg(F.max("dh").alias("r")).collect():  # one row per pivot
        radius[r["home"]] = r["r"]

    def replicate(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell = np.arange(many)
        for p in it:
            if len(p):
                d, home = distances(unit(p["embedding"], dim), pivots), p["home"].to_numpy()[:, None]
                near = (d <= p["dh"].to_numpy()[:, None] + 2 * reach) & (d <= radius + reach) & (cell < home)
                yield p[["cid", "w", "embedding", "home"]].assign(cells=[np.flatnonzero(x).astype("int32") for x in near])

    spread = materialize(homes.mapInPandas(
        replicate, f"cid long, w long, embedding {kind}, home int, cells array<int>"), "replicas")
    inner = spread.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("hbs"))
    outer = spread.select(F.explode("cells").alias("cell")).groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / OUTER).cast("int").alias("obs"))
    sizes = F.broadcast(materialize(inner.join(outer, "cell", "left").select(  # one row per pivot
        "cell", "hbs", F.coalesce("obs", F.lit(0)).alias("obs")), "cells"))

    spot = lambda hb, ob, side: F.struct(hb.alias("hb"), ob.alias("ob"), F.lit(side).alias("side"))
    slot = lambda n: F.pmod(F.xxhash64("cid"), n).cast("int")
    mine, upto = slot(F.col("hbs")), lambda n: F.sequence(F.lit(0), n - 1)
    none = F.array().cast("array<struct<hb:int,ob:int,side:int>>")
    # Block hb of a cell's own vectors meets every block of replicas (ob >= 0) and its own blocks from itself on.
    as_home = F.concat(
        F.when(F.col("obs") > 0, F.transform(upto(F.col("obs")), lambda o: spot(mine, o, 0))).otherwise(none),
        F.transform(F.sequence(mine, F.col("hbs") - 1), lambda o: spot(mine, -1 - o, 0)),
        F.transform(F.filter(upto(F.col("hbs")), lambda h: h < mine), lambda h: spot(h, -1 - mine, 1)))
    as_replica = F.transform(upto(F.col("hbs")), lambda h: spot(h, slot(F.col("obs")), 1))
    task = ["cid", "w", "embedding", "cell"]
    at_home = spread.select("cid", "w", "embedding", F.col("home").alias("cell")).join(sizes, "cell").select(
        *task, F.inline(as_home))
    abroad = spread.select("cid", "w", "embedding", F.explode("cells").alias("cell")).join(sizes, "cell").select(
        *task, F.inline(as_replica))
    links = materialize(at_home.union(abroad).groupBy("cell", "hb", "ob").applyInPandas(
        _pair_task(dim, cosine), "a long, b long, n long"), "links")

    comps = connected_components(links)
    counts = links.groupBy("a").agg(F.sum("n").alias("n"))
    named = classes.join(comps, F.col("cid") == F.col("node"), "left").join(counts, F.col("cid") == F.col("a"), "left")
    named = named.select("k1", "k2", "least", F.coalesce("component", "cid").alias("comp"),
                         (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    found = materialize(named.join(least, "comp").select("k1", "k2", "n_links", "component_id"), "found")
    out = rows.select("vec_id", "k1", "k2").join(found, ["k1", "k2"], "left")
    cid = F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), cid.alias("component_id"),
                      F.col("vec_id").eqNullSafe(cid).alias("kept"))
