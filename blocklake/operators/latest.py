"""Newest-version-wins selection, shared by every versioned table (KV-7/8/12/13/14, FS-8).

`latest_by` is an argmax aggregation: Spark plans it as a partial aggregate before the shuffle and a
final one after, so at most one row per key and map task crosses the network and a hot key (one
account writing a third of all rows) is collapsed map-side instead of landing whole on one reducer.
The version is compared as a struct, never as a packed long (D10), and callers add tie-break columns
so the winner is a total order (D12): the result does not depend on arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per `keys`: the row with the greatest struct(`version`); column order is kept."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    w = F.max_by(F.struct(*others), F.struct(*version)).alias("_w")
    out = df.groupBy(*keys).agg(w)
    return out.select(*[F.col(c) if c in keys else F.col(f"_w.{c}").alias(c) for c in df.columns])
