"""An optimizer fence for expensive per-row values (parsed JSON, decoded records).

Catalyst pushes a filter below the projections that define its columns by substituting their
expressions, so a filter on "the parsed object is an object with <= 256 keys" would re-run the parse
inside its condition, once per reference. Passing the rows through a one-element explode stops that:
filters are not pushed through a Generate and projections are not collapsed across it, so each
value is computed once and later operators read it as a plain column. The explode is narrow (one
row in, one row out) and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame, **cols: Column) -> DataFrame:
    """Add `cols` to `df`, computed exactly once per row; filters on them stay above, others still sink.

    Only the new values pass through the explode: a filter on a column of `df` is pushed below it to the
    scan, and columns nobody reads afterwards are pruned.
    """
    new = F.struct(*[c.alias(n) for n, c in cols.items()])
    # Computed by a projection of their own: an explode over expressions that have no generated code is interpreted.
    x = df.select("*", new.alias("_new")).select(*df.columns, F.explode(F.array("_new")).alias("_fenced"))
    return x.select(*[F.col(f"`{c}`") for c in df.columns if c not in cols], "_fenced.*")
