"""Column expressions shared by batch and streaming jobs (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blocklake import schemas as S

# Fixed patterns (Java regex; `\A`/`\z` anchors because `$` also matches before a final newline).
SUFFIX_PATTERN = r"\A[A-Za-z0-9_-]{1,64}\z"
CONTROL_CHAR_PATTERN = r"\p{Cc}"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def block_height_bucket(height: str = "block_height") -> Column:
    """PRJ-3: 10,000-block time bucket (exact long division)."""
    return F.expr(f"{_sql(height)} div {S.BLOCK_HEIGHT_BUCKET_SIZE}")


def strip_prefix(method: str = "method_name", prefix: str = S.CALL_PREFIX) -> Column:
    """FLT-2: the suffix when `method` starts with `prefix`, else null."""
    m = col(method)
    return F.when(m.startswith(prefix), F.expr(f"substring({_sql(method)}, {len(prefix) + 1})"))


def is_valid_suffix(suffix: str | Column = "suffix") -> Column:
    """FLT-3: 1-64 chars of [A-Za-z0-9_-]; the universal `*` is excluded by the class."""
    return F.coalesce(col(suffix).rlike(SUFFIX_PATTERN), F.lit(False))


def order_id(shard: str | Column = "shard_id", receipt_index: str | Column = "receipt_index",
             action_index: str | Column = "action_index") -> Column:
    """PRJ-4: (shard*100000 + receipt_index)*1000 + action_index; null when an index is out of range."""
    s, r, a = col(shard), col(receipt_index), col(action_index)
    ok = (r >= 0) & (r < S.MAX_RECEIPT_INDEX) & (a >= 0) & (a < S.MAX_ACTION_INDEX) & (s >= 0)
    return F.when(ok, (s.cast("long") * S.MAX_RECEIPT_INDEX + r) * S.MAX_ACTION_INDEX + a)


def lww_version(height: str | Column = "block_height", oid: str | Column = "order_id") -> Column:
    """PRJ-5: height*10^9 + order_id as one long; ANSI arithmetic raises on overflow.

    Only exported for users of the packed form: comparisons inside the engine use the
    (block_height, order_id) struct, which stays correct once order_id passes 10^9.
    """
    return col(height).cast("long") * S.LWW_HEIGHT_FACTOR + col(oid)


def is_valid_key(key: str | Column = "key") -> Column:
    """KV-4: non-empty, at most 1024 bytes, no Unicode control character (Cc, incl. U+0080-U+009F)."""
    k = col(key)
    return (k != "") & (F.octet_length(k) <= S.MAX_KEY_BYTES) & ~k.rlike(CONTROL_CHAR_PATTERN)


def is_deletion(value: str | Column = "value") -> Column:
    """KV-11: only the 4-character JSON `null` deletes (a quoted "null" does not)."""
    return col(value) == F.lit("null")


def edge_of(key: str | Column = "key", predecessor: str | Column = "predecessor_id") -> Column:
    """KV-10: struct(edge_type, source, target) derived from a key, or null when the key is no edge.

    Leading `/` are trimmed; the last `/`-segment is the target and the rest, joined, the edge type;
    both must be non-empty, as must the source (the predecessor).
    """
    trimmed = F.expr(f"trim(LEADING '/' FROM {_sql(key)})")
    segs = F.split(trimmed, "/", -1)
    n = F.size(segs)
    target = F.element_at(segs, -1)
    edge_type = F.array_join(F.slice(segs, F.lit(1), F.greatest(n - 1, F.lit(0))), "/")
    pred = col(predecessor)
    ok = (n >= 2) & (pred != "") & (target != "") & (edge_type != "")
    return F.when(ok, F.struct(edge_type.alias("edge_type"), pred.alias("source"), target.alias("target")))


def _sql(c: str | Column) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")
