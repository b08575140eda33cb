"""Native decoding of the binary file-upload record (FS-1).

Record layout (all integers little-endian, strings/byte vectors prefixed by a u32 length, an option by
one byte 0/1):

    tag u8 = 0  Simple : path string, option( mime string, content bytes )
    tag u8 = 1  Partial: path string, offset u32, full_size u32, mime string, chunk bytes, nonce u32

Decoding is a chain of projections over `substring`/`hex`/`conv`, so no blob leaves the JVM. Every read
is guarded by the record length (a hostile u32 never reaches a narrowing cast), strings must be valid
UTF-8, and a record must be consumed exactly: anything else decodes to `ok = false`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklake.functions.fence import fence


def read_bytes(data: Column, pos: Column, n: Column | int) -> Column:
    """`n` bytes at 1-based `pos`; null when a position or length does not fit an int.

    A read running past the end comes back short; that is caught once, by the check that a record is
    consumed exactly, so each position is referenced a single time here. Keeping every position
    single-use matters: the optimizer substitutes aliases when it pushes filters down, and a position
    used k times per read would grow the expression by k at every level of the record.
    """
    n_col = n if isinstance(n, Column) else F.lit(n)
    return data.substr(pos.try_cast("int"), n_col.try_cast("int"))


def read_u8(data: Column, pos: Column) -> Column:
    return F.conv(F.hex(read_bytes(data, pos, 1)), 16, 10).cast("long")


def read_u32le(data: Column, pos: Column) -> Column:
    # Little-endian: reverse the hex digits, then swap each digit pair back into a byte.
    le_hex = F.regexp_replace(F.reverse(F.hex(read_bytes(data, pos, 4))), "(.)(.)", "$2$1")
    return F.conv(le_hex, 16, 10).cast("long")


def _utf8(b: Column) -> Column:
    s = b.cast("string")
    return F.when(F.is_valid_utf8(s), s)


def decode_upload(df: DataFrame, data: str = "data") -> DataFrame:
    """Add the decoded record as `u_ok, u_kind, u_has_content, u_path, u_offset, u_full, u_mime,
    u_content, u_nonce`. kind: 0 Simple, 1 Partial; `u_has_content` tells a Simple upload from a deletion.
    """
    d, c = F.col(data), F.col
    # Each level reads the previous level's fields as plain columns (see functions.fence), so the
    # expression code grows with the sum of the levels, not their product.
    one = F.lit(1).cast("long")
    # Level 1: tag, path length, end of path.
    x = fence(df, _tag=read_u8(d, one), _p=F.lit(6).cast("long") + read_u32le(d, one + 1))
    # Level 2: Simple option byte + mime length; Partial offset, full_size, mime length.
    is_p = c("_tag") == 1
    x = fence(
        x,
        _opt=F.when(c("_tag") == 0, read_u8(d, c("_p"))),
        _s_mlen=read_u32le(d, c("_p") + 1),
        _offset=read_u32le(d, c("_p")),
        _full=read_u32le(d, c("_p") + 4),
        _p_mlen=read_u32le(d, c("_p") + 8),
    )
    # Level 3: content / chunk lengths.
    x = fence(x, _s_q=c("_p") + 5 + c("_s_mlen"), _p_q=c("_p") + 12 + c("_p_mlen"))
    x = fence(x, _s_clen=read_u32le(d, c("_s_q")), _p_clen=read_u32le(d, c("_p_q")))
    # Level 4: payloads, nonce and the end of the record.
    x = fence(x, _p_r=c("_p_q") + 4 + c("_p_clen"))
    opt1 = c("_opt") == 1
    mime_b = F.when(is_p, read_bytes(d, c("_p") + 12, c("_p_mlen"))).when(opt1, read_bytes(d, c("_p") + 5,
                                                                                             c("_s_mlen")))
    x = fence(
        x,
        _path=_utf8(read_bytes(d, F.lit(6).cast("long"), c("_p") - 6)),
        _mime=_utf8(mime_b),
        _content=F.when(is_p, read_bytes(d, c("_p_q") + 4, c("_p_clen"))).when(
            opt1, read_bytes(d, c("_s_q") + 4, c("_s_clen"))),
        _nonce=F.when(is_p, read_u32le(d, c("_p_r"))),
        _end=F.when(c("_tag") == 0, F.when(c("_opt") == 0, c("_p") + 1).when(opt1, c("_s_q") + 4 + c("_s_clen")))
        .when(is_p, c("_p_r") + 4),
    )
    # Exact consumption covers every read: a short read pushes `_end` past the record.
    ok = ((c("_end") - 1 == F.octet_length(d)) & c("_path").isNotNull()
          & (~opt1 | c("_mime").isNotNull()) & (~is_p | (c("_mime").isNotNull() & c("_nonce").isNotNull())))
    out = fence(
        x,
        u_ok=F.coalesce(ok, F.lit(False)),
        u_kind=c("_tag").cast("int"),
        u_has_content=F.coalesce((c("_tag") == 0) & opt1, F.lit(False)),
        u_path=c("_path"),
        u_offset=F.when(is_p, c("_offset")).otherwise(F.lit(0).cast("long")),
        u_full=F.when(is_p, c("_full")).when(opt1, c("_s_clen")).otherwise(F.lit(0).cast("long")),
        u_mime=c("_mime"),
        u_content=c("_content"),
        u_nonce=F.when(is_p, c("_nonce")).otherwise(F.lit(0).cast("long")),
    )
    fields = ["u_ok", "u_kind", "u_has_content", "u_path", "u_offset", "u_full", "u_mime", "u_content", "u_nonce"]
    return out.select(*[F.col(f"`{n}`") for n in [*df.columns, *fields]])


def u32le(n: Column) -> Column:
    """Encode a non-negative long below 2^32 as 4 little-endian bytes (used to build fixtures)."""
    h = F.lpad(F.hex(n.cast("long")), 8, "0")
    return F.unhex(F.concat(h.substr(7, 2), h.substr(5, 2), h.substr(3, 2), h.substr(1, 2)))


def encode_simple(path: Column, mime: Column | None, content: Column | None) -> Column:
    """Binary Simple record; `content=None` gives a deletion marker."""
    p = F.encode(path, "UTF-8")
    head = F.concat(F.unhex(F.lit("00")), u32le(F.octet_length(p)), p)
    if content is None:
        return F.concat(head, F.unhex(F.lit("00")))
    m = F.encode(mime, "UTF-8")
    return F.concat(head, F.unhex(F.lit("01")), u32le(F.octet_length(m)), m, u32le(F.octet_length(content)),
                    content)


def encode_partial(path: Column, offset: Column, full_size: Column, mime: Column, chunk: Column,
                   nonce: Column) -> Column:
    p = F.encode(path, "UTF-8")
    m = F.encode(mime, "UTF-8")
    return F.concat(F.unhex(F.lit("01")), u32le(F.octet_length(p)), p, u32le(offset), u32le(full_size),
                    u32le(F.octet_length(m)), m, u32le(F.octet_length(chunk)), chunk, u32le(nonce))
