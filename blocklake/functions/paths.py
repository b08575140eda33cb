"""File-upload predicates (FS-2..FS-5) as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.functions.columns import col

# Fixed patterns. Printable ASCII except `%` (no NUL, control, non-ASCII or URL-encoded bytes).
PATH_CHARS = r"\A[\x20-\x24\x26-\x7e]{1,%d}\z" % S.MAX_RELATIVE_PATH_BYTES
# An empty, `.` or `..` segment when splitting on `/`; and, independently, when splitting on `\`.
BAD_SLASH_SEGMENT = r"(\A|/)\.{0,2}(/|\z)"
BAD_BACKSLASH_SEGMENT = r"(\A|\\)\.{0,2}(\\|\z)"
MIME_CHARS = r"\A[\x20-\x7e]{1,%d}\z" % S.MAX_MIME_TYPE_BYTES


def is_valid_relative_path(path: str | Column = "relative_path") -> Column:
    """FS-2. Leading/trailing separators show up as empty segments, so they need no extra test."""
    p = col(path)
    ok = p.rlike(PATH_CHARS) & ~p.rlike(BAD_SLASH_SEGMENT) & ~p.rlike(BAD_BACKSLASH_SEGMENT)
    return F.coalesce(ok, F.lit(False))


def is_valid_mime(mime: str | Column = "mime_type") -> Column:
    """FS-3: 1-256 printable ASCII bytes."""
    return F.coalesce(col(mime).rlike(MIME_CHARS), F.lit(False))


def is_valid_simple(path: Column, has_content: Column, mime: Column, content_len: Column,
                    max_bytes: int = S.MAX_FILE_BYTES) -> Column:
    """FS-5: path, and when there is content, its MIME and size (at most `max_bytes`)."""
    content_ok = ~has_content | (is_valid_mime(mime) & (content_len <= max_bytes))
    return is_valid_relative_path(path) & F.coalesce(content_ok, F.lit(False))


def is_valid_partial(path: Column, offset: Column, full_size: Column, mime: Column, chunk_len: Column,
                     nonce: Column, alignment: int = S.OFFSET_ALIGNMENT, max_bytes: int = S.MAX_FILE_BYTES) -> Column:
    """FS-4: aligned offset inside the file, 0 < full_size <= max, chunk <= alignment, fits, 1 <= nonce <= i32.

    The chunk alignment and the largest file are limits of their own.
    """
    ok = (
        is_valid_relative_path(path)
        & (offset % alignment == 0) & (offset < max_bytes)
        & (full_size > 0) & (full_size <= max_bytes)
        & is_valid_mime(mime)
        & (chunk_len <= alignment)
        & (offset + chunk_len <= full_size)
        & (nonce >= 1) & (nonce <= S.I32_MAX)
    )
    return F.coalesce(ok, F.lit(False))
