"""Property tests: native column expressions vs small Python models of the documented rules (D13, D18, D3).

Strings are drawn from alphabets dense in separators and dots so the edge cases (empty, `.`, `..`
segments, leading/trailing separators) come up often. One Spark job checks a whole batch of examples.
"""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from blocklake.functions.columns import edge_of, is_valid_suffix
from blocklake.functions.paths import is_valid_relative_path


def model_edge(key: str, pred: str):
    k = key.lstrip("/")
    segs = k.split("/")
    if len(segs) < 2 or not pred:
        return None
    target, edge_type = segs[-1], "/".join(segs[:-1])
    if not target or not edge_type:
        return None
    return edge_type, pred, target


def model_path(p: str) -> bool:
    if not (1 <= len(p.encode("utf-8")) <= 1024):
        return False
    if any(not (0x20 <= ord(c) <= 0x7E) or c == "%" for c in p):
        return False
    for sep in ("/", "\\"):
        if any(seg in ("", ".", "..") for seg in p.split(sep)):
            return False
    return True


def model_suffix(s: str) -> bool:
    return re.fullmatch(r"[A-Za-z0-9_-]{1,64}", s) is not None


KEYS = st.text(alphabet="ab/.", max_size=8)
PATHS = st.text(alphabet="ab/\\.%\x00é ", max_size=8)
SUFFIXES = st.text(alphabet="ab9_-* \n", max_size=6)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(KEYS, st.sampled_from(["", "p.near"])), min_size=1, max_size=60))
def test_edge_matches_model(spark, cases):
    df = spark.createDataFrame(cases, "key string, predecessor_id string")
    for r in df.select("key", "predecessor_id", edge_of("key", "predecessor_id").alias("e")).collect():
        got = None if r.e is None else (r.e.edge_type, r.e.source, r.e.target)
        assert got == model_edge(r.key, r.predecessor_id), (r.key, r.predecessor_id)


@settings(max_examples=25, deadline=None)
@given(st.lists(PATHS, min_size=1, max_size=60))
def test_path_matches_model(spark, paths):
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for r in df.select("p", is_valid_relative_path("p").alias("ok")).collect():
        assert r.ok is model_path(r.p), repr(r.p)


@settings(max_examples=15, deadline=None)
@given(st.lists(SUFFIXES, min_size=1, max_size=60))
def test_suffix_matches_model(spark, suffixes):
    df = spark.createDataFrame([(s,) for s in suffixes], "suffix string")
    for r in df.select("suffix", is_valid_suffix().alias("ok")).collect():
        assert r.ok is model_suffix(r.suffix), repr(r.suffix)


U32 = st.integers(min_value=0, max_value=2**32 - 1)
TEXT = st.text(alphabet="ab/._é\x01", max_size=6)
BYTES = st.binary(max_size=12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.booleans(), TEXT, TEXT, BYTES, U32, U32, U32), min_size=1, max_size=40))
def test_binary_records_round_trip(spark, records):
    """Encode records natively, decode them natively: every field comes back, and truncating a record by
    one byte always makes it undecodable."""
    from pyspark.sql import functions as F

    from blocklake.functions.binary import decode_upload, encode_partial, encode_simple

    rows = [(i, partial, path, mime, bytearray(body), off, full, nonce)
            for i, (partial, path, mime, body, off, full, nonce) in enumerate(records)]
    df = spark.createDataFrame(rows, "i int, partial boolean, path string, mime string, body binary, "
                                     "off long, full long, nonce long")
    rec = F.when(F.col("partial"), encode_partial(F.col("path"), F.col("off"), F.col("full"), F.col("mime"),
                                                  F.col("body"), F.col("nonce")))
    rec = rec.otherwise(encode_simple(F.col("path"), F.col("mime"), F.col("body")))
    enc = df.withColumn("data", rec)
    out = {r.i: r for r in decode_upload(enc).collect()}
    for i, partial, path, mime, body, off, full, nonce in rows:
        r = out[i]
        assert r.u_ok and r.u_kind == (1 if partial else 0)
        assert (r.u_path, r.u_mime, bytes(r.u_content)) == (path, mime, bytes(body))
        if partial:
            assert (r.u_offset, r.u_full, r.u_nonce) == (off, full, nonce)
        else:
            assert r.u_has_content and r.u_full == len(body)
    cut = enc.withColumn("data", F.expr("substring(data, 1, octet_length(data) - 1)"))
    assert all(not r.u_ok for r in decode_upload(cut).collect())
