"""Key, path and record rules on cases generated from the rules themselves, around every limit."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.functions.binary import encode_partial, encode_simple
from blocklake.functions.columns import edge_of, is_deletion
from blocklake.functions.paths import is_valid_mime, is_valid_relative_path
from blocklake.operators.files import classify_uploads


def edge_rule(key, predecessor):
    """Leading slashes go; the last segment is the target, the rest the type; nothing may be empty."""
    head, slash, target = key.lstrip("/").rpartition("/")
    return (head, predecessor, target) if slash and head and target and predecessor else None


def test_edges_follow_the_rule(spark):
    parts = ["", "/", "kind", "kind/of", "x.y", "7"]
    keys = {"/".join(p) for n in (1, 2, 3) for p in itertools.product(parts, repeat=n)}
    cases = [(k, p) for k in sorted(keys) for p in ("", "zoe.acc")]
    df = spark.createDataFrame(cases, "key string, predecessor_id string")
    for r in df.select("*", edge_of("key", "predecessor_id").alias("e")).collect():
        got = None if r.e is None else (r.e.edge_type, r.e.source, r.e.target)
        assert got == edge_rule(r.key, r.predecessor_id), (r.key, r.predecessor_id)


def test_only_bare_null_deletes(spark):
    values = ["null", "Null", " null", "nul", '"null"', "0", "{}", "false", '""']
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert [r.value for r in df.where(is_deletion("value")).collect()] == ["null"]


def path_rule(p):
    if not 1 <= len(p.encode()) <= S.MAX_RELATIVE_PATH_BYTES or any(not 0x20 <= ord(c) <= 0x7E or c == "%" for c in p):
        return False
    return all(seg not in ("", ".", "..") for sep in "/\\" for seg in p.split(sep))


def test_paths_follow_the_rule(spark):
    rng = random.Random(11)
    segments = ["a", "doc.md", ".", "..", "", "...", "b c", "%41", "ü", "\x7f", "\t", "c:", ".d", "e."]
    paths = {rng.choice("/\\/").join(rng.choices(segments, k=rng.randrange(1, 5))) for _ in range(600)}
    paths |= {"q" * n for n in (1, 1023, 1024, 1025)} | {"a/" * 511 + "bb", "a/" * 512 + "b"}
    df = spark.createDataFrame([(p,) for p in sorted(paths)], "p string")
    got = dict(df.select("p", is_valid_relative_path("p")).collect())
    assert {p for p, ok in got.items() if ok} == {p for p in paths if path_rule(p)}
    assert 20 < sum(got.values()) < len(got) - 20


def test_mime_limits(spark):
    cases = {"m/" + "x" * 254: True, "m/" + "x" * 255: False, "": False, "a\x1fb": False, "café": False, " ": True}
    df = spark.createDataFrame([(m,) for m in cases], "m string")
    assert dict(df.select("m", is_valid_mime("m")).collect()) == cases


def _reasons(spark, records, alignment, max_bytes):
    rows = [(name, spark.range(1).select(col).first()[0]) for name, col in records.items()]
    out = classify_uploads(spark.createDataFrame(rows, "name string, data binary"), alignment, max_bytes)
    return {r.name: r.reason for r in out.select("name", "reason").collect()}


def _bytes(n):
    return F.repeat(F.lit("z"), n).cast("binary") if n else F.lit("").cast("binary")


def test_simple_size_limit_is_its_own(spark):
    """The largest file does not depend on the chunk alignment."""
    t = F.lit("t/t")
    recs = {f"n{n}": encode_simple(F.lit("p"), t, _bytes(n)) for n in (0, 1, 64, 65)}
    recs |= {"gone": encode_simple(F.lit("p"), None, None), "up": encode_simple(F.lit("../p"), t, _bytes(1)),
             "mime": encode_simple(F.lit("p"), F.lit(""), _bytes(1))}
    want = {"n0": None, "n1": None, "n64": None, "n65": "invalid_simple", "gone": None, "up": "invalid_simple",
            "mime": "invalid_simple"}
    for alignment in (2, 8, 1 << 20):
        assert _reasons(spark, recs, alignment, 64) == want


@pytest.mark.parametrize("field, good, bad", [
    ("offset", (0, 8, 56), (3, 64, 72)), ("full", (61, 64), (0, 65, 58)), ("nonce", (1, S.I32_MAX), (0, S.I32_MAX + 1)),
    ("chunk", (0, 1, 5), (9, 6))])
def test_partial_limits(spark, field, good, bad):
    """One field at a time around its limit: alignment 8, files of at most 64 bytes."""
    base = {"offset": 56, "full": 61, "nonce": 3, "chunk": 5}

    def rec(v):
        f = {**base, field: v}
        return encode_partial(F.lit("d/p"), F.lit(f["offset"]), F.lit(f["full"]), F.lit("t/t"), _bytes(f["chunk"]),
                              F.lit(f["nonce"]).cast("long"))

    got = _reasons(spark, {str(v): rec(v) for v in (*good, *bad)}, 8, 64)
    assert got == {str(v): None for v in good} | {str(v): "invalid_partial" for v in bad}
