"""The native strict JSON path against a plain model, on listed, generated and damaged texts."""

import json
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from json_model import strict_object
from pyspark.sql import functions as F

from blocklake.operators import kv as K
from helpers import blobs

TEXTS = [
    '{"a":1.0}', '{"a":-0}', '{"a":-0.0}', '{"a":1e16}', '{"a":1E-7}', '{"a":1e400}', '{"a":-1e-400}', '{"a":0e5}',
    '{"a":18446744073709551615,"b":18446744073709551616,"c":-9223372036854775808,"d":-9223372036854775809}',
    '{"a":5e-324,"b":2.2250738585072014e-308,"c":1.7976931348623157e308,"d":2e23,"e":9007199254740993.0,"f":0.3}',
    '{"a":01}', '{"a":1.}', '{"a":.5}', '{"a":+1}', '{"a":1e}', '{"a":--1}', '{"a":1.2.3}', '{"a":- 1}', '{"a":1 2}',
    '{"a":tr ue}', '{"a":NaN}', '{"a":-Infinity}', '{"a":nul}', '{"a":TRUE}', '{"a":true}', '{"a":[true,false,null]}',
    '{"a":1} x', '{"a":1}{"b":2}', '{"a":[1]}]', '{"a":1},{"b":2}', '[1]', '[1] 2', '[]', '{}', ' {} ', '""', '"a" "b"', '1', '1.5', '1 1',
    'null', 'true', '', ' ', '{', '}{', '{"a"}', '{"a":}', '{"a":1,}', '[1,]', '{a:1}', "{'a':1}", '{"a":"x}', '{"a":1]', '[}',
    '{"a":{"z":1.50,"b":{"y":[{"k":2.0}],"x":[]},"b":{}}}', '{"a":1,"a":{"b":2.5}}', '{"b":[ 1 , { "c" : 1.0 } ] }',
    '{"a":"\\u00e9\\/\\b\\f\\n\\r\\t\\"\\\\"}', '{"a":"\\u001f\\u000b\\u007f\\u0000"}', '{"a":"\\ud83d\\ude00"}', '{"a":"\\ud83d"}',
    '{"a":"\\ude00\\ud83d"}', '{"a":"\\\\ud83d"}', '{"a":"\\\\\\ud83d"}', '{"\\ud800":1}', '{"a":"\\u0001n5"}', '{"a":"\\u0001\\u0001n5"}',
    '{"a":"\\\\u0001n5"}', '{"a":["\\u0001","\\u0001n1.5",1.5]}', '{"a\\u0001b":1,"ok":2}', '{"a":"x\\u0001","b":{"\\u0001k":2.5}}',
    '{"a":"tab\there"}', '{"a":"line\nbreak"}', '{"a":"\\x"}', '{"a":"\\u12"}', '{"a":"é😀"}', '﻿{"a":1}', '{"a":1} ', '{"a": 1.5}',
    '{"a":' + "[" * 126 + "]" * 126 + "}", '{"a":' + "[" * 127 + "]" * 127 + "}", '{"a":' + "[" * 2000 + "]" * 2000 + "}",
    '{"a":"]","b":["[{",1.0]}', '{"a":1.' + "3" * 2000 + "}", '{"a":' + "9" * 500 + "}", '{"a":"' + "\\n" * 20000 + '","b":0.5}',
    '{"a":"' + "x\\\"" * 20000 + '","b":{"c":1}}', '{"A":{"B":1}}', '{"v":"a\\\\","w":1.0}', '{"":{"a":1.0}}',
]


def outcome(spark, texts):
    """Per text: None, "", or its keys and value texts, as the KV operators decide them."""
    rows = [dict(data=t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t, receipt_id=str(i)) for i, t in enumerate(texts)]
    c = K.classify_kv_blobs(blobs(spark, rows))
    reason = {r[0]: r[1] for r in c.select("receipt_id", "reason").collect()}
    pairs = {}
    spelled = c.select("receipt_id", "_plain", F.explode("_obj").alias("key", "_val")).select(
        "receipt_id", *K._pair_columns(spark.sparkContext.applicationId))
    for i, k, v in spelled.collect():
        pairs.setdefault(i, {})[k] = v
    made = {"invalid_json": None, "not_object": ""}
    return [made[r] if (r := reason[str(i)]) in made else pairs.get(str(i), {}) for i in range(len(texts))]


def check(spark, texts):
    for text, got in zip(texts, outcome(spark, texts), strict=True):
        want = strict_object(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text)
        assert got == want, (text[:200], got, want)


def test_listed_texts(spark):
    check(spark, TEXTS + [b'{"a":"\xff"}', b'{"a":1.0,"b":"\xc3\x28"}'])


NUMBERS = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False).map(repr), st.integers(-(2**70), 2**70).map(str),
    st.floats(-1e6, 1e6).map(lambda x: f"{x:.3f}"), st.sampled_from(["1E5", "1e-5", "-0.0", "100e2", "1.10", "0.00001", "123456789.125e-3"]))
STRINGS = st.text(alphabet='ab"\\/\n\t\x00\x01\x1fné😀 {}[]:,0.', max_size=6).map(json.dumps)
VALUES = st.recursive(st.one_of(NUMBERS, STRINGS, st.sampled_from(["true", "false", "null"])), lambda v: st.one_of(
    st.lists(v, max_size=3).map(lambda x: f"[{', '.join(x)}]"),
    st.lists(st.tuples(STRINGS, v), max_size=3).map(lambda x: "{" + ",".join(f"{k} : {w}" for k, w in x) + "}")), max_leaves=8)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(VALUES, VALUES), min_size=20, max_size=60), st.integers(0, 2**32))
def test_generated_and_damaged_texts(spark, pairs, seed):
    rng = random.Random(seed)
    texts = [f'{{"k":{a},"l":{b}}}' for a, b in pairs] + [a for a, _ in pairs]
    for t in list(texts):
        at = rng.randrange(len(t))
        texts.append(rng.choice([t[:at], t[:at] + rng.choice('{}[],:"e.-01 \\') + t[at:], t[:at] + t[at + 1:]]))
    check(spark, texts)


def test_shortest_digits(spark):
    rng = random.Random(4)
    import struct
    numbers = [x for x in (struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)) if x == x and abs(x) < 1e308]
    numbers += [rng.randint(1, 10**6) / 10 ** rng.randint(0, 12) for _ in range(1000)] + [2.0**-n for n in range(1, 1074, 7)]
    check(spark, [f'{{"a":{x!r}}}' for x in numbers])


def test_no_python_worker(spark):
    b = blobs(spark, [dict(data='{"a":{"b":[1.50,{"c":1e16}]}}')])
    plan = K.explode_kv(b)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert [r["value"] for r in K.explode_kv(b).collect()] == ['{"b":[1.5,{"c":1e16}]}']
