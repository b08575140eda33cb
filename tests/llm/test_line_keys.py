"""The edit join of lines beyond the broadcast: what is moved, what is left, and that no link is lost."""

import os
import random

import pytest
from pyspark.sql import functions as F

from blocklake.llm import line_dedup
from blocklake.llm.line_dedup import line_report
from test_brute_force import _mutated, test_line_report as brute_force


def _exchanged(df):
    """The column names of each exchange in the plan of `df`."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        if "AdaptiveSparkPlan" in plan.nodeName():
            plan = plan.executedPlan()
        if "Exchange" in plan.nodeName():
            out.append({plan.output().apply(i).name() for i in range(plan.output().size())})
        todo += [plan.children().apply(i) for i in range(plan.children().size())]
    return out


@pytest.fixture()
def written(spark, monkeypatch):
    """No broadcast in the line join; by name, the exchanges, rows and folder of each table that it writes."""
    seen, write = {}, line_dedup.materialize

    def noted(df, name, **options):
        exchanged, out = _exchanged(df), write(df, name, **options)
        files = out.inputFiles()
        seen[name] = exchanged, out.count(), os.path.dirname(files[0].removeprefix("file:")) if files else ""
        return out

    monkeypatch.setattr(line_dedup, "materialize", noted)
    monkeypatch.setattr(line_dedup, "sized", lambda df, *rows: df)
    monkeypatch.setattr(line_dedup, "MET_ROWS", -1, raising=False)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield seen
    spark.conf.set(key, old)


def test_text_stays_out_of_the_keys(spark, written):
    """Too many keys for a broadcast: results are the same, and a line's text is not shuffled under each of its keys."""
    brute_force(spark)
    assert any(names for names, _, _ in written.values())
    for name, (exchanged, _, _) in written.items():
        if name != "line-links":  # there lines meet, under the keys that are kept
            assert not [x for x in exchanged if {"line", "key"} <= x], name


def test_near_lines_move_once(spark, written):
    """Lines of a group share two of three segments; their text is moved under one of these keys, then deleted."""
    rng = random.Random(3)
    docs = [(g * 3 + i, "".join(rng.choices("abcdefghijklmnop ", k=60)) + "xyz"[i]) for g in range(50) for i in [0, 1, 2]]
    docs = [(i, docs[i // 3 * 3][1][:-1] + t[-1]) for i, t in docs]
    got = line_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.n_links, r.n_kept) for r in got if r.doc_id % 3} == {(2, 0)}
    assert {(r.n_links, r.n_kept) for r in got if not r.doc_id % 3} == {(2, 1)}
    assert written["near-keys"][1] == len(docs)
    assert not os.path.exists(written["near-keys"][2]) and os.path.exists(written["lines"][2])


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_ends_of_links_meet(spark, threshold):
    """No two lines within the threshold are told apart by their ends."""
    rng = random.Random(threshold)
    lines = ["".join(rng.choices("abc é😀", k=rng.choice([4, 15, 16, 17, 24, 61]))) for _ in range(500)]
    pairs = [(a, _mutated(rng, a, threshold, "abcé")) for a in lines]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.where(~line_dedup._ends_meet(F.col("a"), F.col("b"), threshold)).count() == 0
    assert df.where(line_dedup.within(F.col("a"), F.col("b"), threshold)).count() == len(pairs)
