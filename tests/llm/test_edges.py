"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns."""

import random
import re

import pytest
from pyspark.sql import functions as F

from blocklake.llm import decontam, licenses
from blocklake.llm.common import text_key
from blocklake.llm.decontam import decontaminate, drop_contaminated
from blocklake.llm.licenses import scan_licenses
from blocklake.llm.line_dedup import dedup_lines, line_report
from blocklake.llm.metric_join import cosine_links
from blocklake.llm.near_dup import drop_near_duplicates, near_duplicates
from blocklake.llm.packing import pack_documents
from blocklake.llm.pseudonyms import pseudonymize
from blocklake.llm.quality import classify_quality, keep_quality
from blocklake.llm.sentencepiece import decode, encode, load_vocabulary
from blocklake.llm.warc import read_warc, write_warc
from blocklake.session import scratch_path

LONG = "long text of words " * 40_000 + "end\n" * 3
LINE = "a line of well over twenty-four characters"
ROWS = [(1, "under the MIT License\n" + LINE), (2, None), (3, ""), (None, "a text without an id"), (None, None),
        (4, LINE), (4, LINE), (4, "another text under the same id, 4111 1111 1111 1111"), (5, LONG), (6, " \n\t "),
        (7, "one"), (8, LINE + "\n" + LINE), (9, "ONE"), (10, "été ▁ \U0001f600\n")]
EXTRA = ["word", "text_key", "ids", "group", "_r", "cls", "score", "line", "key", "n", "tk", "w", "item", "_score", "_kept"]
BENCH = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in EXTRA]).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.select(column).collect()), key=lambda x: (x is not None, x))


EVERY = sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(1, "ONE"), (1, "ONE"), (2, None), (3, ""), (None, "text without an id"), (4, BENCH)],
                                  "item_id long, text string")
    got = decontaminate(docs, items)
    assert ids(got) == EVERY
    by = {(r.doc_id, r.n_words): r for r in got.collect()}
    assert by[7, 1].contaminated and by[9, 1].contaminated and by[7, 1].n_items == 1
    assert by[None, 5].n_hit == 4 and by[None, 0].n_hit == 0 and not by[2, 0].contaminated
    assert by[5, 160_003].n_hit == 0
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns and not {7, 9} & set(ids(kept)) and kept.count() == len(ROWS) - 3
    assert decontaminate(none, items).count() == 0
    assert decontaminate(docs, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    over = spark.createDataFrame([(1, BENCH + " and " + BENCH), (2, BENCH.replace("seven", "7"))], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in decontaminate(over, items).collect()) == [
        (1, 29, 28, 2), (2, 14, 1, 1)]


def test_decontaminate_beyond_the_broadcast(spark, docs, none, monkeypatch):
    """An index that is joined by shuffle gives the rows of the broadcast one, without texts beside their words."""
    items = spark.createDataFrame([(1, "ONE"), (2, None), (None, "text without an id"), (4, BENCH)], "item_id long, text string")
    own, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    rows = lambda: [sorted(map(str, decontaminate(d, i).collect())) for d, i in ((docs, items), (none, items), (own, bench))]
    want = rows()
    for vocab in (decontam.VOCAB_ROWS, 0):
        monkeypatch.setattr(decontam, "INDEX_ROWS", 0)
        monkeypatch.setattr(decontam, "VOCAB_ROWS", vocab)
        assert rows() == want


def test_license_scan(docs, none):
    got = scan_licenses(docs)
    assert ids(got) == EVERY and scan_licenses(none).count() == 0
    by = {r.doc_id: r for r in got.where("doc_id IN (1, 2, 3, 5)").collect()}
    assert (by[1].n_base, by[1].first_word, by[1].last_word, by[1].base_labels) == (1, 0, 0, "mit")
    assert (by[2].n_words, by[2].labels, by[2].score, by[2].first_word) == (0, "", 0.0, None)
    assert by[5].n_words == 160_003 and by[3].n_words == 0


def test_license_threshold(spark):
    rows = [(1, "x\nthis software is Released under the MIT licence"), (2, "Licensed under CC-BY-NC 4.0!"),
            (3, "cc by nc cc by nc"), (4, "released MIT"), (5, "Apache\nLicense version 2")]
    by = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert by[1].labels == "mit-notice" and by[1].base_labels == "" and by[1].score == pytest.approx(0.8)
    assert by[2].labels == "cc-by-nc,cc-by-nc-notice" and by[2].first_word == 2
    assert (by[3].n_base, by[3].first_word, by[3].last_word) == (2, 0, 3)
    assert by[4].labels == "" and by[5].base_labels == "apache-2"


def test_wrapped_notices(spark):
    """Notices over several lines, whole templates at every wrap, and words too far apart to be one."""
    from blocklake.llm.licenses import TEMPLATES

    bsd = ("/*\n * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided\n")
    mpl = "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy\n"
    apart = "Redistribution and use in source and binary\n" + "other words " * 9 + "\nforms, with or without modification, are permitted"
    rows = [(1, bsd), (2, "x y z\n" * 50 + mpl), (3, apart), (4, bsd + "\n" + mpl)]
    want = {1: "bsd-notice", 2: "mpl-2-notice", 3: "", 4: "bsd-notice,mpl-2-notice"}
    for text, label in TEMPLATES.items():
        w = text.split(" ")
        for k, sep in enumerate(("\n", "\n * ", "\r\n// ")):
            for lead in (0, 5, 16, 17, 40):
                for every in (1, 3, 6):
                    i = len(rows) + 1
                    body = sep.join(" ".join(w[j : j + every]) for j in range(0, len(w), every))
                    rows.append((i, "q " * lead + "\n" + body + "\n" + "r " * k))
                    want[i] = label
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, label in want.items():
        own = {x for x in label.split(",") if x} | {x for x in got[i].base_labels.split(",") if x}
        assert got[i].labels == ",".join(sorted(own)), (rows[i - 1], got[i])
    assert got[1].score == got[2].score == 1.0 and got[3].labels == "" and got[4].labels == want[4]


@pytest.mark.parametrize("text", [
    "licensed under the GNU General Public License version 2.0", "Released under the BSD license", "licensed under CC BY 4.0",
    "the license is licensed under version 2 of the 0 law", "This work is licensed under the GNU Lesser General Public\nLicense, version 3",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software",
    "Redistribution of source and other forms with or without use and modification are permitted in this"])
def test_notices_of_other_licences(spark, text):
    got = scan_licenses(spark.createDataFrame([(1, text), (2, "x y\n" * 30 + text + "\nz")], "doc_id long, text string")).collect()
    assert [(r.labels, r.score) for r in got] == [("", 0.0)] * 2


def test_license_windows_by_brute_force(spark):
    """Notices with words lost, changed, repeated, moved and wrapped, against every window of every text."""
    rng = random.Random(8)
    templates = {**licenses.TEMPLATES, "a b": "tiny", "one word and one more word": "plain"}
    notices = [t.split(" ") for t in templates]
    rows = []
    for i in range(300):
        w = ["lead"] * rng.randrange(4)
        for notice in rng.sample(notices, 2):
            for _ in range(rng.randrange(5)):
                notice = list(notice)
                at, kind = rng.randrange(len(notice)), rng.randrange(4)
                other = rng.choice(["lesser", "mit", "x", rng.choice(notice), "affero", "organization"])
                notice[at : at + (kind != 1)] = [[], [other], [other], [notice[at], notice[at]]][kind]
                notice = notice or ["x"]
            w += notice + ["q"] * rng.randrange(3)
        rows.append((i, "".join(x + rng.choice([" ", " ", "\n", ", ", "\n * "]) for x in w)))

    def labels(text):
        w, out = re.findall(r"[a-z0-9]+", text), {}
        for template, label in templates.items():
            t = template.split(" ")
            of = set(t)
            need, must, never = -(-8 * len(of) // 10), licenses.REQUIRED.get(label, ""), licenses.EXCLUDED.get(label, "")
            for k in range(max(len(w) - len(t) + 1, 1)):
                win = set(w[k : k + len(t)])
                if len(win & of) >= need and set(must.split()) <= win and not set(never.split()) & win:
                    out[label] = max(out.get(label, 0), len(win & of) / len(of))
        return out

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: labels(t) for i, t in rows}
    assert sum(map(len, want.values())) > 200 and len({x for v in want.values() for x in v}) == len(templates)
    for tested in (100, 0):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(licenses, "MAX_TESTED", tested)
            for r in scan_licenses(docs, templates=templates).collect():
                assert set(r.labels.split(",")) - {"", *r.base_labels.split(",")} == set(want[r.doc_id])
                if r.n_base == 0:
                    assert r.score == max(want[r.doc_id].values(), default=0.0)


def test_near_duplicates(docs, none):
    got = near_duplicates(docs)
    assert ids(got) == EVERY and near_duplicates(none).count() == 0
    by = {(r.doc_id, r.n_shingles > 0): r for r in got.collect()}
    assert by[2, False].component_id == 2 and by[2, False].kept and by[7, True].component_id == 7
    assert by[9, True].component_id == 7 and not by[9, True].kept  # ONE and one
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and drop_near_duplicates(none).count() == 0
    left = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    assert left.count((4, LINE)) + sum(t == LINE for i, t in left if i != 4) == 1 and (9, "ONE") not in left
    assert left.count((None, None)) == 1 and (6, " \n\t ") in left


def test_lines(docs, none):
    got = line_report(docs)
    assert ids(got) == EVERY and line_report(none).count() == 0
    by = {(r.doc_id, r.n_lines): r for r in got.collect()}
    assert (by[2, 0].n_long, by[3, 1].n_long) == (0, 0) and by[8, 2].n_exact == 2 and by[1, 2].n_kept == 1
    new = dedup_lines(docs)
    assert new.columns == docs.columns and dedup_lines(none).count() == 0
    left = {(r.doc_id, r.text) for r in new.select("doc_id", "text").collect()}
    assert 8 not in {i for i, _ in left} and (2, None) in left and (3, "") in left and (6, " \n\t ") in left
    assert (5, LONG) in left and (4, LINE) not in left


def test_short_lines(spark):
    """Exact repeats of lines of any length, blank ones aside, counted from the raw texts without a floor."""
    from blocklake.llm.queries import QUERIES

    rows = [(1, LINE + "\nLes.\n\nLes.\n \t"), (2, "Les.\n\nles.\n}"), (3, "Les.\n}"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_long, r.n_short, r.n_kept, r.n_exact, r.n_near) for r in line_report(df, short=True).collect()}
    assert got == {1: (1, 2, 2, 1, 0), 2: (0, 3, 2, 1, 0), 3: (0, 2, 0, 2, 0), 4: (0, 0, 0, 0, 0)}
    left = {r.doc_id: r.text for r in dedup_lines(df, short=True).collect()}
    assert left == {1: LINE + "\nLes.\n\n \t", 2: "\nles.\n}", 4: None}
    sf = "/root/testdata/sf0.001"
    lines = [x for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for x in (r.text or "").split("\n") if x.strip()]
    total = QUERIES["op2_line_dedup"](spark, sf).agg(F.sum("n_exact").alias("n"), F.sum("n_short").alias("s")).first()
    assert total.n == len(lines) - len(set(lines)) and total.s == sum(len(x) < 24 for x in lines) > 0


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (3, 0), (None, 1), (4, None), (99, 0), (7, 0)],
                                   "doc_id long, quality int")
    for y in (labels, labels.limit(0)):
        got = classify_quality(docs, y)
        assert ids(got) == EVERY and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
        assert classify_quality(none, y).count() == 0
    assert keep_quality(docs, labels).columns == docs.columns


def test_pieces(docs, none):
    v = load_vocabulary()
    both = decode(encode(docs, v), v)
    assert ids(both) == EVERY and encode(none, v).count() == 0
    same = F.translate(F.coalesce("text", F.lit("")), "▁", " ") == F.col("decoded")
    assert both.where(~same).count() == 0 and set(docs.columns) <= set(both.columns)
    assert {len(r.ids) for r in both.where("doc_id IN (2, 3)").collect()} == {0}


def test_packing(docs, none):
    got = pack_documents(docs, row=64)
    assert pack_documents(none).count() == 0
    segments = got.select(F.explode(F.arrays_zip("doc_ids", "starts"))).select("col.*")
    assert segments.where("starts = 0 AND doc_ids = 4").count() == 3
    assert not {2, 3} & set(ids(segments, "doc_ids"))


def test_pseudonyms(docs, none):
    got = pseudonymize(docs, "k")
    assert ids(got) == EVERY and set(docs.columns) <= set(got.columns) and pseudonymize(none, "k").count() == 0
    assert [r.pii for r in got.where("text LIKE 'another%'").collect()] == [["card"]]
    assert got.where("doc_id = 2").first().text is None
    assert got.where(F.col("doc_id") == 5).select((F.col("text") == LONG).alias("x")).first().x


def test_warc(spark, docs, none):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a/é b\r\nX: y").alias("url"),
                        F.col("text").alias("html"), *EXTRA)
    path = scratch_path(spark, "warc-edges")
    write_warc(pages, path)
    back = read_warc(spark, path)
    assert sorted(ids(back, "id"), key=str) == sorted((None if i is None else str(i) for i in EVERY), key=str)
    assert back.where("error IS NOT NULL").count() == 0
    by = {r.id: r for r in back.where("id IN (2, 3, 5, 6)").collect()}
    assert by["5"].payload.decode() == LONG and by["5"].record_type == "response"
    assert by["2"].record_type == "response" and by["3"].refers_to == "2" and by["3"].n_bytes == 0
    twice = back.where("id = 4").collect()
    assert sorted(r.record_type for r in twice) == ["response"] * 3 and len({r.digest for r in twice}) == 2
    nulls = {r.record_type for r in back.where("id IS NULL AND n_bytes = 0").collect()}
    assert nulls == {"revisit"}
    empty = scratch_path(spark, "warc-empty")
    write_warc(none.select(F.col("doc_id").alias("page_id"), F.lit("").alias("url"), F.col("text").alias("html")), empty)
    assert read_warc(spark, empty).count() == 0


def test_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [None, 1.0]), (None, [0.9, 0.1]), (10, [0.0, 1.0]), (10, [0.0, 1.0]), (11, [1.0]),
            (12, [-0.0, 1.0]), (13, [1e-30, 0.0]), (14, [3e38, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {c: F.lit(1) for c in ["w", "cid", "cell", "label"]})
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in cosine_links(df).collect()), key=str)
    want = [(i, 5, 1, i == 1) for i in (1, 2, 3, 13, 14)] + [(None, 5, 1, False)] + [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 11)]
    want += [(10, 2, 10, True), (10, 2, 10, True), (12, 2, 10, False)]
    assert got == sorted(want, key=str)
    assert cosine_links(df.limit(0)).count() == 0


def test_text_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",)], "text string")
    assert df.select(text_key(F.col("text"))).distinct().count() == 3


def test_pipeline_stages(spark, docs, none):
    """Each stage on odd rows and on none: no crash, the columns stay, rows without content stay."""
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    shaped = lambda df: df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
                                  F.char_length("text").cast("long").alias("n_chars"), *EXTRA)
    for name, stage in cp.STAGES:
        got = stage(spark, shaped(docs), sf)
        assert set(shaped(docs).columns) <= set(got.columns), name
        if name in ("line_dedup", "near_dedup", "decontaminate", "token_ids"):
            left = {(r.doc_id, r.text) for r in got.select("doc_id", "text").collect()}
            long = LONG.removesuffix("end\n") if name == "line_dedup" else LONG  # its short last line is there twice
            assert {(2, None), (3, ""), (None, None), (5, long)} <= left, name
        assert stage(spark, shaped(none), sf).count() == 0, name
    assert cp.ORACLE_SQL is None and len(cp.STAGES) == 5


def test_near_duplicate_stage_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f g")] * 3 + [(2, "a b c d e f g"), (1, "other words that stand alone here"), (None, ""), (None, "")]
    got = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    left = sorted((str(r.doc_id), r.text) for r in got.collect())
    assert left == [("1", "a b c d e f g"), ("1", "other words that stand alone here"), ("None", ""), ("None", "")]
