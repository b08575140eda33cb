"""Line dedup: segment-partition edit join of all distinct lines, in DataFrame operations alone.

Two lines within `threshold` edits: the shorter, cut into threshold + 1 segments, has a segment that the longer
holds unchanged near the same place. Every line indexes its segments and probes with the substrings that a
partner of its length, or up to `threshold` shorter, could hold there (multi-match-aware positions). Keys are
hashes of (length, segment, substring). Keys that two different lines meet under are found by numbers alone, and one
is kept of those that the same lines meet under; only there are the lines' texts brought together and
compared inside the join, so no pair leaves it that is not a link. Where too many lines share a
segment (lines of one template), they meet instead under eight segments without two, in blocks of bounded size. Verification trims the
common ends and runs a banded bit-parallel edit distance over what is left. Lines too short for the segments can be
decided by equality alone (`short`): they pass through the same aggregate and never enter the join.
"""

from __future__ import annotations

from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklake.functions.fence import fence
from blocklake.llm.common import BROADCAST_ROWS, discard, free_shuffles, let, materialize, sized, text_key
from blocklake.llm.components import connected_components

THRESHOLD = 2
MIN_CHARS = 24
MET_ROWS = BROADCAST_ROWS  # rows of keys or of lines' hashes that are broadcast; more are joined by shuffle, without text
MASK_PARTS = 8  # segments of a line whose single segments are too common to be keys
HOT_PAIRS = 1 << 16  # pairs that may be compared under one key; above, lines meet under masks
BLOCK_LINES = 256  # lines of a mask's group that one key of the join holds


def with_keys(lines: DataFrame, threshold: int) -> DataFrame:
    """The columns of `lines` (with `line`) and, per row, its entries (key, own): the line's own segments, and the
    substrings it probes partners with.

    A partner has n - delta characters. Its segment i starts off its place by at most the i edits before it, and
    by at most the threshold - i edits after it once the lengths are levelled; other places cannot be the first
    match. An own segment is also the probe for equal lines' same place, so it is not listed twice. Characters
    are cut from a fixed-width encoding, where a place is an offset.
    """
    parts = threshold + 1
    probes = [(delta, i, shift) for delta in range(parts) for i in range(parts)
              for shift in range(max(-i, delta - threshold + i), min(i, delta + threshold - i) + 1)]
    far = 2 * threshold + 1  # a probe is one number: delta, then i, then shift + threshold
    codes = F.array(*[F.lit((d * parts + i) * far + s + threshold) for d, i, s in probes])
    p = F.col("_p")
    rows = lines.select("*", F.char_length("line").alias("_n"), F.encode("line", "UTF-32").alias("_wide"))
    rows = rows.select("*", F.explode(codes).alias("_p"))
    rows = rows.withColumns({"_m": F.col("_n") - F.expr(f"_p div {far * parts}").cast("int"),
                             "_i": F.expr(f"(_p div {far}) % {parts}").cast("int"),
                             "_shift": p % far - threshold})
    size, longer = F.expr(f"_m div {parts}").cast("int"), F.col("_m") % parts
    wide = size + (longer >= parts - F.col("_i")).cast("int")  # the last segments are one longer
    at = size * F.col("_i") + F.greatest(longer - parts + F.col("_i"), F.lit(0)) + F.col("_shift")
    rows = rows.where((at >= 0) & (at + wide <= F.col("_n")))
    key = F.xxhash64("_m", "_i", F.substring("_wide", at * 4 + 1, wide * 4))
    own = ((F.col("_m") == F.col("_n")) & (F.col("_shift") == 0)).cast("int")
    return rows.select(*lines.columns, key.alias("key"), own.alias("own"))


def with_masks(lines: DataFrame, threshold: int, parts: int = MASK_PARTS) -> DataFrame:
    """As `with_keys`, with longer keys: a line without `threshold` of its segments.

    The edits between two lines fall into at most `threshold` segments of the shorter, so outside some choice of
    that many segments the lines are equal, moved by the net insertions before each place. A line of a common
    template thus meets only lines that agree with it in nearly all of what is its own as well.
    """
    parts = max(parts, threshold + 1)
    moves = [(delta, d) for delta in range(threshold + 1) for d in product(range(-threshold, threshold + 1), repeat=threshold)
             if sum(d) == delta and sum(map(abs, d)) <= threshold]
    masks = list(combinations(range(parts), threshold))
    code = F.array(*[F.lit(i) for i in range(len(masks) * len(moves))])
    of = lambda values: F.array(*[F.array(*map(F.lit, v)) for v in values])
    rows = lines.select("*", F.char_length("line").alias("_n"), F.encode("line", "UTF-32").alias("_wide"))
    rows = rows.select("*", F.explode(code).alias("_p"))
    rows = rows.withColumns({"_mask": F.expr(f"_p div {len(moves)}").cast("int"), "_move": (F.col("_p") % len(moves)).cast("int")})
    rows = rows.withColumns({"_out": F.get(of(masks), F.col("_mask")),
                             "_d": F.get(of([d for _, d in moves]), F.col("_move")),
                             "_m": F.col("_n") - F.get(F.array(*[F.lit(delta) for delta, _ in moves]), F.col("_move"))})
    size, longer = F.expr(f"_m div {parts}").cast("int"), F.col("_m") % parts
    start = lambda i: size * i + F.greatest(longer - parts + i, F.lit(0))
    runs, low, shift = [], F.lit(0), F.lit(0)
    for r in range(threshold + 1):
        high = start(F.get("_out", F.lit(r))) if r < threshold else F.col("_m")
        runs.append(F.substring("_wide", (low + shift) * 4 + 1, (high - low) * 4))
        if r < threshold:
            low, shift = start(F.get("_out", F.lit(r)) + 1), shift + F.get("_d", F.lit(r))
    key = F.xxhash64("_m", "_mask", *runs)
    own = F.forall("_d", lambda x: x == 0).cast("int")  # moves that cancel out are probes
    return rows.where("_m >= 0").select(*lines.columns, key.alias("key"), own.alias("own"))


def _common_prefix(a: Column, b: Column, most: Column) -> Column:
    """Length of the common prefix, by halving; `most` is the shorter length (below 2^26)."""
    step = lambda at, k: F.when((at + k <= most) & (
        F.substring(a, at + 1, k) == F.substring(b, at + 1, k)), at + k).otherwise(at)
    powers = F.transform(F.sequence(F.ceil(F.log2(most + 1)).cast("int"), F.lit(0), F.lit(-1)),
                         lambda p: F.pow(F.lit(2), p).cast("int"))
    return F.aggregate(powers, F.lit(0), step)


def _banded(a: Column, b: Column, threshold: int) -> Column:
    """Edit distance of character arrays with size(a) <= size(b) <= size(a) + threshold; exact up to `threshold`.

    One word holds the vertical differences of the 2 * threshold + 1 cells around the diagonal. Bit t of step j
    stands for character j - threshold + t of `a`; the band moves down a row with every character of `b`. The
    score is read along the band's lower edge until it leaves the matrix, then along its last row.
    """
    k = threshold
    width = 2 * k + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    n, m = F.size(a), F.size(b)
    big = lambda v: F.lit(v).cast("bigint")

    def step(s: Column, j: Column) -> Column:
        c = F.get(b, j)
        eq = big(0)
        for t in range(width):
            at = j + (t - k)
            eq = eq + F.when((at >= 0) & (at < n) & (F.get(a, F.greatest(at, F.lit(0))) == c), big(1 << t)).otherwise(big(0))

        def diagonal(x: Column) -> Column:
            d0 = ((((x.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])).bitwiseOR(x)).bitwiseOR(s["vn"])).bitwiseAND(big(full))
            return let(d0, lambda d: let(F.struct(
                s["vn"].bitwiseOR(F.bitwise_not(d.bitwiseOR(s["vp"]))).bitwiseAND(big(full)).alias("hp"),
                d.bitwiseAND(s["vp"]).alias("hn"), F.shiftrightunsigned(d, 1).alias("d1"), d.alias("d0")), after))

        def after(h: Column) -> Column:
            # The lower edge meets row j + k + 1; from row n on, the last row's cell is bit n - 1 - j + k.
            inside = j + k < n
            last = F.call_function("shiftleft", big(1), F.greatest(F.least(n - 1 - j + k, F.lit(2 * k)), F.lit(0)))
            edge = F.when(h["d0"].bitwiseAND(big(top)) != 0, 0).otherwise(1)
            row = F.when(h["hp"].bitwiseAND(last) != 0, 1).otherwise(0) - F.when(h["hn"].bitwiseAND(last) != 0, 1).otherwise(0)
            return F.struct(
                h["hn"].bitwiseOR(F.bitwise_not(h["d1"].bitwiseOR(h["hp"]))).bitwiseAND(big(full)).alias("vp"),
                h["d1"].bitwiseAND(h["hp"]).alias("vn"),
                (s["dist"] + F.when(inside, edge).otherwise(row)).alias("dist"))

        return let(eq, diagonal)

    start = F.struct(big(((1 << (k + 1)) - 1) << k).alias("vp"), big(0).alias("vn"),
                     F.least(F.lit(k), n).alias("dist"))
    return F.when(m == 0, n).otherwise(F.aggregate(
        F.sequence(F.lit(0), F.greatest(m - 1, F.lit(0))), start, step)["dist"])


def within(a: Column, b: Column, threshold: int) -> Column:
    """Whether two lines are within `threshold` edits of one another."""
    def trimmed(s: Column) -> Column:
        return let(_common_prefix(s["a"], s["b"], F.char_length(s["a"])), lambda p: cut(s, p))

    def cut(s: Column, p: Column) -> Column:
        return let(F.struct(F.substr(s["a"], p + 1).alias("a"), F.substr(s["b"], p + 1).alias("b")), ends)

    def ends(r: Column) -> Column:
        back = F.struct(F.reverse(r["a"]).alias("a"), F.reverse(r["b"]).alias("b"))
        return let(let(back, lambda s: _common_prefix(s["a"], s["b"], F.char_length(r["a"]))), lambda q: core(r, q))

    def core(r: Column, q: Column) -> Column:
        left = lambda c: F.left(c, F.char_length(c) - q)
        return let(F.struct(left(r["a"]).alias("a"), left(r["b"]).alias("b")), decide)

    def decide(s: Column) -> Column:
        # Spark's own banded distance goes first; the bit-parallel one decides what it leaves.
        chars = lambda c: F.array_remove(F.split(c, ""), "")
        return F.when(F.char_length(s["b"]) <= threshold, True).when(
            F.levenshtein(s["a"], s["b"], threshold) < 0, False).otherwise(
            let(F.struct(chars(s["a"]).alias("a"), chars(s["b"]).alias("b")),
                lambda s: _banded(s["a"], s["b"], threshold) <= threshold))

    short = F.char_length(a) <= F.char_length(b)
    both = F.struct(F.when(short, a).otherwise(b).alias("a"), F.when(short, b).otherwise(a).alias("b"))
    return (F.abs(F.char_length(a) - F.char_length(b)) <= threshold) & let(both, trimmed)


def _short(line: Column, min_chars: int) -> Column:
    """Whether a line is under `min_chars` characters and not blank."""
    return (F.char_length(line) < min_chars) & F.rlike(line, F.lit(r"\S"))


def eligible_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int, short: bool = False) -> DataFrame:
    """(doc_id, tk, line_no, line, n): lines of at least `min_chars` characters, numbered from 0 in their text.

    With `short`, the shorter lines that are not blank as well.
    """
    lines = docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("tk"),
                        F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    wanted = F.col("n") >= min_chars
    return lines.withColumn("n", F.char_length("line")).where(wanted | _short(F.col("line"), min_chars) if short else wanted)


def _met(lines: DataFrame, threshold: int) -> DataFrame:
    """(key, h, own): each entry once, without text, of the lines that meet another one under a key that one of them owns.

    `lines` has `h` and `line`. The text stays where it is read: only numbers are shuffled.
    """
    keyed = with_keys(lines.select("h", "line"), threshold).select("key", "h", "own")
    met = keyed.groupBy("key").agg(F.min("h").alias("least"), F.max("h").alias("most"), F.max("own").alias("own"))
    met = materialize(met.where("least != most AND own = 1").select("key"), "met")
    free_shuffles(met)
    entries = materialize(keyed.join(sized(met, MET_ROWS), "key", "left_semi").distinct(), "met-entries")
    discard(met)
    return entries


def _keys(entries: DataFrame) -> DataFrame:
    """(key, pairs, even): of the keys that the same entries meet under, one; `pairs` may be compared there.

    Lines that differ in one segment share the others, so a group of them would meet, with its text, under each.
    `even`: so many entries are owned that the join may take them all on both sides.
    """
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "h", "own")).alias(f"m{seed}")
    per = entries.groupBy("key").agg(F.sum("own").alias("n_own"), F.count(F.lit(1)).alias("n_all"), mark(0), mark(1))
    keys = per.groupBy("n_own", "n_all", "m0", "m1").agg(F.min("key").alias("key"))
    return materialize(keys.select("key", (F.col("n_own") * F.col("n_all")).alias("pairs"),
                                   (F.col("n_all") <= 4 * F.col("n_own")).alias("even")), "met-keys")


def _only(df: DataFrame, lines: DataFrame) -> DataFrame:
    """The rows of `df` that may join `lines` by `h`: all where there are too many of these to be broadcast."""
    return df.join(F.broadcast(lines.select("h")), "h", "left_semi") if lines.count() <= MET_ROWS else df


def line_links(lines: DataFrame, first: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(a, b): ids of every two different lines within `threshold` edits; (id, first): of the lines that may have links.

    `lines` has `h` and `line`; `first` has one row per line: id, h, md5, first.
    """
    entries = _met(lines, threshold)
    keys = _keys(entries)
    of = entries.join(sized(keys.select("key", "even"), MET_ROWS), "key").groupBy("h").agg(
        F.collect_list(F.struct("key", "own", "even")).alias("entries"))
    of = materialize(of, "met-lines")
    discard(entries)
    near = _only(first, of).join(of, "h")
    near = materialize(near.select("h", "md5", "id", "first", "entries"), "near-lines")
    discard(of)
    # The text is moved once by its digest, one copy a task, and once by the keys.
    text = _only(lines.select("h", "line"), near).groupBy(F.unhex(F.md5("line")).alias("md5")).agg(F.first("line").alias("line"))
    text = text.join(near.select("md5", "id", "entries"), "md5")
    rows = materialize(text.select("id", "line", F.inline("entries")), "near-keys", compression="zstd")
    hot = materialize(keys.where(F.col("pairs") > HOT_PAIRS).select("key", "pairs"), "hot-keys")
    free_shuffles(rows)
    links = materialize(_linked(rows, hot, threshold), "line-links")
    discard(rows)
    return links, near.select("id", "first")


def _linked(near: DataFrame, hot: DataFrame, threshold: int) -> DataFrame:
    """(a, b) of the entries `near`; lines that meet under hot keys meet under masks where that leaves fewer pairs."""
    if hot.isEmpty():
        return _all_links(near, threshold).distinct()
    # Two lines that meet under hot keys alone are both in `common`, and masks by themselves find all its links.
    cold = near.join(sized(hot.select("key")), "key", "left_anti")
    common = materialize(near.join(sized(hot.select("key")), "key", "left_semi").select("id", "line").distinct(), "common-lines")
    masked = with_masks(common, threshold)
    met = masked.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.sum("own").alias("n_own"), F.count(F.lit(1)).alias("n_all"))
    met = materialize(met.where("least != most AND n_own > 0").select("key", F.expr(
        f"cast((n_own - 1) div {BLOCK_LINES} as int)").alias("last"),
        (F.col("n_own") * F.col("n_all")).alias("pairs")), "met-masks")
    # Lines that differ in one place alone meet under many masks; there the segments have fewer pairs to compare.
    if (met.agg(F.sum("pairs")).first()[0] or 0) >= hot.agg(F.sum("pairs")).first()[0]:
        return _all_links(near, threshold).distinct()
    masked = masked.join(sized(met), "key")
    # A group of many lines is compared in blocks: an own entry is in one of them, a probe goes to each.
    block = F.pmod(F.xxhash64("id"), F.col("last") + 1).cast("int")
    own = masked.where("own = 1").select("id", "line", "key", "own", block.alias("block"))
    probes = masked.select("id", "line", "key", "own", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("block"))
    return _all_links(cold, threshold).unionByName(_links(own, probes, threshold)).distinct()


def _all_links(near: DataFrame, threshold: int) -> DataFrame:
    """`_links` of entries that are in no blocks; those of `even` keys are both sides of the join, shuffled once."""
    near = near.withColumn("block", F.lit(0))
    even, rest = near.where("even"), near.where("NOT even")
    return _links(even, even, threshold).unionByName(_links(rest.where("own = 1"), rest, threshold))


def _links(own: DataFrame, near: DataFrame, threshold: int) -> DataFrame:
    """(a, b) of the lines that meet under one (key, block), which one of them owns, and are within `threshold` edits."""
    a, b = own.alias("a"), near.alias("b")
    # No condition is on one side alone, so sides that are the same rows stay so, and one shuffle serves both.
    # The lines are compared in the join's condition: pairs that are not links never become rows.
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.block") == F.col("b.block"))
                   & (F.col("a.id") != F.col("b.id"))
                   & ((F.col("a.own") > F.col("b.own")) | ((F.col("a.own") + F.col("b.own") == 2) & (F.col("a.id") < F.col("b.id"))))
                   & _ends_meet(F.col("a.line"), F.col("b.line"), threshold)
                   & within(F.col("a.line"), F.col("b.line"), threshold))
    return pairs.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b"))


def _ends_meet(a: Column, b: Column, threshold: int, chars: int = 16) -> Column:
    """Whether the first and the last `chars` of two lines are within twice `threshold` edits, as those of links are:
    one bound for the edits in them, one for where the other line's end is cut. Compiled, and of bounded cost."""
    meet = lambda x, y: F.levenshtein(x, y, 2 * threshold) >= 0
    return meet(F.left(a, F.lit(chars)), F.left(b, F.lit(chars))) & meet(F.right(a, F.lit(chars)), F.right(b, F.lit(chars)))


def line_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD,
                 min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """One row per distinct line of at least `min_chars`: doc_id, tk, line_no of its first place, keep, n_links.

    With `short`, also one per distinct shorter line that is not blank; these are told apart by equality alone.

    First is by (doc_id, text key, line number). A line is kept if no line of its component, linked directly or
    through others, comes earlier. `n_links` counts the other distinct lines within `threshold` edits.
    """
    if min_chars <= threshold:
        raise ValueError("min_chars must exceed threshold: each segment needs a character")
    lines = eligible_lines(docs, doc_id, text, min_chars, short).withColumn("h", F.xxhash64("line"))
    first = lines.groupBy(F.unhex(F.md5("line")).alias("md5"), "h").agg(F.min(F.struct("doc_id", "tk", "line_no")).alias("first"))
    first = materialize(first.withColumn("id", F.monotonically_increasing_id()), "lines")
    free_shuffles(first)
    links, near = line_links(lines.where(F.col("n") >= min_chars), first, threshold)
    comps = connected_components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    linked = near.join(comps, F.col("id") == F.col("node")).join(degree, "id")
    best = linked.groupBy("component").agg(F.min("first").alias("best"))
    marks = linked.join(best, "component").select("id", (F.col("first") == F.col("best")).alias("keep"), "n_links")
    out = first.join(sized(materialize(marks, "line-marks")), "id", "left")
    return out.select("first.*", F.coalesce("keep", F.lit(True)).alias("keep"),
                      F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def _same(row: str, key: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(row)) & (F.col("tk") == F.col(key))


def line_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD,
                min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """Per document row: doc_id, n_lines, n_long, n_kept, n_exact, n_near, n_links.

    n_long lines have at least `min_chars` characters; of these n_kept stay, n_exact repeat an earlier line and
    n_near are new but within reach of an earlier one; n_links sums the links of the document's new lines.
    With `short`, n_short follows n_long: shorter lines that are not blank, which count in n_kept or n_exact too.
    Null texts have no lines, empty texts one empty line. Rows equal in id and text are one document and get one
    result each; rows that share only the id are apart. Only the named columns are read.
    """
    per = materialize(line_classes(docs, doc_id, text, threshold, min_chars, short).groupBy("doc_id", "tk").agg(
        F.count_if("keep").alias("n_kept"), F.count_if(~F.col("keep")).alias("n_near"),
        F.sum("n_links").alias("n_links")).withColumnsRenamed({"doc_id": "d", "tk": "k"}), "line-counts")
    lines = F.split(F.col(text), "\n")
    n_of = lambda which: F.coalesce(F.size(F.filter(lines, which)), F.lit(0)).cast("long")
    counts = [n_of(lambda x: F.char_length(x) >= min_chars).alias("n_long"),
              *[n_of(lambda x: _short(x, min_chars)).alias("n_short")] * short]
    base = docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("tk"),
                       F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), *counts)
    decided = F.col("n_long") + F.col("n_short") if short else F.col("n_long")
    got = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return base.join(per, _same("d", "k"), "left").select(
        "doc_id", "n_lines", "n_long", *["n_short"] * short, got("n_kept").alias("n_kept"),
        (decided - got("n_kept") - got("n_near")).alias("n_exact"), got("n_near").alias("n_near"),
        got("n_links").alias("n_links"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD,
                min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """The documents with repeated and near-repeated lines cut from their texts, all columns as they were.

    Lines shorter than `min_chars` always stay, with `short` only the blank ones and the first of each. A document that loses every line it had is dropped; null and
    empty texts, which lose nothing, stay.
    """
    kept = line_classes(docs, doc_id, text, threshold, min_chars, short).where("keep").groupBy("doc_id", "tk").agg(
        F.collect_list("line_no").alias("_kept")).withColumnsRenamed({"doc_id": "_d", "tk": "_k"})
    kept = materialize(kept, "kept-lines")
    body = F.col(f"_r.`{text}`")
    rows = docs.select(F.struct("*").alias("_r")).withColumns(
        {"doc_id": F.col(f"_r.`{doc_id}`"), "tk": text_key(body)}).join(kept, _same("_d", "_k"), "left")
    # Each step is fenced: split once, not once per line or per use.
    rows = fence(rows, _lines=F.split(body, "\n"))
    free = lambda x: (F.char_length(x) < min_chars) & ~_short(x, min_chars) if short else F.char_length(x) < min_chars
    undecided = F.array_compact(F.transform("_lines", lambda x, i: F.when(free(x), i)))
    rows = fence(rows, _stay=F.array_sort(F.array_union(undecided, F.coalesce("_kept", F.array().cast("array<int>")))))
    rows = fence(rows, _new=F.when(body.isNull(), body).otherwise(
        F.array_join(F.transform("_stay", lambda i: F.get(F.col("_lines"), i)), "\n")))
    lost = (F.trim("_new") == "") & (F.trim(body) != "") & (F.size("_stay") < F.size("_lines"))
    rows = rows.where(~F.coalesce(lost, F.lit(False)))
    return rows.select(*[F.col("_new").alias(c) if c == text else F.col(f"_r.`{c}`") for c in docs.columns])
