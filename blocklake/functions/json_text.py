"""Strict JSON and its compact text in column expressions alone (KV-1/KV-5): no Python worker on any path.

Most blobs are flat objects of strings, short integers and literals: there the native parse accepts the same
inputs as a strict reader and prints the same text, and `is_plain` recognizes them by one regular expression.
The native parse is laxer elsewhere and prints numbers its own way, so the others are prepared for it first:
`marked` writes every number that it would print otherwise as a string, a mark and the number as it is to be
printed (`1.0`, `-0.0`, `1e16`, the shortest digits that read back; integers beyond 64 bits as such numbers).
The parse then sorts keys and collapses duplicates, last-wins, and `unmarked` turns the marked strings of its
output back into numbers. `readied` holds what the parse does not check: nothing after the value, at most
127 nested containers, no lone surrogates; a number out of range or not spelled as JSON spells it is written as
a token no parser takes. The mark is U+0001, which JSON text can only hold as an escape; escapes of it in the
text are doubled and halved again.

Keys of a nested object come in the order of their UTF-16 units, which is byte order unless one object has both
keys with characters beyond U+FFFF and keys with characters from U+E000 on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the deepest nesting of a strict reader.
MAX_CONTAINERS = 127
STRING = r'"(?:[^"\\]++|\\.)*+"'
# A flat object of strings without \u escapes, integers of at most 15 digits, literals and what stands between them.
PLAIN = (r'\A[ \t\r\n]*+\{(?:"(?:[^"\\]++|\\[^u])*+"|[ \t\r\n:,]++|(?:0|-?[1-9][0-9]{0,14})(?![0-9.eE])|true|false|null)*+\}'
         r'[ \t\r\n]*+\z')
# What numbers native printing spells another way look like, once strings are emptied.
ODD = r"[0-9][.eE]|-0|[0-9]{16}"
# Pieces of a text: a run that begins like a number, or a stretch without one, its strings in whole.
PIECE = r'-?[0-9][0-9.eE+-]*|(?:"(?:[^"\\]++|\\.)*+"|[^"0-9-]++|-(?![0-9])|")++'
# At most 15 digits without an exponent, not below 0.00001: its digits are the shortest already.
SHORT_DECIMAL = r"\A(?=.{1,16}\z)-?(?!0\.00000)(?:0|[1-9][0-9]*)\.[0-9]+\z"
NATIVE_INTEGER = r"\A(?:0|-?[1-9][0-9]{0,17})\z"
NUMBER = r"\A-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?\z"
# An escape that stands after no backslash or an even number of them.
ESCAPE = r"(?<!\\)((?:\\\\)*)\\u"
HIGH, LOW = r"\\u[dD][89abAB][0-9a-fA-F]{2}", r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"
NO_TOKEN = "!"
I64, U64 = "9223372036854775808", "18446744073709551615"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and hand it to `body`. The body runs as a lambda, outside the generated code: a long
    expression that few rows take would push the stage's method over the size that the JVM compiles."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_plain(text: Column) -> Column:
    """Whether the native parser reads this text exactly as a strict one, if it reads it at all."""
    return F.coalesce(F.is_valid_utf8(text) & text.rlike(PLAIN), F.lit(False))


def readied(text: Column) -> Column:
    """A text that is not plain as the native parser may read it, or null where it is no strict JSON value."""
    emptied = F.regexp_replace(text, F.lit(STRING), F.lit('""'))
    ready = lambda bare: F.when(is_shallow(bare) & is_paired(text), let(
        F.when(bare.rlike(ODD) | F.contains(text, F.lit("\\u")), marked(text)).otherwise(text),
        lambda t: F.when(is_one_value(t), t)))
    return F.when(F.is_valid_utf8(text), let(emptied, ready))


def is_shallow(bare: Column) -> Column:
    """Whether a text, its strings emptied, nests no deeper than a strict reader goes."""
    def step(s: Column, c: Column) -> Column:
        depth = s["depth"] + F.when(c.isin("{", "["), 1).otherwise(-1)
        return F.struct(depth.alias("depth"), F.greatest(s["most"], depth).alias("most"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("most"))
    brackets = F.regexp_extract_all(bare, F.lit(r"([{}\[\]])"), 1)
    few = F.length(F.regexp_replace(bare, F.lit(r"[^{\[]++"), F.lit(""))) <= MAX_CONTAINERS
    return few | (F.aggregate(brackets, start, step)["most"] <= MAX_CONTAINERS)


def is_paired(text: Column) -> Column:
    """Whether no escape of a text is a lone surrogate."""
    escapes = F.regexp_replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit(HIGH + LOW), F.lit(""))
    return ~F.contains(text, F.lit("\\u")) | ~escapes.rlike(r"\\u[dD][89a-fA-F]")


def is_one_value(text: Column) -> Column:
    """Whether text that parses is a single JSON value in whole.

    The parser stops after the first value. Inside brackets, a value that ends early can only be followed by a comma
    (then there are two) or by a closing bracket of the text's own, which does not close the braces.
    """
    one = F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False))
    return one & F.json_object_keys(F.concat(F.lit('{"k":'), text, F.lit("}"))).isNotNull()


def _scientific(token: Column) -> Column:
    """The shortest scientific text that reads back as the token's double (absolute value), or null out of range."""
    x = F.abs(token.cast("double"))
    tries = [F.format_string(f"%.{p}e", x) for p in range(17)]
    text = F.coalesce(*[F.when(t.cast("double") == x, t) for t in tries], tries[-1])
    return F.when(x < F.lit(float("inf")), F.when(x == 0, F.lit("0e0")).otherwise(text))


def _double_text(token: Column, sci: Column) -> Column:
    """A double as its shortest digits, with an exponent beyond 16 places or 5 zeros."""
    digits = F.replace(F.substring_index(sci, "e", 1), F.lit("."), F.lit(""))
    point = F.substring_index(sci, "e", -1).cast("int") + 1
    n = F.length(digits)
    some = lambda start, size: F.substr(digits, start, size)
    body = (F.when((point >= n) & (point <= 16), F.concat(digits, F.repeat(F.lit("0"), point - n), F.lit(".0")))
            .when((point > 0) & (point <= 16), F.concat(some(F.lit(1), point), F.lit("."), some(point + 1, n)))
            .when((point > -5) & (point <= 0), F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
            .otherwise(F.concat(some(F.lit(1), F.lit(1)), F.when(n > 1, F.concat(F.lit("."), some(F.lit(2), n))).otherwise(""),
                                F.lit("e"), (point - 1).cast("string"))))
    return F.concat(F.when(token.startswith("-"), F.lit("-")).otherwise(""), body)


def marked(text: Column) -> Column:
    """`text` with its numbers as marked strings, for a parse that `unmarked` completes."""
    clean = F.when(F.contains(text, F.lit("\\u0001")), F.regexp_replace(
        text, F.lit(ESCAPE + "0001"), F.lit(r"$1\\u0001\\u0001"))).otherwise(text)
    pieces = F.regexp_extract_all(clean, F.lit(f"({PIECE})"), 1)
    mark = lambda c: F.concat(F.lit('"\\u0001n'), c, F.lit('"'))

    def integer(t: Column) -> Column:
        whole = F.lpad(F.replace(t, F.lit("-"), F.lit("")), 20, "0")
        most = F.when(t.startswith("-"), F.lpad(F.lit(I64), 20, "0")).otherwise(F.lit(U64))
        return ~t.rlike(r"[.eE]") & (t != "-0") & (F.length(t) <= 20) & (whole <= most)

    def spell(t: Column) -> Column:
        double = let(_scientific(t), lambda sci: F.coalesce(mark(_double_text(t, sci)), F.lit(NO_TOKEN)))
        odd = F.when(t.rlike(SHORT_DECIMAL), mark(F.regexp_replace(t, F.lit(r"(\.[0-9]+?)0+\z"), F.lit("$1")))).when(
            ~t.rlike(NUMBER), F.lit(NO_TOKEN)).when(integer(t), mark(t)).otherwise(double)
        return F.when(~t.rlike(r"\A-?[0-9]") | t.rlike(NATIVE_INTEGER), t).otherwise(odd)

    return F.array_join(F.transform(pieces, spell), "")


def unmarked(json: Column) -> Column:
    """JSON text printed from a parse of `marked` text, its numbers restored and its escapes in lower case."""
    out = F.regexp_replace(json, F.lit(r'"\\u0001n([^"]*)"'), F.lit("$1"))
    halved = F.regexp_replace(out, F.lit(ESCAPE + r"0001\\u0001"), F.lit(r"$1\\u0001"))
    lower = halved
    for c in "ABCDEF":
        lower = F.regexp_replace(lower, F.lit(ESCAPE + f"00([01]){c}"), F.lit(rf"$1\\u00$2{c.lower()}"))
    return F.when(F.contains(out, F.lit("\\u00")), lower).otherwise(out)


def unmarked_key(key: Column) -> Column:
    """A key of a parse of `marked` text as it stood in the text."""
    return F.replace(key, F.lit("\u0001\u0001"), F.lit("\u0001"))
