"""Column functions on markup: character references and plain text, all on the JVM."""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import _SPACE, blank_to_null

# What a reference looks like, and the tags that divide words.
REFERENCE = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"
BREAK, TAG = r"(?i)<br\s*/?>|</p>|</li>", "<[^>]+>"


def _map(pairs: dict[str, str]) -> str:
    """A map of texts as an expression, which Catalyst makes one constant."""
    text = lambda x: "'" + "".join(f"\\u{ord(u):04x}" for u in _units(x)) + "'"
    return "map(" + ", ".join(f"{text(k)}, {v if v.startswith('map(') else text(v)}" for k, v in pairs.items()) + ")"


def _units(x: str) -> str:
    """Its UTF-16 code units, as characters."""
    raw = x.encode("utf-16-le", "surrogatepass")
    return "".join(chr(raw[i] | raw[i + 1] << 8) for i in range(0, len(raw), 2))


@cache
def _names() -> str:
    """The table of named references by first letter, so that a look-up goes through one letter's names only."""
    table: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        table.setdefault(name[0], {})[name] = text
    return _map({k: _map(v) for k, v in table.items()})


@cache
def _bare_names() -> tuple[str, str]:
    """Pattern of the names that count without a semicolon, the longest first, and their table."""
    bare = {n: t for n, t in html5.items() if not n.endswith(";")}
    return "^(" + "|".join(sorted(bare, key=lambda n: (-len(n), n))) + ")", _map(bare)


@cache
def _odd_numbers() -> str:
    """What numbers stand for that aren't code points of their own: 128 to 159 are read as Windows-1252, 0 is replaced."""
    odd = {0: "�", 13: "\r"}
    for n in range(128, 160):
        odd[n] = bytes([n]).decode("cp1252", "replace").replace("�", chr(n))
    return _map({str(k): v for k, v in odd.items()})


def _named(name: Column) -> Column:
    """Text of a named reference (without its ampersand); null if it is none."""
    whole = F.try_element_at(F.try_element_at(F.expr(_names()), F.substring(name, 1, 1)), name)
    pattern, table = _bare_names()
    bare = F.regexp_extract(name, pattern, 1)
    return F.coalesce(whole, F.concat(F.try_element_at(F.expr(table), bare), F.substring(name, F.length(bare) + 1, F.length(name))))


def _numbered(n: Column) -> Column:
    """The character with this number."""
    low = F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")
    high = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    no_character = n.between(1, 8) | n.between(14, 31) | n.between(127, 159) | n.between(0xFDD0, 0xFDEF) | (n == 11) | (n % 0x10000 >= 0xFFFE)
    odd = F.try_element_at(F.expr(_odd_numbers()), n.cast("string"))
    return F.coalesce(odd, F.when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "�").when(no_character, "").when(n < 0x10000, low).otherwise(high))


def _replaced(reference: Column) -> Column:
    digits = F.regexp_extract(reference, "^&#[xX]?0*([0-9a-fA-F]*);?$", 1)
    # more digits than the last code point has
    number = F.when(F.length(digits) > 7, F.lit(0x110000)).otherwise(F.conv(F.when(digits == "", "0").otherwise(digits), 16, 10).cast("long"))
    decimal = F.when(F.length(digits) > 7, F.lit(0x110000)).otherwise(F.coalesce(digits.try_cast("long"), F.lit(0)))
    return F.when(reference.rlike("^&#[xX]"), _numbered(number)).when(reference.startswith("&#"), _numbered(decimal)).otherwise(F.coalesce(_named(F.substring(reference, F.lit(2), F.length(reference))), reference))


def unescaped(c: Column) -> Column:
    """Text with its character references replaced, by name (the whole table of HTML) or by number. Text without an ampersand is only looked at."""
    between, found = F.split(c, REFERENCE, -1), F.regexp_extract_all(c, F.lit(f"({REFERENCE})"), F.lit(1))
    joined = F.array_join(F.zip_with(between, found, lambda a, b: F.concat(a, F.when(b.isNull(), "").otherwise(_replaced(b)))), "")
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def _squeezed(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, rf"{_SPACE}+", " "))


def plain_text(markup: Column) -> Column:
    """Text of a piece of markup: breaks and ends of paragraphs and items become spaces, other tags vanish, references are replaced, spaces squeezed. Null if nothing is left."""
    return blank_to_null(_squeezed(unescaped(F.regexp_replace(F.regexp_replace(markup, BREAK, " "), TAG, ""))))


def spaced_text(markup: Column) -> Column:
    """As plain_text, but every tag becomes a space, and nothing left is an empty text."""
    return _squeezed(unescaped(F.regexp_replace(markup, TAG, " ")))
