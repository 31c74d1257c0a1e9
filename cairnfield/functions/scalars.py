"""Column functions: names, labels, links, categories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space of all scripts, and the four separators of ASCII.
_SPACE = r"(?U)[\s\x1c-\x1f]"


def stripped(c: Column) -> Column:
    """Text without white space at its ends, of whatever kind."""
    return F.regexp_replace(c, rf"^{_SPACE}+|{_SPACE}+$", "")


def blank_to_null(c: Column) -> Column:
    """Text without white space at its ends; null if nothing is left."""
    return F.nullif(stripped(c), F.lit(""))


#: By rule: lower-case characters whose folded form is another.
_FOLDED = {x: x.casefold() for x in map(chr, range(128, 0x10000)) if not 0xD800 <= ord(x) < 0xE000 and x == x.lower() != x.casefold()}


def casefolded(c: Column) -> Column:
    """Text folded so that it compares without case: lower case, and such letters as the sharp s written out."""
    low = F.lower(c)
    table = F.create_map(*[F.lit(v) for pair in _FOLDED.items() for v in pair])
    fold = F.array_join(F.transform(F.split(low, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    return F.when(F.octet_length(low) == F.length(low), low).otherwise(fold)


def first_name(*columns: Column, fallback: str | None = None) -> Column:
    """The first of the columns that isn't blank, then `fallback`."""
    rest = [F.lit(fallback)] if fallback is not None else []
    return F.coalesce(*[blank_to_null(c) for c in columns], *rest)


def slug(c: Column) -> Column:
    """An id: letters and digits of the folded text, run together; a leading parenthetical goes."""
    return F.regexp_replace(casefolded(F.regexp_replace(c, rf"^{_SPACE}*\([^)]*\){_SPACE}*", "")), "[^a-z0-9]+", "")


def hyphenated(c: Column) -> Column:
    """A category: words of letters and digits with hyphens between them."""
    return F.btrim(F.regexp_replace(casefolded(c), "[^a-z0-9]+", "-"), F.lit("-"))


def split_once(c: Column, mark: str) -> tuple[Column, Column]:
    """What stands before and after the first `mark`; without one: all, and null."""
    at = F.instr(c, mark)
    return F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c), F.when(at > 0, F.substring(c, at + len(mark), F.length(c)))


def templated(prefix: str, part: Column, side: Column | None = None) -> Column:
    """"prefix, part (side)"; what is null leaves its punctuation out too."""
    tail = F.lit("") if side is None else F.coalesce(F.concat(F.lit(" ("), side, F.lit(")")), F.lit(""))
    return F.when(part.isNull(), F.lit(prefix)).otherwise(F.concat(F.lit(f"{prefix}, "), part, tail))


def links_text(links: Column) -> Column:
    """Each {label, href} as "label <href>"."""
    return F.transform(links, lambda x: F.concat(x["label"], F.lit(" <"), x["href"], F.lit(">")))


def by_rules(value: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The result of the first rule (pattern, result) whose pattern is found."""
    return reduce(lambda rest, r: F.when(value.rlike(r[0]), r[1]).otherwise(rest), reversed(rules), F.lit(default))


def plural(word: Column, exceptions: dict[str, str] | None = None) -> Column:
    """English plural by ending, with exceptions."""
    out = F.when(word.rlike("(s|x|ch|sh)$"), F.concat(word, F.lit("es"))).when(word.rlike("[^aeiou]y$"), F.concat(F.substring(word, F.lit(1), F.length(word) - 1), F.lit("ies"))).otherwise(F.concat(word, F.lit("s")))
    for k, v in (exceptions or {}).items():
        out = F.when(word == k, v).otherwise(out)
    return out
