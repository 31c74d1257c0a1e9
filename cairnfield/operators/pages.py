"""Pages: links, extracts, watches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.markup import plain_text, spaced_text, unescaped
from ..functions.scalars import casefolded, stripped

# The elements that are looked for, their address and contents.
ANCHOR = r'(?is)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>'
FILE = r'(?is)<a[^>]+href="([^"]+%s)"[^>]*>(.*?)</a>'
HEADING = r"(?is)<h1[^>]*>(.*?)</h1>"


def _found(pages: DataFrame, pattern: str) -> DataFrame:
    """(page_id, pos, href, label) of every match, as they stand in the markup."""
    both = pages.select("page_id", *[F.regexp_extract_all("html", F.lit(pattern), F.lit(i)).alias(n) for i, n in ((1, "h"), (2, "t"))])
    return both.select("page_id", F.posexplode(F.arrays_zip("h", "t")).alias("pos", "l")).select("page_id", "pos", F.col("l.h").alias("href"), F.col("l.t").alias("label"))


def links(pages: DataFrame, department: str, skip: str | None = None) -> DataFrame:
    """(page_id, kind, nth, href, label) of the links of each page (page_id, html): kind is "department" where the address begins as the pattern `department` says, else "other"; nth counts from 1 in each kind.

    Attributes, case and nested markup don't matter; addresses have their
    references replaced, labels are plain text. An address counts once, with
    its first label that isn't blank. `skip` is a pattern of whole addresses,
    with one slash at their end, that are left out. Null pages have no links.
    """
    rows = _found(pages, ANCHOR).select("page_id", "pos", unescaped(F.col("href")).alias("href"), plain_text(F.col("label")).alias("label")).where("label is not null")
    if skip is not None:
        rows = rows.where(~F.concat(F.rtrim(F.col("href"), F.lit("/")), F.lit("/")).rlike(f"^(?:{skip})$"))
    first = rows.groupBy("page_id", "href").agg(F.min(F.struct("pos", "label")).alias("l"))
    kinds = first.select("page_id", F.when(F.col("href").rlike(f"^(?:{department})"), "department").otherwise("other").alias("kind"), "l.pos", "href", "l.label")
    return kinds.withColumn("nth", F.row_number().over(Window.partitionBy("page_id", "kind").orderBy("pos"))).select("page_id", "kind", "nth", "href", "label")


def extracts(pages: DataFrame, generic: Iterable[str], photo: str, suffix: str = r"\.pdf") -> DataFrame:
    """(page_id, name, floors, photos): the heading of each page, and its links to files, by address `suffix`: photos where label or address holds the pattern `photo`, else floors with their label.

    Floors stand as in the page, photos by address. An address counts once. A
    `generic` label (folded; the empty one is given there too) names no floor
    and leaves the address for a later link. Without a heading name is null.
    """
    rows = _found(pages, FILE % suffix).withColumn("label", spaced_text(F.col("label")))
    rows = rows.withColumn("photo", F.col("label").rlike(photo) | F.col("href").rlike(photo)).where(F.col("photo") | ~casefolded(F.col("label")).isin(list(generic)))
    first = rows.groupBy("page_id", "href").agg(F.min(F.struct("pos", "photo", "label")).alias("l")).select("page_id", "href", "l.*")
    floor, sight = F.when(~F.col("photo"), F.struct("pos", "label", "href")), F.when(F.col("photo"), F.col("href"))
    files = first.groupBy("page_id").agg(F.array_sort(F.collect_list(floor)).alias("floors"), F.array_sort(F.collect_list(sight)).alias("photos"))
    floors = F.transform("floors", lambda x: F.struct(x["label"].alias("label"), x["href"].alias("href")))
    heads = pages.select("page_id", F.when(F.col("html").rlike(HEADING), spaced_text(F.regexp_extract("html", HEADING, 1))).alias("name"))
    none = F.array()
    return heads.join(files.select("page_id", floors.alias("floors"), "photos"), "page_id", "left").select("page_id", "name", F.coalesce("floors", none.cast("array<struct<label:string,href:string>>")).alias("floors"), F.coalesce("photos", none.cast("array<string>")).alias("photos"))


def files_of(extracted: DataFrame) -> DataFrame:
    """(page_id, name, kind, nth, label, href): a row for each file of extracts(), and one without a kind for a page that has none."""
    kind = lambda k, part, row: F.transform(part, lambda x, i: F.struct(F.lit(k).alias("kind"), (i + 1).alias("nth"), *row(x)))
    both = F.concat(kind("floor", "floors", lambda x: (x["label"].alias("label"), x["href"].alias("href"))), kind("photo", "photos", lambda x: (F.lit(None).cast("string").alias("label"), x.alias("href"))))
    return extracted.select("page_id", "name", F.explode_outer(both).alias("f")).select("page_id", "name", "f.*")


def addresses(markup: Column, pattern: str) -> Column:
    """Addresses of pages that a piece of prose names, each once, with one slash at the end, in order."""
    found = F.regexp_extract_all(F.coalesce(markup, F.lit("")), F.lit(f"({pattern})"), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.concat(F.rtrim(x, F.lit("/")), F.lit("/")))))


def selected(pages: DataFrame, pattern: str) -> DataFrame:
    """(page_id, value): what the pattern's first group finds in each page, less blanks."""
    return pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("value")).where(stripped(F.col("value")) != "")


def watch(now: DataFrame, last: DataFrame) -> DataFrame:
    """(page_id, value, more): values that a page has more (or, below 0, less) often than at the last look. Nothing selected at all is an error."""
    if now.isEmpty():
        raise ValueError("the selector matches nothing")
    both = now.withColumn("n", F.lit(1)).unionByName(last.withColumn("n", F.lit(-1)))
    return both.groupBy("page_id", "value").agg(F.sum("n").alias("more")).where("more <> 0")
