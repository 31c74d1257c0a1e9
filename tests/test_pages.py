"""Links, extracts and plain text of markup as pages really have it."""

import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from cairnfield.functions.markup import plain_text, spaced_text, unescaped
from cairnfield.operators import pages

DEPARTMENT, HALLS = r"(?i)https://dept\.example/(?!news/|halls/)", r"(?i)https://dept\.example/halls/[a-z0-9-]+/?"


def links(spark, markup):
    found = pages.links(spark.createDataFrame([(1, markup)], "page_id int, html string"), DEPARTMENT, HALLS)
    return [(r["kind"], r["href"], r["label"]) for r in found.orderBy("kind", "nth").collect()]


def test_anchors_of_all_forms(spark):
    markup = """<p><a class="b" href="https://dept.example/music" id=x>Music <b>and</b>
      more</a><A TARGET=_blank HREF="https://dept.example/art/">Art &amp; Design</A>
      <a
      href="https://other.example/?a=1&amp;b=2">Other</a><a href="https://dept.example/news/1">Story</a>"""
    assert links(spark, markup) == [("department", "https://dept.example/music", "Music and more"), ("department", "https://dept.example/art/", "Art & Design"), ("other", "https://other.example/?a=1&b=2", "Other"), ("other", "https://dept.example/news/1", "Story")]


def test_first_label_that_says_something_counts(spark):
    markup = '<a href="https://dept.example/a">\t&nbsp;<br></a><a href="https://dept.example/a">A</a><a href="https://dept.example/a">again</a><a href="">none</a><a name="x">y</a>'
    assert links(spark, markup) == [("department", "https://dept.example/a", "A")]


def test_halls_are_left_out_and_case_does_not_matter(spark):
    markup = '<a href="https://dept.example/halls/old-hall">a</a><a href="HTTPS://DEPT.EXAMPLE/HALLS/new//">b</a><a href="https://dept.example/halls/">c</a><a href="https://dept.example/halls/x/y">d</a><a href="HTTPS://dept.example/MUSIC">e</a>'
    assert links(spark, markup) == [("department", "HTTPS://dept.example/MUSIC", "e"), ("other", "https://dept.example/halls/", "c"), ("other", "https://dept.example/halls/x/y", "d")]


def test_pages_without_links(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "<a href='x'>single quotes</a>")], "page_id int, html string")
    assert pages.links(rows, DEPARTMENT).collect() == []
    assert [tuple(r) for r in pages.extracts(rows, ["", "here"], "photo").orderBy("page_id").collect()] == [(i, None, [], []) for i in (1, 2, 3)]


def extract(spark, markup):
    row = pages.extracts(spark.createDataFrame([(1, markup)], "page_id int, html string"), ["download", "here", "click here", ""], r"(?i)room[ _-]?photos?").first()
    return row["name"], [tuple(f) for f in row["floors"]], row["photos"]


def test_extract_of_floors_and_photos(spark):
    markup = """<h1 class="t">Big <i>Hall</i> &amp; Annex</h1><h1>Second</h1>
      <a class="wp" href="/f/first.PDF">First<br>floor</a><a href="/f/first.PDF">Download</a>
      <a href="/f/second.pdf"> CLICK   here </a><a href="/f/second.pdf">Second floor</a>
      <a href="/f/room-photos-b.pdf">Download</a><a href="/f/a.pdf">Room_Photo</a><a href="/f/a.pdf">Again</a>
      <a href="/f/page.html">Page</a><a href="/f/third.pdf"></a>"""
    assert extract(spark, markup) == ("Big Hall & Annex", [("First floor", "/f/first.PDF"), ("Second floor", "/f/second.pdf")], ["/f/a.pdf", "/f/room-photos-b.pdf"])
    assert extract(spark, "<h1></h1>") == ("", [], [])


def test_files_are_rows(spark):
    rows = spark.createDataFrame([(1, '<h1>A</h1><a href="x.pdf">F</a><a href="y.pdf">G</a><a href="photo.pdf">H</a>'), (2, "no")], "page_id int, html string")
    got = pages.files_of(pages.extracts(rows, [""], "photo")).orderBy("page_id", "kind", "nth").collect()
    assert [tuple(r) for r in got] == [(1, "A", "floor", 1, "F", "x.pdf"), (1, "A", "floor", 2, "G", "y.pdf"), (1, "A", "photo", 1, None, "photo.pdf"), (2, None, None, None, None, None)]


def test_addresses_in_prose(spark):
    prose = "see https://dept.example/halls/b, https://dept.example/halls/a/ and <a href='https://dept.example/halls/b/'>"
    assert spark.range(1).select(pages.addresses(F.lit(prose), HALLS).alias("a")).first()["a"] == ["https://dept.example/halls/a/", "https://dept.example/halls/b/"]


def test_references_as_the_standard_has_them(spark):
    draw, names = random.Random(3), sorted(html5)
    odd = ["&", "&&", "&;", "&x", "&#", "&#x", "&#;", "&# 1", "&#x;", "é", "<b>", "\n", "&notit;", "&AMPx", "&hellip", "&" + "x" * 40]
    texts = [None, "", *odd]
    for _ in range(1500):
        parts = [draw.choice(odd), f"&{draw.choice(names)}", f"&{draw.choice(names).rstrip(';')}{draw.choice(['', 'x', '=', '1;'])}", f"&#{draw.choice([draw.randrange(300), draw.randrange(0x110010), 0xFEFF, 0xFFFE, 0x1FFFF, 0xD800, 10**12])}{draw.choice([';', '', 'x'])}", f"&#{draw.choice('xX')}{draw.choice([draw.randrange(300), draw.randrange(0x110010), 10**12]):x}{draw.choice([';', '', 'g'])}"]
        texts.append("".join(draw.choices(parts, k=draw.randrange(1, 6))))
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    df = rows.select("t", unescaped(F.col("t")).alias("u"))
    assert [(r["t"], r["u"]) for r in df.collect()] == [(t, t if t is None else html.unescape(t)) for t in texts]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_tags_vanish_or_divide(spark):
    t = F.lit("a<b>b</b><br/>c<li>d</li>&nbsp;\x1ce")
    assert tuple(spark.range(1).select(plain_text(t), spaced_text(t)).first()) == ("ab cd e", "a b c d e")
