"""Registered queries: text of pages, links, page watches."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import functions as F

from ..functions.markup import plain_text as plain
from ..operators import pages as P
from ..sources import views as V

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


# The rule of references once more, as SQL: names with and without semicolon, numbers of both kinds.
def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _map(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{_text(k)}: {_text(v)}" for k, v in pairs.items()) + "}"


_BARE = {n: t for n, t in html5.items() if not n.endswith(";")}
_ODD = {"0": "�", "13": "\r"} | {str(n): bytes([n]).decode("cp1252", "replace").replace("�", chr(n)) for n in range(128, 160)}
#: One row with the tables; what uses _unescaped() reads from it too.
TABLES = f"tables AS MATERIALIZED (SELECT {_map(html5)} AS names, {_map(_BARE)} AS bare, {_map(_ODD)} AS odd)"
_BARE_NAME = "^(" + "|".join(sorted(_BARE, key=lambda n: (-len(n), n))) + ")"
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _number(n: str) -> str:
    none = f"{n} BETWEEN 1 AND 8 OR {n} = 11 OR {n} BETWEEN 14 AND 31 OR {n} BETWEEN 127 AND 159 OR {n} BETWEEN 64976 AND 65007 OR {n} % 65536 >= 65534"
    return f"coalesce(odd[CAST({n} AS VARCHAR)], CASE WHEN {n} BETWEEN 55296 AND 57343 OR {n} > 1114111 THEN chr(65533) WHEN {none} THEN '' ELSE chr(CAST({n} AS INTEGER)) END)"


def _unescaped(x: str) -> str:
    digits = "regexp_extract(z[2], '^&#[xX]?([0-9a-fA-F]+)', 1)"
    hexed, dec = f"coalesce(try_cast('0x' || {digits} AS BIGINT), 1114112)", f"coalesce(try_cast({digits} AS BIGINT), 1114112)"
    bare = f"regexp_extract(z[2][2:], '{_BARE_NAME}', 1)"
    each = f"CASE WHEN z[2] IS NULL THEN '' WHEN regexp_matches(z[2], '^&#[xX]') THEN {_number(hexed)} WHEN starts_with(z[2], '&#') THEN {_number(dec)} ELSE coalesce(names[z[2][2:]], bare[{bare}] || z[2][2 + length({bare}):], z[2]) END"
    return f"array_to_string(list_transform(list_zip(string_split_regex({x}, '{_REFERENCE}'), regexp_extract_all({x}, '{_REFERENCE}')), lambda z: coalesce(z[1], '') || {each}), '')"


_SQUEEZE = "trim(regexp_replace({}, '[\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\p{{Z}}]+', ' ', 'g'))"


def _plain(x: str) -> str:
    spaced = f"regexp_replace({x}, '(?i)<br\\s*/?>|</p>|</li>', ' ', 'g')"
    return f"nullif({_SQUEEZE.format(_unescaped(f'''regexp_replace({spaced}, '<[^>]+>', '', 'g')'''))}, '')"


def _spaced(x: str) -> str:
    return _SQUEEZE.format(_unescaped(f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"))


#: Pages whose markup is written in four ways, as V.marked_pages has them.
_MARKED = """marked AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN html WHEN 1 THEN replace(html, '<a href=', '<a class="n"' || chr(10) || ' HREF=')
  WHEN 2 THEN replace(replace(html, '<a href="/', '<A rel=x href="/news/'), '">', '" title=''x''><i>')
  ELSE replace(replace(html, '<a href="/', '<a href="/&amp;'), '</a>', '&eacute;&#8217;&#x41;&ampx&notit;&bogus;&#150;</a>') END AS html FROM pages)"""


def _anchors(pattern: str) -> str:
    return f"""SELECT page_id, unnest(range(len(h))) AS pos, unnest(h) AS href, unnest(t) AS label FROM (SELECT page_id, regexp_extract_all(html, '{pattern}', 1) AS h, regexp_extract_all(html, '{pattern}', 2) AS t FROM marked)"""


@query(f"WITH {TABLES}, {_MARKED} SELECT page_id, {_plain('html')} AS text FROM marked, tables")
def plain_text(spark, sf):
    return V.marked_pages(spark, sf).select("page_id", plain(F.col("html")).alias("text"))


@query(f"""WITH {TABLES}, {_MARKED}, a AS ({_anchors('(?is)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>')}),
l AS (SELECT page_id, pos, {_unescaped('href')} AS href, {_plain('label')} AS label FROM a, tables),
f AS (SELECT * FROM l WHERE label IS NOT NULL AND NOT regexp_full_match(rtrim(href, '/') || '/', '(?i)/th[a-z]*/?') QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1)
SELECT page_id, kind, row_number() OVER (PARTITION BY page_id, kind ORDER BY pos) AS nth, href, label FROM (SELECT *, CASE WHEN starts_with(href, '/') AND NOT starts_with(href, '/news/') THEN 'department' ELSE 'other' END AS kind FROM f)""")
def page_links(spark, sf):
    return P.links(V.marked_pages(spark, sf), r"/(?!news/)", skip=r"(?i)/th[a-z]*/?")


@query(f"""WITH {TABLES}, {_MARKED}, a AS ({_anchors('(?is)<a[^>]+href="([^"]+e)"[^>]*>(.*?)</a>')}),
l AS (SELECT page_id, pos, href, {_spaced('label')} AS label FROM a, tables),
k AS (SELECT *, regexp_matches(label, '(?i)d[aeiou]s') OR regexp_matches(href, '(?i)d[aeiou]s') OR ends_with(lower(href), '/the') AS photo FROM l),
f AS (SELECT * FROM k WHERE photo OR lower(label) NOT IN ('de', 'die', 'une', '') QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1),
n AS (SELECT page_id, CASE WHEN photo THEN 'photo' ELSE 'floor' END AS kind, row_number() OVER (PARTITION BY page_id, photo ORDER BY CASE WHEN photo THEN 0 ELSE pos END, href) AS nth, CASE WHEN NOT photo THEN label END AS label, href FROM f),
h AS (SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<h1[^>]*>(.*?)</h1>') THEN {_spaced("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} END AS name FROM marked, tables)
SELECT page_id, name, kind, nth, label, href FROM h LEFT JOIN n USING (page_id)""")
def page_extract(spark, sf):
    """As floor plans are told from photos, on the addresses that these pages have."""
    return P.files_of(P.extracts(V.marked_pages(spark, sf), generic=["de", "die", "une", ""], photo=r"(?i)d[aeiou]s|/the$", suffix="e"))


@query("""WITH s AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS value FROM pages), a AS (SELECT page_id, value, count(*) AS n FROM s WHERE trim(value) <> '' GROUP BY ALL), b AS (SELECT page_id, value, count(*) AS n FROM s WHERE trim(value) <> '' AND length(value) % 5 <> 0 GROUP BY ALL)
SELECT a.page_id, a.value, a.n - coalesce(b.n, 0) AS more FROM a LEFT JOIN b USING (page_id, value) WHERE a.n <> coalesce(b.n, 0)""")
def page_watch(spark, sf):
    now = P.selected(V.table(spark, sf, "pages"), "<li>(.*?)</li>")
    last = now.where("length(value) % 5 <> 0")
    return P.watch(now, last)
