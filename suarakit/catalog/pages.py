"""Queries on stored web pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from suarakit.catalog import sql as S
from suarakit.catalog.tables import table
from suarakit.operators import frontier
from suarakit.operators import pages as P
from suarakit.operators.quality import keep_first
from suarakit.plans import jobs
from suarakit.session import spread

QUERIES, SQL = {}, {}

# Where the fixture's pages keep what the complaint site keeps elsewhere.
RULES = {
    "id": {"tag": "a", "href_contains": "/"},
    "judul": {"tag": "h1"},
    "isi": {"tag": "article", "prefer": "p"},
    "kategori": {"tag": "div", "css_class": "ad"},
}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def _text(x: str) -> str:
    """Entities of the fixture decoded in each text, texts stripped and joined."""
    decoded = "t"
    for entity, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        # A title cut short may lack the semicolon.
        decoded = S.sub(decoded, f"&{entity};?", char)
    pieces = f"string_split_regex({x}, '<[^>]*>')"
    return f"array_to_string(list_transform({pieces}, lambda t: {S.strip_space(decoded)}), '')"


# The first paragraph of an article ends at its end tag, or with the article if it is not closed.
_FIRST_PARAGRAPH = r"""CASE WHEN regexp_matches(html, '<article><h1>[^<]*</h1><p>[^<]*</p>')
  THEN regexp_extract(html, '<article><h1>[^<]*</h1><p>([^<]*)</p>', 1)
  ELSE regexp_extract(html, '(?s)<article><h1>[^<]*</h1><p>(.*)</article>', 1) END"""

_FIELDS = f"""fields AS (SELECT
  replace({_text(r"regexp_extract(html, '<a href=" + '"[^"]*/[^"]*"' + r">([^<]*)</a>', 1)")}, '#', '') AS id,
  {_text(r"regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS judul,
  {_text(_FIRST_PARAGRAPH)} AS isi,
  {_text(r"regexp_extract(html, '<div class=" + '"ad"' + r">([^<]*)</div>', 1)")} AS kategori, url, page_id FROM pages)"""


def _pages(spark, sf):
    return spread(table(spark, sf, "pages").select("url", "html"))


@query(f"WITH {_FIELDS} SELECT * EXCLUDE (page_id) FROM fields")
def page_fields(spark, sf):
    return P.page_fields(_pages(spark, sf), RULES)


@query("""SELECT url, (i - 1)::INT AS position, CASE WHEN starts_with(h, 'http') THEN h ELSE 'https://example.org' || h END AS link
FROM (SELECT url, unnest(l) AS h, unnest(range(1, len(l) + 1)) AS i
  FROM (SELECT url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS l FROM pages))""")
def page_links(spark, sf):
    return P.page_links(_pages(spark, sf), "https://example.org", {"tag": "li"})


@query(f"""WITH {_FIELDS}, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY page_id DESC) AS rn FROM fields)
SELECT id, judul, isi, kategori, url, coalesce(id, '') = '' OR coalesce(judul, '') = '' OR coalesce(isi, '') = '' AS is_incomplete
FROM r WHERE rn = 1""")
def complaints_from_pages(spark, sf):
    """Pages to complaints, one per id: the page that was fetched first, latest number first."""
    pages = spread(table(spark, sf, "pages").select("url", "html", (-F.col("page_id")).alias("fetched")))
    return jobs.complaints_from_pages(pages, rules=RULES, order="fetched")


# A page answers to the first word of its title, a link leads to the pages that answer to its text.
_ADDRESS = "'/' || lower(regexp_extract(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '^([a-zA-Z]+)', 1))"

_CRAWL = f"""p AS MATERIALIZED (SELECT page_id, url, {_ADDRESS} AS address, regexp_extract(url, '://([^/]*)', 1) AS host,
  contains(url, '?page=') AS is_list, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS links FROM pages),
l AS (SELECT page_id, '/' || lower(regexp_extract(unnest(links), '^/([a-zA-Z]+)', 1)) AS address FROM p),
e AS MATERIALIZED (SELECT DISTINCT l.page_id AS src, d.page_id AS dst FROM l JOIN p d USING (address) WHERE length(address) > 1),
log AS (SELECT page_id, host, row_number() OVER w AS number, n = 0 AS empty,
  n = 0 AND coalesce(lag(n, 1) OVER w, 1) = 0 AND coalesce(lag(n, 2) OVER w, 1) = 0 AS stop
  FROM (SELECT page_id, host, count(dst) AS n FROM p LEFT JOIN e ON src = page_id WHERE is_list GROUP BY page_id, host)
  WINDOW w AS (PARTITION BY host ORDER BY page_id)),
seeds AS (SELECT page_id FROM log LEFT JOIN (SELECT host, min(number) AS cut FROM log WHERE stop GROUP BY host) USING (host)
  WHERE cut IS NULL OR number <= cut),
r AS (SELECT page_id, 0 AS depth FROM seeds UNION SELECT dst, depth + 1 FROM r JOIN e ON src = page_id WHERE depth < 12),
reached AS (SELECT page_id, min(depth) AS depth FROM r GROUP BY page_id)"""


@query(f"""WITH RECURSIVE {_CRAWL}, {_FIELDS},
f AS (SELECT fields.*, depth, row_number() OVER (PARTITION BY id ORDER BY page_id DESC) AS rn FROM fields JOIN reached USING (page_id))
SELECT id, judul, url, depth FROM f WHERE rn = 1""")
def complaints_by_links(spark, sf):
    """From list pages over links to stored pages, and from those to complaints, one per id."""
    address = F.lower(F.concat(F.lit("/"), F.regexp_extract("title", "^([a-zA-Z]+)", 1)))
    stored = table(spark, sf, "pages").withColumn("title", F.regexp_extract("html", "<h1>([^<]*)</h1>", 1))
    stored = spread(stored.select(
        "page_id", "url", "html", F.when(F.length(address) > 1, address).alias("address"), F.regexp_extract("url", "://([^/]*)", 1).alias("host")
    ))
    pages = stored.withColumnRenamed("page_id", "page")
    found = P.page_links(stored.select(F.col("page_id").cast("string").alias("url"), "html"), "", {"tag": "li"})
    links = found.select(
        F.col("url").cast("bigint").alias("page"), F.lower(F.concat(F.lit("/"), F.regexp_extract("link", "^/([a-zA-Z]+)", 1))).alias("address")
    )
    is_list = F.contains("url", F.lit("?page="))
    numbered = pages.withColumn("list", is_list).withColumn(
        "number", F.row_number().over(Window.partitionBy("host", "list").orderBy("page"))
    )
    reached = frontier.follow(links, numbered, F.col("list"), F.col("host"), F.col("number"))
    fetched = stored.join(reached, F.col("page_id") == F.col("page")).select("url", "html", (-F.col("page_id")).alias("fetched"), "depth")
    fields = P.page_fields(fetched, RULES, ("fetched", "depth"))
    return keep_first(fields, ["id"], "fetched").select("id", "judul", "url", "depth")
