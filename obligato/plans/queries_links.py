"""Registered queries: link harvesting over ``pages``.

The fixture pages carry root-relative word links and no spreadsheet links,
so the match patterns are arguments: A7 keeps links whose href contains
'tion' or 'ment'; A8 keys links by their first two lower-case letters (text
tier) or the first two letters of the path (URL tier).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import links as L
from ..sources.fixture import table
from ..sources.sinks import output_dir
from ..sources.stored import read_registry, store_upsert
from . import oracle_sql as S
from .registry import register

NEEDLES = ["tion", "ment"]
TEXT_RE, URL_RE = "^([a-z]{2})", "^/([a-z]{2})"
TEMPLATE = "https://reports.example.org/budget/FY%20{year}%20-%20Reports.html"
LABELS = [("The", "Legislative Branch"), ("and", "Judicial Branch"), ("to", "Department of State")]

_RE = S.q(L.ANCHOR_RE)


def _plain(x: str) -> str:
    for entity, char in L.ENTITIES:
        x = f"replace({x}, {S.q(entity)}, {S.q(char)})"
    return x


ANCHORS = [("a0", f"""
SELECT page_id, page_url, unnest(generate_series(1, len(h))) AS link_ord, unnest(h) AS h, unnest(t) AS t FROM (
  SELECT page_id, url AS page_url, regexp_extract_all(html, {_RE}, 1) AS h, regexp_extract_all(html, {_RE}, 2) AS t
  FROM pages)"""),
           ("a", f"""
SELECT page_id, page_url, link_ord, trim({_plain("regexp_replace(h, '^[''\"]|[''\"]$', '', 'g')")}) AS href,
       trim(regexp_replace({_plain("regexp_replace(t, '<[^>]*>', '', 'g')")}, '\\s+', ' ', 'g')) AS text FROM a0"""),
           ("a2", """
SELECT *, CASE WHEN starts_with(href, 'http') THEN href
               WHEN starts_with(href, '/') THEN regexp_extract(page_url, '^(https?://[^/?#]+)', 1) || href
               ELSE regexp_extract(page_url, '^(https?://[^?#]*/)', 1) || href END AS url FROM a""")]

_PERIOD = ANCHORS + [
    ("t", f"""SELECT key, arg_max(url, {{'p': page_id, 'l': link_ord}}) AS url, 'text' AS tier FROM (
        SELECT *, regexp_extract(text, {S.q(TEXT_RE)}, 1) AS key FROM a2) WHERE key <> '' GROUP BY key"""),
    ("u", f"""SELECT key, arg_min(url, {{'p': page_id, 'l': link_ord}}) AS url, 'url' AS tier FROM (
        SELECT *, regexp_extract(href, {S.q(URL_RE)}, 1) AS key FROM a2) WHERE key <> '' GROUP BY key"""),
    ("found", "SELECT * FROM t UNION ALL SELECT * FROM u WHERE key NOT IN (SELECT key FROM t)"),
]


def _with(ctes) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({b.strip()})" for n, b in ctes) + "\n"


def pages(spark, d):
    return table(spark, d, "pages")


@register("harvest_links", _with(ANCHORS) + f"""
SELECT page_id, link_ord, url, CASE WHEN text <> '' THEN text ELSE string_split(href, '/')[-1] END AS description,
       string_split(href, '/')[-1] AS filename
FROM a2 WHERE {' OR '.join(f"contains(href, {S.q(n)})" for n in NEEDLES)}""")
def q_harvest_links(spark, d):
    """Links whose href contains a needle, made absolute against the page url."""
    return L.harvest_links(pages(spark, d), NEEDLES)


@register("harvest_period_links", _with(_PERIOD) + "SELECT * FROM found")
def q_harvest_period_links(spark, d):
    """Key -> url with a text tier (last hit wins) and a URL tier filling gaps (first hit wins)."""
    return L.harvest_period_links(pages(spark, d), TEXT_RE, "", URL_RE, "")


def _generated_sql(min_found: int) -> str:
    return _with(_PERIOD) + f"""
SELECT key, url, tier FROM found WHERE (SELECT count(*) FROM found) >= {min_found}
UNION ALL
SELECT CAST(y AS VARCHAR) AS key, replace({S.q(TEMPLATE)}, '{{year}}', CAST(y AS VARCHAR)) AS url, 'generated' AS tier
FROM range(1998, 2026) r(y) WHERE (SELECT count(*) FROM found) < {min_found}"""


@register("generate_period_links", _generated_sql(5))
def q_generate_period_links(spark, d):
    """Found links kept when at least five keys were found."""
    return L.generate_period_links(L.harvest_period_links(pages(spark, d), TEXT_RE, "", URL_RE, ""),
                                   TEMPLATE, 1998, 2025, 5)


@register("generate_period_links_fallback", _generated_sql(100000))
def q_generate_period_links_fallback(spark, d):
    """Fewer keys than required -> one generated url per year 1998-2025."""
    return L.generate_period_links(L.harvest_period_links(pages(spark, d), TEXT_RE, "", URL_RE, ""),
                                   TEMPLATE, 1998, 2025, 100000)


@register("label_files", _with(ANCHORS + [("lb", "SELECT * FROM (VALUES " + ", ".join(
    f"({S.q(k)}, {S.q(v)})" for k, v in LABELS) + ") t(filename, label)")]) + f"""
SELECT h.*, coalesce(lb.label, h.description) AS label FROM (
  SELECT page_id, link_ord, url, CASE WHEN text <> '' THEN text ELSE string_split(href, '/')[-1] END AS description,
         string_split(href, '/')[-1] AS filename FROM a2) h LEFT JOIN lb ON h.filename = lb.filename""")
def q_label_files(spark, d):
    """File id -> agency label through a lookup, description as fallback (all links)."""
    labels = spark.createDataFrame(LABELS, "filename string, label string")
    return L.label_files(L.harvest_links(pages(spark, d), ["/"]), labels)


@register("upsert_url_registry", _with(_PERIOD) + """
SELECT key, url, origin FROM (
  SELECT key, arg_max(url, tag) AS url,
         CASE WHEN max(tag) = 0 THEN 'original' WHEN min(tag) = 1 THEN 'added' ELSE 'replaced' END AS origin
  FROM (SELECT key, url, 0 AS tag FROM t UNION ALL SELECT key, url, 1 AS tag FROM u) GROUP BY key)
ORDER BY TRY_CAST(key AS INTEGER) NULLS LAST, key""")
def q_upsert_url_registry(spark, d):
    """Insert-or-replace of the text-tier registry with the URL-tier links."""
    p = pages(spark, d)
    found = L.harvest_period_links(p, TEXT_RE, "", URL_RE, "")
    a = L.anchors(p).withColumn("url", L.resolve(F.col("href"), F.col("page_url")))
    order = F.struct("page_id", "link_ord")
    uk = F.regexp_extract(F.col("href"), URL_RE, 1)
    new = (a.where(uk != "").withColumn("key", uk).groupBy("key").agg(F.min_by("url", order).alias("url")))
    return L.upsert(found.where(F.col("tier") == "text"), new)


@register("stored_url_registry", _with(_PERIOD) + """
SELECT key, url, CASE WHEN tags = 2 THEN 'replaced' WHEN first = 1 THEN 'added' ELSE 'original' END AS origin, 2 AS version FROM (
  SELECT key, arg_max(url, tag) AS url, count(DISTINCT tag) AS tags, min(tag) AS first
  FROM (SELECT key, url, 0 AS tag FROM t UNION ALL SELECT key, url, 1 AS tag FROM u) GROUP BY key)""")
def q_stored_url_registry(spark, d):
    """A24/A25 on stored state: the text tier's links, then the URL tier's, whose run is repeated; two versions remain, read from storage."""
    p, path = pages(spark, d), output_dir(spark, "registry")
    a = L.anchors(p).withColumn("url", L.resolve(F.col("href"), F.col("page_url")))
    order = F.struct("page_id", "link_ord")
    text = L.harvest_period_links(p, TEXT_RE, "", URL_RE, "").where(F.col("tier") == "text")
    uk = F.regexp_extract(F.col("href"), URL_RE, 1)
    store_upsert(text, path, "text")
    for _ in range(2):
        version = store_upsert(a.where(uk != "").withColumn("key", uk).groupBy("key").agg(F.min_by("url", order).alias("url")), path, "url")
    return read_registry(spark, path).select("key", "url", "origin", F.lit(version.number).alias("version"))
