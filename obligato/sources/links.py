"""Link harvesting over raw HTML pages (A7-A9, A11, A24/A25 upsert).

Anchors are pulled with one regex pass per page (``regexp_extract_all`` for
href and text, zipped and exploded with their position), so work is per
page and fully parallel; tier resolution is a ``groupBy`` with ``max_by`` /
``min_by`` on the link position. No network access: pages are an input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Any letter case, quotes of either kind or none, line breaks within the tag and its text.
ANCHOR_RE = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)[^>]*>(.*?)</a\s*>"""
# Character references that occur in links and their texts; the ampersand comes last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def _unescaped(c):
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def anchors(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, page_url, link_ord, href, text) for every anchor with an href."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR_RE), 1)
    texts = F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR_RE), 2)
    z = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("page_url"),
                     F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text"))).alias("link_ord", "a"))
    text = F.trim(F.regexp_replace(_unescaped(F.regexp_replace(F.col("a.text"), "<[^>]*>", "")), r"\s+", " "))
    href = F.trim(_unescaped(F.regexp_replace(F.col("a.href"), r"""^["']|["']$""", "")))
    return z.select("page_id", "page_url", (F.col("link_ord") + 1).alias("link_ord"), href.alias("href"), text.alias("text"))


def resolve(href, page_url, base_url: str | None = None):
    """Absolute URL: http(s) kept; '/x' against the page origin; other relative
    links against ``base_url`` when given, else the page's directory."""
    origin = F.regexp_extract(page_url, r"^(https?://[^/?#]+)", 1)
    base = F.lit(base_url) if base_url else F.regexp_extract(page_url, r"^(https?://[^?#]*/)", 1)
    return (F.when(href.startswith("http"), href)
            .when(href.startswith("/"), F.concat(origin, href))
            .otherwise(F.concat(base, href)))


def harvest_links(pages: DataFrame, needles=(".xlsx", ".xls"), base_url: str | None = None) -> DataFrame:
    """Links whose href contains any needle: absolute url, file name (after the
    last '/'), description (link text, else the file name)."""
    a = anchors(pages)
    cond = F.lit(False)
    for n in needles:
        cond = cond | F.col("href").contains(n)
    fname = F.substring_index(F.col("href"), "/", -1)
    return a.where(cond).select(
        "page_id", "link_ord", resolve(F.col("href"), F.col("page_url"), base_url).alias("url"),
        F.when(F.col("text") != "", F.col("text")).otherwise(fname).alias("description"),
        fname.alias("filename"))


def harvest_period_links(pages: DataFrame, text_re: str, text_marker: str, url_re: str, url_marker: str,
                         base_url: str | None = None) -> DataFrame:
    """Key -> url. Text tier: link text matches ``text_re`` (group 1 = key) and
    contains ``text_marker``; a later link overwrites an earlier one. URL tier:
    href matches ``url_re`` and contains ``url_marker``; fills only keys the text
    tier did not find, first hit wins."""
    a = anchors(pages).withColumn("url", resolve(F.col("href"), F.col("page_url"), base_url))
    order = F.struct("page_id", "link_ord")
    tk = F.regexp_extract(F.col("text"), text_re, 1)
    t = (a.where((tk != "") & F.col("text").contains(text_marker)).withColumn("key", tk)
         .groupBy("key").agg(F.max_by("url", order).alias("url")).withColumn("tier", F.lit("text")))
    uk = F.regexp_extract(F.col("href"), url_re, 1)
    u = (a.where((uk != "") & F.col("href").contains(url_marker)).withColumn("key", uk)
         .groupBy("key").agg(F.min_by("url", order).alias("url")).withColumn("tier", F.lit("url")))
    return t.unionByName(u.join(t.select("key"), "key", "left_anti"))


def generate_period_links(found: DataFrame, template: str, lo: int, hi: int, min_found: int = 5) -> DataFrame:
    """When fewer than ``min_found`` keys were found, one generated url per year
    lo..hi (replacing the found ones); otherwise the found links. The count is
    a scalar subquery, so nothing is collected."""
    n = found.select(F.count(F.lit(1))).scalar()
    years = found.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias("year"))
    gen = (years.where(n < min_found)
           .select(F.col("year").cast("string").alias("key"),
                   F.replace(F.lit(template), F.lit("{year}"), F.col("year").cast("string")).alias("url"),
                   F.lit("generated").alias("tier")))
    return found.where(n >= min_found).select("key", "url", "tier").unionByName(gen)


def label_files(links: DataFrame, labels: DataFrame, key: str = "filename", label_col: str = "label") -> DataFrame:
    """File id -> label through a lookup table, falling back to the description."""
    return (links.join(labels.select(F.col(key).alias("_k"), F.col(label_col).alias("_label")),
                       links[key] == F.col("_k"), "left")
            .withColumn("label", F.coalesce(F.col("_label"), F.col("description")))
            .drop("_k", "_label"))


def upsert(old: DataFrame, new: DataFrame, key: str = "key", value: str = "url") -> DataFrame:
    """Insert-or-replace by key; new rows win. Output sorted by the key
    as an integer when it is one, with the row's origin (original / added /
    replaced)."""
    tagged = (old.select(key, value).withColumn("_tag", F.lit(0))
              .unionByName(new.select(key, value).withColumn("_tag", F.lit(1))))
    g = tagged.groupBy(key).agg(F.max_by(value, "_tag").alias(value), F.min("_tag").alias("_min"),
                                F.max("_tag").alias("_max"))
    origin = (F.when(F.col("_max") == 0, F.lit("original")).when(F.col("_min") == 1, F.lit("added"))
              .otherwise(F.lit("replaced")))
    return (g.select(key, value, origin.alias("origin"))
            .orderBy(F.col(key).try_cast("int").asc_nulls_last(), F.col(key)))
