"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, collocations, decontaminate, licences, line_chunks, merkle, mixing, repeats, simhash, token_files, toxicity, url_filter, warc
from .common import new_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document (4-word shingles, 4 bits)."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_distance=4, seed=42)


#: Start and end weights of the curriculum's sources; they integrate to 1, 2 and 3.
SLOPES = [(0.5, 1.5), (2.0, 2.0), (4.5, 1.5)]

_MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5('mix' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS i FROM s),
w AS (SELECT source, source_size, source_size * 3 AS lim, [0.5, 2.0, 4.5][i + 1]::DOUBLE AS w0, [1.5, 2.0, 1.5][i + 1]::DOUBLE AS w1,
             (i + 1)::DOUBLE AS weight FROM n),
f AS (SELECT *, lim / weight <= (sum(source_size) OVER () - coalesce(sum(lim) OVER b, 0))
                               / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS filled
      FROM w WINDOW b AS (ORDER BY lim / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, CASE WHEN filled THEN lim::DOUBLE ELSE least(
             (sum(source_size) OVER () - sum(CASE WHEN filled THEN lim ELSE 0 END) OVER ())::DOUBLE * weight
             / sum(CASE WHEN filled THEN 0.0::DOUBLE ELSE weight END) OVER (), lim::DOUBLE) END AS target FROM f),
p AS (SELECT d.*, t.source_size, t.target, t.w0, t.w1,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
             CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, whole + CASE WHEN source_size > 0 AND whole < 3 AND before + size / 2.0::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END AS copies,
             least((before + size / 2.0::DOUBLE) / nullif(target, 0), 1.0::DOUBLE) * ((w0 + w1) / 2) AS done FROM p)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken,
       CASE WHEN copies > 0 AND target > 0 THEN CASE WHEN w1 = w0 THEN done / w0
            ELSE (sqrt(w0 * w0 + 2 * (w1 - w0) * done) - w0) / (w1 - w0) END END AS first_position
FROM c
"""


@register("op6_mixing", _MIX_SQL)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when sources are mixed by weights 1, 2, 3 in turn, at most three epochs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    planned = mixing.first_positions(mixing.plan(docs, SLOPES, max_epochs=3))
    return (planned.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "first_position")
            .orderBy(F.col("first_position").asc_nulls_last(), "doc_id"))


@register("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 10-word window of a benchmark item, and the items found."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def token_table(docs: DataFrame, name: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and list the documents from them."""
    import public_tokenizers

    spark = docs.sparkSession
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        tokenizer = f.read()
    path = new_path(spark, "tokens")
    token_files.write_token_files(docs, tokenizer, path, end_id, split_words=True)
    return token_files.read_token_files(spark, path)


@register("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and CRC-32 of every document's ids, read back from the Arrow files."""
    return token_table(table(spark, sf_dir, "documents"))


@register("op8_warc")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's WARC record, read back from the archives written of ``pages``."""
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, least_bytes=0)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 100-byte string covers which starts earlier, and the digest of the rest."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


#: Categories that the given labels can tell, in chain order.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1", "toxic_low_quality": "toxic = 1 AND quality = 0"}


@register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every category for every document, by the chain fitted on ``labels``."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.score(docs.select("doc_id", "text"), chain).drop("text")


_CHUNK_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM l),
c AS (SELECT *, (h + 31 * coalesce(lag(h, 1) OVER w, 0) + 961 * coalesce(lag(h, 2) OVER w, 0)) % 4 = 0 AS cut FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM c),
g AS (SELECT doc_id, chunk, min(i) AS start, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM k GROUP BY doc_id, chunk),
r AS (SELECT *, n > 1 AND row_number() OVER (PARTITION BY body, n > 1 ORDER BY doc_id, start) > 1 AS gone FROM g)
SELECT d.doc_id, coalesce(sum(r.n), 0)::BIGINT AS n_lines, coalesce(sum(CASE WHEN gone THEN r.n ELSE 0 END), 0)::BIGINT AS n_removed,
       md5(CASE WHEN any_value(d.text) IS NOT NULL THEN coalesce(string_agg(body, chr(10) ORDER BY start) FILTER (WHERE NOT gone), '') END) AS kept_md5
FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""


@register("op7_line_chunks", _CHUNK_SQL)
def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, lines in chunks that another document has earlier, and the digest of the rest."""
    out = line_chunks.remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("kept").alias("kept_md5"))


@register("op4_nearest")
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest embeddings found for every row whose vec_id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def file_tree(docs: DataFrame) -> DataFrame:
    """``documents`` as files: /source/lang/number/name, 256 to a directory.

    A document of under 2,000 characters that mentions a licence is a licence file; a still shorter one of those
    stands a directory higher, for all of a source's files in a language.
    """
    is_file = F.coalesce(F.col("text").rlike("(?i)licen[cs]e") & (F.length("text") < 2000), F.lit(False))
    top = F.concat(F.lit("/"), F.coalesce("source", F.lit("_")), F.lit("/"), F.coalesce("lang", F.lit("_")))
    directory = F.when(is_file & (F.length("text") < 600), top).otherwise(F.concat_ws("/", top, F.expr("CAST(doc_id DIV 256 AS STRING)")))
    name = F.when(is_file, F.concat(F.lit("LICENSE-"), "doc_id")).otherwise(F.concat("doc_id", F.lit(".txt")))
    return docs.select("doc_id", F.concat_ws("/", directory, name).alias("path"), "text")


@register("op5_licences")
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document as a file of a tree: its own, or that of the nearest licence file above."""
    files = file_tree(table(spark, sf_dir, "documents"))
    return licences.scan(files, licences.fit(files), id_cols=("doc_id",))


#: Rules of the query: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

_URL_SQL = r"""
WITH u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
rules(verdict, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
o AS (SELECT doc_id AS page_id, count(*) AS n, sum((toxic = 1 OR quality = 0)::INT) AS bad FROM labels
      WHERE doc_id IS NOT NULL AND (toxic = 1 OR quality = 0) IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, sum(coalesce(n, 0))::BIGINT AS n, sum(coalesce(bad, 0))::BIGINT AS bad FROM u LEFT JOIN o USING (page_id) GROUP BY host),
s AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), '\.?(:[0-9]*)?$', '') AS site FROM h),
p AS (SELECT *, string_split(site, '.') AS l, regexp_matches(site, '^[0-9]{1,3}(\.[0-9]{1,3}){3}$') OR contains(site, '[') AS num FROM s),
l AS (SELECT host, n, bad, CASE WHEN num THEN 'ip' WHEN two IN (%s) THEN two ELSE l[-1] END AS suffix,
             CASE WHEN num THEN site WHEN two IN (%s) THEN array_to_string(l[-3:], '.') ELSE two END AS domain
      FROM (SELECT *, array_to_string(l[-2:], '.') AS two FROM p)),
d AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM l GROUP BY domain, suffix),
x AS (SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM d GROUP BY suffix),
x1 AS (SELECT *, (SELECT (sum(bad) + 1)::DOUBLE / (sum(n) + 10) FROM x) AS parent FROM x),
x2 AS (SELECT *, (bad + k * parent) / ((bad + k * parent) + (n - bad + k * (1 - parent))) AS mean FROM x1, (SELECT %s AS k FROM x1 WHERE n > 0)),
d1 AS (SELECT d.*, x2.mean AS parent FROM d JOIN x2 USING (suffix)),
d2 AS (SELECT *, (bad + k * parent) / ((bad + k * parent) + (n - bad + k * (1 - parent))) AS mean FROM d1, (SELECT %s AS k FROM d1 WHERE n > 0)),
h1 AS (SELECT l.*, d2.mean AS parent FROM l JOIN d2 USING (domain, suffix)),
h2 AS (SELECT host, n, bad, bad + k * parent AS a, n - bad + k * (1 - parent) AS b FROM h1, (SELECT %s AS k FROM h1 WHERE n > 0)),
h3 AS (SELECT host, n, bad, greatest(a / (a + b) - 1.645::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0.0::DOUBLE) AS bound FROM h2),
r AS (SELECT DISTINCT ON (host, path) host, path, rh || rp AS rule, verdict
      FROM (SELECT DISTINCT host, path FROM u) JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
      ORDER BY host, path, len(rh || rp) DESC, len(rh) DESC, verdict DESC)
SELECT u.page_id, u.host, u.path, r.rule, coalesce(r.verdict, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       h3.n AS host_labelled, h3.bad AS host_bad, round(bound, 4) AS bad_bound
FROM u JOIN h3 ON h3.host = u.host LEFT JOIN r ON r.host = u.host AND r.path = u.path
"""
_STRENGTH_SQL = """1 / least(greatest(CASE WHEN sum(n::DOUBLE * (n - 1) * parent * (1 - parent)) > 0
    THEN sum((bad - n * parent) * (bad - n * parent) - n * parent * (1 - parent)) / sum(n::DOUBLE * (n - 1) * parent * (1 - parent))
    ELSE 0.1::DOUBLE END, 0.001::DOUBLE), 0.999::DOUBLE) - 1"""
_LONG = ", ".join(f"'{s}'" for s in url_filter.LONG_SUFFIXES)


@register("op11_url_filter", _URL_SQL % (_LONG, _LONG, _STRENGTH_SQL, _STRENGTH_SQL, _STRENGTH_SQL))
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page; a page's label is that of the document of its number, bad if toxic or of low quality."""
    rules = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in URL_RULES])))
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.expr("toxic = 1 OR quality = 0").alias("bad"))
    out = url_filter.judge(table(spark, sf_dir, "pages"), rules, outcomes)
    return out.withColumn("bad_bound", F.round("bad_bound", 4))


_MERKLE_SQL = r"""
WITH RECURSIVE
crc AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
            lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc
        FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
t AS (SELECT d.doc_id, d.source, coalesce('=' || d.source, '') AS tree, d.text,
             coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id::VARCHAR, '-') || coalesce(strlen(d.source) || ':' || d.source, '-')
             || coalesce(strlen(d.lang) || ':' || d.lang, '-') || coalesce(strlen(d.n_chars::VARCHAR) || ':' || d.n_chars::VARCHAR, '-') AS head,
             CASE WHEN crc %% 2 = 0 AND contains(d.text, chr(10)) THEN replace(d.text, chr(10), '') END AS given
      FROM documents d LEFT JOIN crc ON crc.doc_id = d.doc_id),
l AS MATERIALIZED (SELECT tree, doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             CASE WHEN given IS NOT NULL THEN sha256(head || strlen(given) || ':' || given) END AS given FROM t),
n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l),
up AS (SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM n
       UNION ALL SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
s AS MATERIALIZED (SELECT tree, h AS subroot, lvl AS height, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lvl, pos, n, subroot AS h FROM s
        UNION ALL SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n),
r AS (SELECT h AS root FROM top WHERE n = 1),
sib AS MATERIALIZED (SELECT a.tree, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lft,
               coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rgt
        FROM up a JOIN up b ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.tree, a.lvl, a.pos
        UNION ALL SELECT NULL, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), ''),
               coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '')
        FROM top a JOIN top b ON a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.lvl, a.pos),
f AS (SELECT n.tree, n.pos AS leaf_pos, 0 AS lvl, s.height, s.height + (SELECT max(lvl) FROM top) AS high, n.pos AS pos, s.pos AS top_pos, coalesce(given, leaf) AS cur, '' AS proof
      FROM n JOIN s USING (tree)
      UNION ALL
      SELECT f.tree, leaf_pos, f.lvl + 1, height, high, CASE WHEN f.lvl + 1 = height THEN top_pos ELSE f.pos // 3 END, top_pos,
             sha256(lft || cur || rgt), proof || lft || rgt
      FROM (SELECT *, CASE WHEN lvl = 0 AND height = 0 THEN top_pos ELSE pos END AS p FROM f) f
      JOIN sib ON sib.tree IS NOT DISTINCT FROM (CASE WHEN f.lvl < height THEN f.tree END)
              AND sib.lvl = (CASE WHEN f.lvl < height THEN f.lvl ELSE f.lvl - height END) AND sib.pos = f.p
      WHERE f.lvl < high)
SELECT n.doc_id, n.leaf, s.subroot, r.root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root, f.cur = r.root AS verified
FROM n JOIN s USING (tree) JOIN f ON f.tree = n.tree AND f.leaf_pos = n.pos AND f.lvl = f.high CROSS JOIN r
""".replace("%%", "%")


@register("op12_merkle_manifest", _MERKLE_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and recomputed root of every document, line feeds deleted from those with even CRC-32 of their id."""
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, merkle.without_line_feeds(docs))


_PHRASE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, unnest(flatten(list_transform([1, 2, 3], lambda n: list_transform(range(1, len(w) - n + 2), lambda i: w[i:i + n - 1])))) AS ws FROM p),
c AS (SELECT lang, ws, count(*)::HUGEINT AS a FROM g GROUP BY lang, ws),
t AS (SELECT lang, sum(a)::BIGINT AS n FROM c WHERE len(ws) = 1 GROUP BY lang),
f AS MATERIALIZED (SELECT * FROM c WHERE a >= 10),
k AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM f WHERE len(ws) > 1),
s AS (SELECT k.lang, k.ws, k.a, k.k, x.a AS l, y.a AS r, (1000000::HUGEINT * k.a * k.a) // (x.a * y.a) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.ws = k.ws[1:k.k] JOIN f y ON y.lang = k.lang AND y.ws = k.ws[k.k + 1:]),
b AS (SELECT DISTINCT ON (lang, ws) * FROM s ORDER BY lang, ws, score, k),
o AS (SELECT lang, unnest([ws[1:2], ws[2:3]]) AS ws, a FROM f WHERE len(ws) = 3),
m AS (SELECT lang, ws, max(a) AS more FROM o GROUP BY lang, ws),
e AS (SELECT b.lang, array_to_string(b.ws, ' ') AS phrase, b.a, l, r, score FROM b LEFT JOIN m ON m.lang = b.lang AND m.ws = b.ws
      WHERE more IS NULL OR 100 * more < 50 * b.a),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e)
SELECT z.lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM z JOIN t ON t.lang = z.lang WHERE rank <= 2000
"""


@register("op13_collocations", _PHRASE_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of 2 or 3 words of every language, of those that occur 10 times or more."""
    return collocations.mine(table(spark, sf_dir, "documents"), max_words=3, min_count=10, share=50, top=2000)
