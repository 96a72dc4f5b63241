"""The operators as registered queries: whole tables, production parameters, the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import (
    collocations, divergence, fingerprints, license_scan, lm_score, mixing, ngram_join, packing, quality, suffix_dedup, token_counts, url_filter, warc,
)
from lakeops.session import scratch_path

#: The tokenizers' files; the package that has them is public, its folder a matter of the machine.
TOKENIZER, COUNTED = "word_bpe_49k.json", "byte_bpe_50k.json"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def modest_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of some megabytes, as two workers and a JVM share an executor.

    This is the session's setting; the operators work with any.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        modest_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@_query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


@_query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_table(spark, sf_dir, "documents"))


@_query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer())


@_query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(_table(spark, sf_dir, "documents"))


@_query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


@_query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document of its number."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), bad.alias("bad"))
    return url_filter.judge(_table(spark, sf_dir, "pages"), labels)


@_query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = scratch_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), archive)
    return warc.read(spark, archive).drop("target_uri", "file")


@_query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so every distinct text is encoded."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer(COUNTED), scratch_path(spark, "token-counts"))


ORACLE["op2_warc"] = """
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
"""


@_query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents")).drop("text_hash")


@_query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents"))


# Every 50-byte string with the smallest document that has it, in hexadecimal digits; starts that
# are at most 50 bytes apart cover one run; what is between runs is kept.
ORACLE["op1_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS x FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
f AS (SELECT x, min(doc_id) AS first_id FROM s GROUP BY x),
c AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new
  FROM s JOIN f USING (x) WHERE first_id < doc_id),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM
  (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM c) GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
t AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last_b,
  string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last_b, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""

ORACLE["op6_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, l.b FROM reach JOIN l ON l.a = reach.other)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.other) AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""


# The level that the targets share is the greatest that any number of capped sources leaves.
ORACLE["op9_mixing"] = r"""
WITH z AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
g AS (SELECT source, sum(size) AS source_size FROM z GROUP BY source),
w AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight, 3.0::DOUBLE * source_size AS most FROM g),
o AS (SELECT *, sum(most) OVER p AS capped, sum(weight) OVER p AS used, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM w WINDOW p AS (ORDER BY most / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
v AS (SELECT greatest(max(total / weights), max(CASE WHEN weights > used THEN (total - capped) / (weights - used) END)) AS level FROM o),
t AS (SELECT source, source_size, least(most, weight * level) AS target,
  (CAST('0x' || substr(md5(concat_ws(':', source, '7')), 1, 7) AS BIGINT) + 0.5) / 268435456.0 AS u FROM w, v),
r AS (SELECT z.doc_id, z.source, z.size, CAST(t.source_size AS BIGINT) AS source_size, t.target, t.u, z.size * 400 > t.target AS large
  FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, row_number() OVER (PARTITION BY source, large ORDER BY size, md5(concat_ws(':', CAST(doc_id AS VARCHAR), '7')), doc_id) AS k,
  CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM r),
f AS (SELECT *, CASE WHEN large THEN floor(k * rate + u) - floor((k - 1) * rate + u) END AS first_copies FROM k),
b AS (SELECT source, coalesce(sum(first_copies * size), 0) AS took, coalesce(sum(size) FILTER (WHERE large), 0) AS of_large FROM f GROUP BY source),
c AS (SELECT f.*, CASE WHEN source_size > of_large THEN least(3.0::DOUBLE, greatest(0.0::DOUBLE, (target - took) / (source_size - of_large))) ELSE 0.0 END AS rest
  FROM f JOIN b ON f.source IS NOT DISTINCT FROM b.source),
n AS (SELECT *, CAST(CASE WHEN large THEN first_copies ELSE floor(k * rest + u) - floor((k - 1) * rest + u) END AS BIGINT) AS copies FROM c)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies, source FROM n
"""


@_query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


ORACLE["op12_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT + 5 * coalesce(any_value(v.v), 0) AS total
  FROM g LEFT JOIN c USING (lang, source) LEFT JOIN v ON v.lang = g.lang GROUP BY g.lang, g.source),
p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // s.total AS BIGINT) AS p
  FROM s JOIN k ON k.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
l AS (SELECT lang, sum(n)::HUGEINT AS n, any_value(v) AS v FROM c JOIN v USING (lang) GROUP BY lang),
q AS (SELECT c.lang, c.term, CAST(1 + (1000000000::HUGEINT * (sum(c.n) + 5)) // (any_value(l.n) + 5 * any_value(l.v)) AS BIGINT) AS q
  FROM c JOIN l USING (lang) GROUP BY c.lang, c.term),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN k ON k.lang = a.lang
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source AND x.term = k.term
  LEFT JOIN p y ON y.lang = a.lang AND y.source = b.source AND y.term = k.term GROUP BY a.lang, a.source, b.source
  UNION ALL SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM f)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""


@_query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


ORACLE["op11_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
o AS (SELECT lang, 1 AS k, w[i] AS x FROM i
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM i WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM i WHERE i + 2 <= len(w)),
f AS (SELECT lang, k, x, count(*) AS a FROM o GROUP BY lang, k, x HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (SELECT lang, k, x, a, string_split(x, ' ') AS w FROM f WHERE k > 1),
u AS (SELECT lang, k, x, a, w, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT u.lang, u.k, u.x, u.a, u.cut, l.a AS l, r.a AS r,
  CAST((1000000::HUGEINT * u.a * u.a) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM u JOIN f l ON l.lang = u.lang AND l.k = u.cut AND l.x = array_to_string(u.w[1:u.cut], ' ')
  JOIN f r ON r.lang = u.lang AND r.k = u.k - u.cut AND r.x = array_to_string(u.w[u.cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, cut) = 1),
g AS (SELECT lang, array_to_string(w[1:2], ' ') AS x, a FROM c WHERE k = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3),
h AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.lang = b.lang AND g.x = b.x AND b.k = 2 AND 100 * g.a >= 50 * b.a))
SELECT lang, rank, x AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM (
  SELECT h.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, x) AS rank FROM h) JOIN n USING (lang) WHERE rank <= 2000
"""
