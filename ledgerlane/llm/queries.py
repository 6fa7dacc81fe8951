"""The registered queries of the corpus operators and, where SQL can say it, their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.centroids import cluster_vectors
from ledgerlane.llm.chosen_path import minhash_components
from ledgerlane.llm.collocations import collocations
from ledgerlane.llm.decontaminate import contamination, hit_words
from ledgerlane.llm.line_dedup import line_dedup
from ledgerlane.llm.packing import pack
from ledgerlane.llm.quality_rules import judged
from ledgerlane.llm.sharding import shard_rows
from ledgerlane.llm.simhash import simhash_components
from ledgerlane.llm.substring_dedup import substring_dedup
from ledgerlane.llm.toxicity import toxicity
from ledgerlane.llm.url_filter import filter_urls
from ledgerlane.llm.warc import round_trip
from ledgerlane.sources.tables import table

QUERIES = {}
ORACLE = {}

# White space and letter case as DuckDB text.
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_line_dedup", f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT doc_id, i, line, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM l),
bad AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(bad.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE bad.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN bad ON k.key = bad.key GROUP BY doc_id""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_WORD10 = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@register("op10_decontaminate", f"""
WITH b AS (SELECT item_id, {_WORD10} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, unnest([array_to_string(w[s:s + least(10, len(w)) - 1], ' ')
         FOR s IN range(1, len(w) - least(10, len(w)) + 2)]) AS win FROM b WHERE len(w) > 0),
d AS (SELECT doc_id, {_WORD10} AS w FROM documents),
dw AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS s,
         unnest([array_to_string(w[s:s + m - 1], ' ') FOR s IN range(1, len(w) - m + 2)]) AS win
       FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m),
hit AS (SELECT DISTINCT doc_id, s, dw.m, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.m = iw.m),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
         sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS x FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(x, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = hit_words().cast("long")
    return out.select(F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("marks") > 0).alias("contaminated"))


#: Fixed values of the contract.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/")]


@register("op8_url_filter", f"""
WITH p AS (SELECT page_id, url, strpos(url, '://') AS i FROM pages),
q AS (SELECT page_id, CASE WHEN i > 0 THEN {_LOWER.format("regexp_extract(substr(url, i + 3), '^([^/?#]*)', 1)")} ELSE '' END AS host,
        CASE WHEN i > 0 THEN regexp_extract(substr(url, i + 3), '^[^/?#]*(/[^?#]*)', 1) ELSE '' END AS path FROM p),
r(verdict, rule) AS (VALUES {', '.join(f"('{v}', '{r}')" for v, r in URL_RULES)}),
s AS (SELECT verdict, rule, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS pre FROM r),
m AS (SELECT page_id, host, path, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST, length(h) DESC) AS k
      FROM q LEFT JOIN s ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


@register("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("row.text", F.lit("")).cast("binary")
    return out.select("row.doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@register("op6_warc", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h, max(page_id) OVER (PARTITION BY sha1(b)) AS top FROM p),
x AS (SELECT *, CAST(unhex(h) AS BIT)::VARCHAR AS bits FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(bits[5*i+1] AS INT) + 8 * CAST(bits[5*i+2] AS INT)
    + 4 * CAST(bits[5*i+3] AS INT) + 2 * CAST(bits[5*i+4] AS INT) + CAST(bits[5*i+5] AS INT), 1) FOR i IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM x""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = round_trip(table(spark, sf_dir, "pages"))
    return out.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


@register("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


@register("op4_substring_dedup", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(0, len(w) - 19)) AS s,
          unnest([md5(array_to_string(w[i + 1:i + 20], ' ')) FOR i IN range(0, len(w) - 19)]) AS h FROM d WHERE len(w) >= 20),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM later)),
x AS (SELECT doc_id, unnest(range(0, len(w))) AS p, unnest(w) AS word FROM d WHERE len(w) > 0),
k AS (SELECT x.doc_id, count(gone.p) AS n_removed,
        sha256(coalesce(string_agg(word, ' ' ORDER BY x.p) FILTER (WHERE gone.p IS NULL), '')) AS sha
      FROM x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.p = x.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(sha, sha256('')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@register("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@register("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")


_ROUND = """
d{i} AS MATERIALIZED (SELECT v.row, c.cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN c{i} c ON v.j = c.j GROUP BY v.row, c.cluster),
a{i} AS MATERIALIZED (SELECT row, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM d{i} GROUP BY row)"""
_MOVE = """,
m{i} AS (SELECT a.cluster, v.j, CAST(floor_div(sum(v.x), count(*)) AS BIGINT) AS x FROM a{i} a JOIN v ON v.row = a.row GROUP BY a.cluster, v.j),
c{next} AS MATERIALIZED (SELECT c.cluster, c.j, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.cluster = c.cluster AND m.j = c.j)"""


def _clusters_sql(rounds: int = 5, k: int = 40) -> str:
    # The floor of a quotient of integers: a truncated one, less one where it was cut upward.
    floor = "(sum(v.x) // count(*)) - CASE WHEN sum(v.x) % count(*) < 0 THEN 1 ELSE 0 END"
    steps = ",".join(_ROUND.format(i=i) + (_MOVE.format(i=i, next=i + 1).replace("floor_div(sum(v.x), count(*))", floor) if i < rounds else "") for i in range(rounds + 1))
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vec FROM embeddings
  WHERE len(embedding) = 64 AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
v AS MATERIALIZED (SELECT row, unnest(vec) AS x, unnest(range(64)) AS j FROM kept),
s AS (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), vec) - 1 AS cluster, vec FROM kept),
c0 AS MATERIALIZED (SELECT cluster, unnest(vec) AS x, unnest(range(64)) AS j FROM s WHERE cluster < {k}),{steps},
h AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} a JOIN kept USING (row) JOIN h ON h.cluster = a.cluster"""


@register("op13_centroid_clustering", _clusters_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cluster_vectors(table(spark, sf_dir, "embeddings"))
    digits = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", F.sha2(digits, 256).alias("centroid_sha256"))


@register("op12_collocations", f"""
WITH w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
      FROM w, (VALUES (1), (2), (3), (4), (5)) s(m) WHERE len(w) >= m),
f AS MATERIALIZED (SELECT lang, phrase, m, count(*) AS a FROM g GROUP BY lang, phrase, m HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.a, t.n, k.k, l.a AS l, r.a AS r, (CAST(1000 AS HUGEINT) * k.a * t.n) // (CAST(l.a AS HUGEINT) * r.a) AS score
      FROM k JOIN t ON t.lang = k.lang JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:k.k], ' ')
      JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS q FROM s) WHERE q = 1),
x AS (SELECT DISTINCT b.lang, b.phrase FROM b JOIN c ON c.lang = b.lang AND c.m > len(string_split(b.phrase, ' ')) AND 100 * c.a >= 100 * b.a
      AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b ANTI JOIN x USING (lang, phrase)) WHERE rank <= 2000""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@register("op11_minhash")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash_components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
