"""One query for each operator over the tables of a directory, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherecube.llm import decontaminate, hard_negatives, html_text, license_scan, near_dup, packing, quality_model, quality_rules, secrets, substring_dedup
from spherecube.llm import token_alignment, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(func):
        QUERIES[name] = func
        if sql is not None:
            ORACLES[name] = sql
        return func

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATE_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM dw JOIN bw USING (n, s)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEAR_DUP_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 2) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ways AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM both_ways JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(reach.b) AS component_id, d.doc_id = min(reach.b) AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n
"""


@query("op2_benchmark_decontamination", DECONTAMINATE_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    leak = F.col("_leak")
    return decontaminate.annotate(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", leak["n_words"].alias("n_words"), leak["n_hit"].alias("n_hit"), leak["n_items"].alias("n_items"),
        F.sha2(F.array_join(leak["item_ids"], ","), 256).alias("items_sha256"), (leak["n_hit"] > 0).alias("contaminated"),
    )


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = F.col("_stats")
    return quality_rules.assess(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", *[s[c].alias(c) for c in quality_rules.BASE], F.col("_base_failed").alias("base_failed"),
        F.col("_rule").alias("rule"), F.col("_kept").alias("kept"),
    )


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


@query("op8_minhash_near_dedup", NEAR_DUP_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@query("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""


@query("op6_warc_capture_index", WARC_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


@query("op9_html_extraction")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


NEGATIVES_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER w::INTEGER AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) QUALIFY row_number() OVER w <= 10
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _secrets_sql() -> str:
    base = ((secrets.ASSIGN, 2, 12), (secrets.ACCESS, 0, 18), (secrets.HEX, 0, 16))
    matches = " UNION ALL ".join(
        f"SELECT k, {rank} AS rank, unnest(range(1, len(h) + 1)) AS i, h, g, n FROM (SELECT k, regexp_extract_all(t, {_sql_text(p)}) AS h, "
        f"string_split_regex(t, {_sql_text(p)}) AS g, regexp_extract_all(t, {_sql_text(p)}, {group}) AS n FROM d)"
        for rank, (p, group, _) in enumerate([*base, (secrets.CANDIDATE, 0, 0)])
    )
    least = "[" + ", ".join(str(n) for _, _, n in base) + ", 0]"
    allowed = " AND ".join(f"NOT regexp_matches(hit, {_sql_text(p)})" for p in secrets.ALLOWED)
    kinds = ", ".join(_sql_text(k) for k in (*secrets.BASE, *(c.kind for c in secrets.CLASSES)))
    costs, total = [], 0
    for step in secrets.STEPS:
        costs.append(total := total + step)
    more = " UNION ALL ".join(
        f"SELECT k, {len(secrets.BASE) + n} AS rank, s, e FROM c JOIN least_cost USING (k, s) WHERE cost <= {secrets.limit_of(c.bits)} AND "
        + " AND ".join(f"regexp_matches(hit, {_sql_text(p)})" for p in c.needs)
        for n, c in enumerate(secrets.CLASSES)
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT k, rank, list_sum(list_transform(g[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: len(x))), 0) AS s, h[i] AS hit
  FROM ({matches}) WHERE len(n[i]) >= {least}[rank + 1]
), spans AS (SELECT k, rank, s::BIGINT AS s, (s + len(hit))::BIGINT AS e, hit FROM m),
base AS (SELECT * FROM spans WHERE rank < 3),
c AS (SELECT * FROM spans x WHERE rank = 3 AND {allowed} AND NOT EXISTS (SELECT 1 FROM base b WHERE b.k = x.k AND b.s < x.e AND b.e > x.s)),
letters AS (
  SELECT k, s, i, hit[j] AS letter, count(*) AS n
  FROM (SELECT k, s, hit, i, unnest(range(i, i + {secrets.WINDOW})) AS j FROM (SELECT k, s, hit, unnest(range(1, len(hit) - {secrets.WINDOW} + 2)) AS i FROM c)) GROUP BY ALL
), costs AS (SELECT k, s, i, sum({costs}[n]) AS cost FROM letters GROUP BY ALL),
least_cost AS (SELECT k, s, min(cost) AS cost FROM costs GROUP BY ALL),
every AS (SELECT k, rank, s, e FROM base UNION ALL {more}),
told AS (SELECT *, [{kinds}][rank + 1] || ':' || s || ':' || e AS x FROM every)
SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
  sha256(coalesce(string_agg(x, ',' ORDER BY s, rank) FILTER (rank < 3), '')) AS base_sha256, coalesce(string_agg(x, ',' ORDER BY s, rank), '') AS spans
FROM d LEFT JOIN told USING (k) GROUP BY k, doc_id
"""


@query("op12_secret_scan", _secrets_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["rank"] < len(secrets.BASE))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, secrets.BASE), F.sha2(secrets.written(base), 256).alias("base_sha256"), secrets.written(F.col("secrets")).alias("spans"),
    )


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = token_alignment.aligned_and_scored(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), with_groups=False)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
