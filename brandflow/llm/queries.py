"""One query for each operator, over its whole table, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_ppm, license_scan, mixing, near_fss, oph, page_text, pii, piece_backtrack, positional_index, token_alignment, toxicity, url_reputation, vp_clusters
from .scratch import written
from .shipping import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree source/lang/number; one that begins with a licence holds for its directory."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")
    found = license_scan.licences(files, license_scan.fit_matcher(files), licence_file=F.col("line") == 0)
    return found.withColumnRenamed("file_id", "doc_id")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_fss.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_ppm.fit_language_model(docs)
    rows = docs.select("doc_id", "text", language_ppm.held_out(F.col("doc_id")).alias("held_out"))
    return language_ppm.identify_languages(rows, model)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the document that its path ends in: bad if of low quality or toxic."""
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    bad = labels.groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    named = F.regexp_extract("path", r"/([0-9]{1,18})(?:[.]html)?/?$", 1)
    outcomes = url_reputation.with_parts(pages.select("url")).select("url", F.when(named != "", named).cast("long").alias("doc_id")).join(bad, "doc_id")
    return url_reputation.judged_urls(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oph.edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    rows = docs.withColumn("held_out", language_ppm.held_out(F.col("doc_id")))
    return toxicity.score_toxicity(rows, model).withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs, pii.fit_span_model(docs))


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.balanced(docs).select("doc_id", "size", "source_size", "target", "taken")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = token_alignment.aligned_tokens(docs, token_alignment.vocabularies(spark, a, b))
    digest = F.when(F.col("n_groups") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256")
    # both uses, the counts and the documents, read what is written here: texts are tokenized once
    aligned = written(aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "pair_links"), "aligned")
    scored = token_alignment.link_scores(aligned, token_alignment.pair_counts(aligned))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_vector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_clusters.clustered_vectors(spark, table(spark, sf_dir, "embeddings"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
    texts = piece_backtrack.decode_pieces(piece_backtrack.encode_pieces(docs, model).drop("text"), model)
    return texts.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_fingerprints": op2_fingerprints,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_licenses": op5_licenses,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_language": op7_language,
    "op8_personal_data": op8_personal_data,
    "op9_page_text": op9_page_text,
    "op10_mixing": op10_mixing,
    "op11_token_alignment": op11_token_alignment,
    "op12_vector_clusters": op12_vector_clusters,
    "op13_pieces": op13_pieces,
}


def _cluster_sql(k: int = 40, rounds: int = 5, dimensions: int = 64, scale: int = 256) -> str:
    """Every distance of every round; sums of components are long, one row a vector and component."""
    ctes = [
        f"v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x"
        f" FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions})",
        "c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM"
        f" (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h, x LIMIT {k}))",
    ]
    for n in range(rounds + 1):
        ctes.append(
            f"a{n} AS (SELECT r, vec_id, v.x, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), c := c)) AS m"
            f" FROM v, c{n} c GROUP BY r, vec_id, v.x)"
        )
        if n < rounds:
            ctes.append(
                f"s{n} AS (SELECT m.c AS c, i, sum(x[i]) AS s, count(*) AS n FROM a{n}, range(1, {dimensions + 1}) t(i) GROUP BY m.c, i)"
            )
            ctes.append(
                f"c{n + 1} AS (SELECT c.c, coalesce(g.x, c.x) AS x FROM c{n} c LEFT JOIN (SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{n} GROUP BY c) g ON g.c = c.c)"
            )
    return (
        "WITH "
        + ",\n".join(ctes)
        + f"\nSELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,"
        f" CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(f.x, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} f ON f.c = m.c"
    )

ORACLE_SQL: dict[str, str] = {
    "op12_vector_clusters": _cluster_sql(),
    "op1_url_filter": r"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), u AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), h AS (
  SELECT *, CASE WHEN ip OR host = suffix OR own = '' THEN host ELSE own END AS domain FROM (
    SELECT *, CASE WHEN ip THEN host ELSE regexp_extract(host, '(?:^|[.])({SUFFIX}|[^.]*)$', 1) END AS suffix,
           regexp_extract(host, '([^.]+[.](?:{SUFFIX}|[^.]+))$', 1) AS own FROM (
      SELECT *, regexp_matches(host, '^([0-9]{1,3}([.][0-9]{1,3}){3}(:[0-9]*)?|\[.*)$') AS ip,
             TRY_CAST(regexp_extract(path, '/([0-9]{1,18})(?:[.]html)?/?$', 1) AS BIGINT) AS doc_id FROM u))
), lab AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
), hosts AS (
  SELECT suffix, domain, host, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad FROM h JOIN lab USING (doc_id) GROUP BY ALL
), top AS (
  SELECT coalesce(sum(bad), 0) + 1.0 AS a, coalesce(sum(n), 0) - coalesce(sum(bad), 0) + 1.0 AS b FROM hosts
), suffix_c AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix
), suffix_m AS (
  SELECT c.suffix, c.n, c.bad, p.a / (p.a + p.b) AS mean FROM suffix_c c JOIN top p ON true
), suffix_s AS (
  SELECT CASE WHEN count(*) > 0 AND sum(n) > count(*) AND sum(pow(bad / n - mean, 2) * n / (mean * (1 - mean))) > count(*)
    THEN least(10000.0, greatest(2.0, (sum(n) - count(*)) / (sum(pow(bad / n - mean, 2) * n / (mean * (1 - mean))) - count(*)) - 1)) ELSE 10000.0 END AS k
  FROM suffix_m
), suffix_p AS (
  SELECT suffix, bad + mean * k AS a, n - bad + (1 - mean) * k AS b FROM suffix_m, suffix_s
), domain_c AS (
  SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix, domain
), domain_m AS (
  SELECT c.suffix, c.domain, c.n, c.bad, p.a / (p.a + p.b) AS mean FROM domain_c c JOIN suffix_p p ON c.suffix = p.suffix
), domain_s AS (
  SELECT CASE WHEN count(*) > 0 AND sum(n) > count(*) AND sum(pow(bad / n - mean, 2) * n / (mean * (1 - mean))) > count(*)
    THEN least(10000.0, greatest(2.0, (sum(n) - count(*)) / (sum(pow(bad / n - mean, 2) * n / (mean * (1 - mean))) - count(*)) - 1)) ELSE 10000.0 END AS k
  FROM domain_m
), domain_p AS (
  SELECT suffix, domain, bad + mean * k AS a, n - bad + (1 - mean) * k AS b FROM domain_m, domain_s
), host_c AS (
  SELECT suffix, domain, host, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix, domain, host
), host_m AS (
  SELECT c.suffix, c.domain, c.host, c.n, c.bad, p.a / (p.a + p.b) AS mean FROM host_c c JOIN domain_p p ON c.suffix = p.suffix AND c.domain = p.domain
), host_s AS (
  SELECT CASE WHEN count(*) > 0 AND sum(n) > count(*) AND sum(pow(bad / n - mean, 2) * n / (mean * (1 - mean))) > count(*)
    THEN least(10000.0, greatest(2.0, (sum(n) - count(*)) / (sum(pow(bad / n - mean, 2) * n / (mean * (1 - mean))) - count(*)) - 1)) ELSE 10000.0 END AS k
  FROM host_m
), host_p AS (
  SELECT suffix, domain, host, bad + mean * k AS a, n - bad + (1 - mean) * k AS b FROM host_m, host_s
), post AS (
  SELECT h.page_id, h.host, h.path, coalesce(x.a, d.a, s.a, t.a) AS a, coalesce(x.b, d.b, s.b, t.b) AS b
  FROM h CROSS JOIN top t LEFT JOIN suffix_p s ON s.suffix = h.suffix LEFT JOIN domain_p d ON d.suffix = h.suffix AND d.domain = h.domain
  LEFT JOIN host_p x ON x.suffix = h.suffix AND x.domain = h.domain AND x.host = h.host
), rules(what, rh, rp) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT DISTINCT page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(what, length(rh || rp)) AS what
  FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id, host, path
)
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.what, CASE WHEN a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM post p LEFT JOIN fits f ON p.page_id IS NOT DISTINCT FROM f.page_id AND p.host = f.host AND p.path = f.path
""".replace("{SUFFIX}", "|".join(x.replace(".", "[.]") for x in url_reputation.SUFFIXES)),
    # words are compared window by window, without an index
    "op4_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), iw AS (
  SELECT item_id, least(10, len(w)) AS n, list_slice(w, s + 1, s + least(10, len(w))) AS win
  FROM (SELECT item_id, w, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS s FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, s, n, list_slice(w, s + 1, s + n) AS win
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT dw.doc_id, dw.s, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
""",
}
