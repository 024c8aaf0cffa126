"""Registered queries of the document operators and the SQL of those that have one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierframe.llm import (
    byte_bpe,
    decontaminate,
    hard_negatives,
    host_reputation,
    language,
    line_chunks,
    mixing,
    ngram_join,
    personal_data,
    quality,
    simhash,
    token_count,
    whitening,
)

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edits_and_neighbours(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.passages(_table(spark, sf_dir, "documents")).select(
        "doc.doc_id",
        "n_lines",
        "removed_lines",
        F.length("kept").cast("long").alias("kept_chars"),
        F.md5("kept").alias("kept_md5"),
    )


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    # a null id is never held out
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.learn(docs.filter(~held))
    return language.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    # the first number in a page's path is the document it shows
    _, path = host_reputation.host_and_path(F.col("url"))
    number = F.regexp_extract(path, "[0-9]+", 0).try_cast("long")
    shown = pages.select("url", number.alias("doc_id"))
    labels = _table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("good"))
    return host_reputation.judge(pages, shown.join(labels, "doc_id").select("url", "good"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return personal_data.detect(docs, personal_data.train(docs))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES)
    )


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTES))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # noise of the contract: every seventh label is off by one
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(
        _table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label
    )


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), columns=["doc_id"]
    )
    n_hit = decontaminate.n_hit(F.col("spans"))
    return found.select(
        "doc.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_simhash": op2_simhash,
    "op3_line_dedup": op3_line_dedup,
    "op4_source_mix": op4_source_mix,
    "op5_language": op5_language,
    "op6_quality": op6_quality,
    "op7_url_reputation": op7_url_reputation,
    "op8_personal_data": op8_personal_data,
    "op9_token_counts": op9_token_counts,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_decontaminate": op12_decontaminate,
    "op13_whitening": op13_whitening,
}

ORACLES = {
    "op3_line_dedup": """
WITH l AS (
    SELECT doc_id, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text) AS k,
           unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS n
    FROM documents WHERE text IS NOT NULL
), h AS (
    SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h,
           count(*) OVER (PARTITION BY k) AS n_lines
    FROM l
), e AS (
    SELECT *, CASE WHEN n = n_lines OR (h + 31 * coalesce(lag(h) OVER w, 0)) % 2 = 0
                   THEN 1 ELSE 0 END AS is_end
    FROM h WINDOW w AS (PARTITION BY k ORDER BY n)
), c AS (
    SELECT *, coalesce(sum(is_end) OVER (PARTITION BY k ORDER BY n
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
    FROM e
), chunk AS (
    SELECT doc_id, k, place, any_value(n_lines) AS n_lines, count(*) AS size,
           string_agg(line, chr(10) ORDER BY n) AS body
    FROM c GROUP BY doc_id, k, place
), judged AS (
    SELECT *, size >= 2 AND row_number() OVER (
                  PARTITION BY body, size >= 2 ORDER BY doc_id, k, place) > 1 AS gone
    FROM chunk
), kept AS (
    SELECT doc_id, k, CAST(any_value(n_lines) AS BIGINT) AS n_lines,
           CAST(coalesce(sum(size) FILTER (gone), 0) AS BIGINT) AS removed_lines,
           coalesce(string_agg(body, chr(10) ORDER BY place) FILTER (NOT gone), '') AS kept
    FROM judged GROUP BY doc_id, k
)
SELECT doc_id, n_lines, removed_lines, length(kept) AS kept_chars, md5(kept) AS kept_md5 FROM kept
UNION ALL
SELECT doc_id, 0, 0, NULL, NULL FROM documents WHERE text IS NULL
""",
    "op7_url_reputation": """
WITH u AS (
    SELECT page_id, coalesce(contains(url, '://'), false) AS ok,
           substr(url, instr(url, '://') + 3) AS rest
    FROM pages
), p AS (
    SELECT page_id,
           CASE WHEN ok THEN translate(regexp_extract(rest, '^[^/?#]*', 0),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
           CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM u
), seen AS (
    SELECT host, count(*) AS n, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS g
    FROM p JOIN labels l ON l.doc_id = try_cast(regexp_extract(path, '[0-9]+', 0) AS BIGINT)
    WHERE quality IS NOT NULL GROUP BY host
), c AS (
    SELECT h.host, regexp_extract(h.host, '[^.]*[.]?[^.]*$', 0) AS domain,
           regexp_extract(h.host, '[^.]*$', 0) AS suffix,
           coalesce(n, 0)::DOUBLE AS n, coalesce(g, 0)::DOUBLE AS g
    FROM (SELECT DISTINCT host FROM p) h LEFT JOIN seen USING (host)
), d AS (SELECT suffix, domain, sum(n) AS n, sum(g) AS g FROM c GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(g) AS g FROM d GROUP BY ALL),
s1 AS (SELECT *, (SELECT (sum(g) + 1) / (sum(n) + 2) FROM s) AS m FROM s),
ks AS (
    SELECT 1 / least(greatest(coalesce((sum(n * (g / n - m) ** 2) - sum(m * (1 - m)))
               / nullif(sum((n - 1) * m * (1 - m)), 0), 0), 0.001), 0.25) - 1 AS k
    FROM s1 WHERE n > 0
), d1 AS (
    SELECT d.*, (s1.g + k * m) / (s1.n + k) AS m FROM d JOIN s1 USING (suffix), ks
), kd AS (
    SELECT 1 / least(greatest(coalesce((sum(n * (g / n - m) ** 2) - sum(m * (1 - m)))
               / nullif(sum((n - 1) * m * (1 - m)), 0), 0), 0.001), 0.25) - 1 AS k
    FROM d1 WHERE n > 0
), c1 AS (
    SELECT c.*, (d1.g + k * m) / (d1.n + k) AS m FROM c JOIN d1 USING (suffix, domain), kd
), kc AS (
    SELECT 1 / least(greatest(coalesce((sum(n * (g / n - m) ** 2) - sum(m * (1 - m)))
               / nullif(sum((n - 1) * m * (1 - m)), 0), 0), 0.001), 0.25) - 1 AS k
    FROM c1 WHERE n > 0
), post AS (
    SELECT host, n, g + k * m AS a, n - g + k * (1 - m) AS b FROM c1, kc
), r AS (
    SELECT host, CAST(n AS BIGINT) AS n_labelled,
           a / (a + b) + 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS upper_bound
    FROM post
), j AS (
    SELECT p.*, r.n_labelled, r.upper_bound,
           CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/')
                    THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/')
                    THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
           END AS rule
    FROM p JOIN r USING (host)
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN upper_bound < 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       n_labelled
FROM j
""",
    "op4_source_mix": r"""
WITH d AS (
    SELECT doc_id, source,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS k
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, 2.0::DOUBLE * source_size AS lim,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
    FROM s
), l AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(lim) OVER (
                  ORDER BY lim / weight, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
    FROM w
), t AS (
    SELECT source, source_size, least(lim, max(lev) OVER () * weight) AS target FROM l
), r AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 1 END AS epochs,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), x AS (
    SELECT *, target - epochs * source_size AS rest FROM r
)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN rest > 0 AND ahead + size / 2 <= rest THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM x
""",
    "op11_hard_negatives": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER w AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
""",
    "op12_decontaminate": r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), b AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM benchmark
), iw AS (
    SELECT item, least(len(w), 10) AS k,
           unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
               lambda i: array_to_string(w[i : i + least(len(w), 10) - 1], ' '))) AS gram
    FROM b WHERE len(w) > 0
), dw AS (
    SELECT r, k, unnest(range(1, len(w) - k + 2)) AS i,
           unnest(list_transform(range(1, len(w) - k + 2),
               lambda i: array_to_string(w[i : i + k - 1], ' '))) AS gram
    FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k
), hit AS (
    SELECT r, dw.i, dw.k, iw.item FROM dw JOIN iw ON dw.k = iw.k AND dw.gram = iw.gram
), words AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hit)) GROUP BY r
), found AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN found USING (r)
""",
}
