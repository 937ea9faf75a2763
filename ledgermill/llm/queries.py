"""Registered queries of this subpackage and the DuckDB SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import (
    ann,
    audit,
    centroids,
    chat,
    exact,
    mixing,
    packing,
    pii,
    quality,
    simhash,
    suffix,
    toxicity,
    warc,
)
from ledgermill.llm.common import numbered_scan, prepared, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """The byte-level vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of every hundredth vector."""
    return ann.nearest(table(prepared(spark), sf_dir, "embeddings"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(prepared(spark), sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    prepared(spark)
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    prepared(spark)
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, read back from the archives they were written to."""
    found = warc.archived(table(prepared(spark), sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data of every document."""
    return pii.personal_data(table(prepared(spark), sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mixture(table(prepared(spark), sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired and rendered turns of every conversation."""
    return chat.formatted(table(prepared(spark), sf_dir, "conversations"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every token piece in the packed sequences."""
    return packing.packed(table(prepared(spark), sf_dir, "documents"), tokenizer_path())


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact.exact_duplicates(table(prepared(spark), sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five quality filters remove in every order, per language."""
    prepared(spark)
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages that occur earlier."""
    docs = numbered_scan(table(prepared(spark), sf_dir, "documents"), "row_no")
    found = suffix.without_repeats(docs, row_column="row_no")
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"]
    )
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds."""
    return centroids.clustered(table(prepared(spark), sf_dir, "embeddings"))


EXACT_SQL = r"""
WITH flat AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS flat
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY flat) AS keep_id,
       count(*) OVER (PARTITION BY flat) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY flat) AS kept,
       sha256(flat) AS text_sha256
FROM flat
"""


# DuckDB has no base 32: the digest's bits are read in groups of five.
WARC_SQL = r"""
WITH records AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS digest
  FROM pages
), coded AS (
  SELECT page_id, octet_length(payload) AS payload_bytes,
         CAST(CAST(unhex(digest) AS BIT) AS VARCHAR) AS bits,
         min(page_id) OVER (PARTITION BY payload) AS first_page
  FROM records
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT)
           + 4 * CAST(bits[5 * i + 3] AS INT) + 2 * CAST(bits[5 * i + 4] AS INT)
           + CAST(bits[5 * i + 5] AS INT) AS INT), 1)
         FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to
FROM coded
"""


AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), masked AS (
  SELECT doc_id, part,
         (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t)
                  THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
  FROM texts
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good,
         coalesce(sum(toxic), 0) AS toxic
  FROM masked LEFT JOIN marks USING (doc_id) GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), played AS (
  SELECT *, substr(filter_order, step, 1) AS own,
         len(list_intersect(string_split(fails, ''),
                            string_split(substr(filter_order, 1, step - 1), ''))) > 0
           AND step > 1 AND fails <> '' AS gone
  FROM cells, orders, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)
), summed AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT gone AND NOT contains(fails, own) THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND contains(fails, own) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND contains(fails, own) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND contains(fails, own) THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND contains(fails, own) THEN toxic ELSE 0 END) AS toxic_lost
  FROM played GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""

# Bytes as pairs of hexadecimal digits: window p is 200 digits from digit 2 p + 1 on.
SUFFIX_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT r, doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) AS k
  FROM (SELECT *, unnest(range(0, greatest(0, length(h) // 2 - 99))) AS p FROM texts)
), again AS (
  SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before
  FROM (SELECT r, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, r, p) AS n FROM windows)
  WHERE n > 1
), runs AS (
  SELECT r, p, sum(CASE WHEN p - before <= 100 THEN 0 ELSE 1 END)
               OVER (PARTITION BY r ORDER BY p) AS run
  FROM again
), spans AS (
  SELECT r, min(p) AS s, max(p) + 100 AS e FROM runs GROUP BY r, run
), pieces AS (
  SELECT r, e AS low, lead(s) OVER (PARTITION BY r ORDER BY e) AS high
  FROM (SELECT r, 0 AS s, 0 AS e FROM texts UNION ALL SELECT r, s, e FROM spans)
), rest AS (
  SELECT r, string_agg(substr(h, 2 * low + 1, 2 * (coalesce(high, length(h) // 2) - low)), ''
                       ORDER BY low) AS kept
  FROM pieces JOIN texts USING (r) GROUP BY r
)
SELECT doc_id, length(h) // 2 AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept)) AS kept_sha256
FROM texts JOIN rest USING (r)
LEFT JOIN (SELECT r, sum(e - s) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
USING (r)
"""

# One round: nearest centroid of every vector, then the floor of the mean per cluster.
# SQL's division of whole numbers cuts towards zero, so the remainder is taken off first.
_ROUND_SQL = """
near_{i} AS (
  SELECT row_no, min(struct_pack(
           d := list_sum(list_transform(range(1, 65), lambda k: (v[k] - p[k]) * (v[k] - p[k]))),
           c := c)) AS m
  FROM kept, centroids_{i} GROUP BY row_no
), sums_{i} AS (
  SELECT c, k, sum(x) AS s, count(*) AS n
  FROM (SELECT m.c AS c, unnest(range(1, 65)) AS k, unnest(v) AS x
        FROM near_{i} JOIN kept USING (row_no))
  GROUP BY c, k
), means_{i} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS p
  FROM sums_{i} GROUP BY c
), centroids_{j} AS (
  SELECT c, coalesce(means_{i}.p, centroids_{i}.p) AS p
  FROM centroids_{i} LEFT JOIN means_{i} USING (c)
), """

CENTROIDS_SQL = (
    """
WITH kept AS (
  SELECT vec_id, row_number() OVER () AS row_no,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), centroids_0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS INT) AS c, v AS p
  FROM kept QUALIFY c < 16
), """
    + "".join(_ROUND_SQL.format(i=i, j=i + 1) for i in range(3))
    + """
near_3 AS (
  SELECT row_no, min(struct_pack(
           d := list_sum(list_transform(range(1, 65), lambda k: (v[k] - p[k]) * (v[k] - p[k]))),
           c := c)) AS m
  FROM kept, centroids_3 GROUP BY row_no
)
SELECT vec_id, near_3.m.c AS cluster, CAST(near_3.m.d AS BIGINT) AS distance,
       CAST(sum(near_3.m.d) OVER (PARTITION BY near_3.m.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(near_3.m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(centroids_3.p, ',')) AS centroid_sha256
FROM near_3 JOIN kept USING (row_no) JOIN centroids_3 ON near_3.m.c = centroids_3.c
"""
)


def queries() -> dict[str, Query]:
    return {
        "op1_ann": op1_ann,
        "op2_simhash": op2_simhash,
        "op3_toxicity": op3_toxicity,
        "op4_quality": op4_quality,
        "op5_warc": op5_warc,
        "op6_pii": op6_pii,
        "op7_mixing": op7_mixing,
        "op8_chat": op8_chat,
        "op9_packing": op9_packing,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_filter_audit": op11_filter_audit,
        "op12_suffix": op12_suffix,
        "op13_centroids": op13_centroids,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_warc": WARC_SQL,
        "op10_exact_dedup": EXACT_SQL,
        "op11_filter_audit": AUDIT_SQL,
        "op12_suffix": SUFFIX_SQL,
        "op13_centroids": CENTROIDS_SQL,
    }
