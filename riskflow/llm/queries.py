"""The operators applied to the whole tables, each with the parameters of a production run."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import decontam, licenses, linedup, ngramjoin, planes, pseudonyms, raking, repeats, rules, subvectors, turns, viterbi, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: A production run takes its key from a secret store; this one makes the query repeatable.
PSEUDONYM_KEY = "example-key"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.encode_documents(_documents(spark, sf_dir), TOKENIZER, end_id=2)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(_documents(spark, sf_dir))
    return rows.select(
        "doc_id", *rules.MEASURES[:5], (~rules.passes("base")).alias("base_failed"), rules.passes().alias("kept"), "failed")


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raking.sample(_documents(spark, sf_dir), power=0.5, budget=0.5)
    return rows.select(F.col("row.doc_id").alias("doc_id"), "source", "language", "topic", "n_tokens", "probability", "sampled")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.token_counts(_documents(spark, sf_dir), VOCABULARY)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.remove_lines(_documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "kept_sha256")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonym_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(_documents(spark, sf_dir), PSEUDONYM_KEY)


def near_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_groups(_documents(spark, sf_dir), size=4, percent=85)


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_documents(spark, sf_dir), size=50).select("doc_id", "n_words", "n_removed", "kept_sha256")


def capture_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no capture times: pages were captured in the order of their ids, one each second."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = warc.archive_pages(pages, F.timestamp_seconds(F.pmod(F.col("page_id"), F.lit(1 << 31))))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def repaired_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subvectors.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=16, rounds=3, seed="1", dims=64, scale=64)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_planes": token_ids,
        "op2_raked_mixture": mixture,
        "op3_quality_rules": quality_rules,
        "op4_viterbi_counts": token_counts,
        "op5_near_groups": near_groups,
        "op6_line_dedup": line_dedup,
        "op7_license_scan": license_scan,
        "op8_repeated_passages": repeated_passages,
        "op9_benchmark_leaks": benchmark_leaks,
        "op10_pseudonyms": pseudonym_texts,
        "op11_capture_histories": capture_histories,
        "op12_repaired_turns": repaired_turns,
        "op13_centroid_clusters": centroid_clusters,
    }


#: The rules of op3 in SQL; words, lines and windows are compared as text.
QUALITY_SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM texts),
starts AS (SELECT doc_id, unnest(generate_series(1, len(w) - 7)) AS i, w FROM words WHERE len(w) >= 8),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win FROM starts),
twice AS (SELECT doc_id, win FROM wins GROUP BY doc_id, win HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 7)) AS k FROM wins JOIN twice USING (doc_id, win)),
again AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
full_lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
  coalesce(again.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines,
  len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]')))::BIGINT AS n_letter_words,
  length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::BIGINT AS n_letters, length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper
  FROM words LEFT JOIN full_lines ON words.doc_id = full_lines.doc_id LEFT JOIN again ON words.doc_id = again.doc_id),
f AS (SELECT *, ((n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
  + 4 * (10 * word_chars < 20 * n_words OR 10 * word_chars > 150 * n_words)::BIGINT + 8 * (100 * n_symbols > 10 * n_words)::BIGINT
  + 16 * (100 * n_dup_lines > 50 * n_lines)::BIGINT + 32 * (100 * n_letter_words < 70 * n_words)::BIGINT
  + 64 * (100 * n_upper > 60 * n_letters)::BIGINT)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""



def _centroid_sql(k: int = 16, rounds: int = 3) -> str:
    """The rounds of op13 one after another: every vector against every centroid, then sums by component."""
    steps = [f"""
q AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256(concat('1:', vec_id)), q) - 1 AS c, q AS m FROM q QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""
d{i} AS (SELECT r, vec_id, q, c, list_sum(list_transform(list_zip(q, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM q, c{i}),
a{i} AS (SELECT r, vec_id, q, c, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if i < rounds:
            steps.append(f"""
s{i} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT c, unnest(q) AS x, unnest(generate_series(1, 64)) AS i FROM a{i}) GROUP BY c, i),
m{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM s{i} GROUP BY c),
c{i + 1} AS (SELECT c{i}.c, coalesce(m{i}.m, c{i}.m) AS m FROM c{i} LEFT JOIN m{i} ON c{i}.c = m{i}.c)""")
    return f"""
WITH {",".join(steps)}
SELECT vec_id, a{rounds}.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a{rounds}.c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON a{rounds}.c = c{rounds}.c"""


CAPTURE_SQL = """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
n AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
  row_number() OVER (PARTITION BY sha256(payload) ORDER BY page_id NULLS LAST, url NULLS LAST) AS k,
  first_value(page_id) OVER (PARTITION BY sha256(payload) ORDER BY page_id NULLS LAST, url NULLS LAST) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN k = 1 OR payload_bytes < 100 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 AND payload_bytes >= 100 THEN first END AS refers_to FROM n
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": QUALITY_SQL, "op11_capture_histories": CAPTURE_SQL, "op13_centroid_clusters": _centroid_sql()}
