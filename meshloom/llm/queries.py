"""The queries of the text operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, license_scan, mixing, quality_rules, secret_scan, simhash, spelling, substring_dedup, suffix_tree, token_counts, toxicity, vector_codes
from .common import is_remainder, table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), ["doc_id"])


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), is_remainder(F.col("doc_id"), 4, 2))


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"), is_remainder(F.col("doc_id"), 5, 1))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(table(spark, sf_dir, "documents"), ["doc_id"])


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"])


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"])


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), keep=["doc_id"]))
    return tokens.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.quantise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    of_labels = codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    out = codes.join(of_labels, F.col("label").eqNullSafe(F.col("__label")))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_suffix_tree": op3_suffix_tree,
    "op4_mixing": op4_mixing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_simhash": op7_simhash,
    "op8_quality_rules": op8_quality_rules,
    "op9_license_scan": op9_license_scan,
    "op10_secret_scan": op10_secret_scan,
    "op11_bpe": op11_bpe,
    "op12_vector_codes": op12_vector_codes,
    "op13_spelling": op13_spelling,
}

OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, 2.0::DOUBLE * source_size AS cap
  FROM totals
), ordered AS (
  SELECT *, cap / weight AS ratio,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heft,
    sum(source_size) OVER () AS words
  FROM weighed
), level AS (
  SELECT coalesce(min_by((1.5::DOUBLE * words - capped) / heft, ratio), 0) AS level FROM ordered WHERE (1.5::DOUBLE * words - capped) / heft <= ratio
), targets AS (
  SELECT source, source_size, least(cap, weight * level) AS target, CASE WHEN source_size > 0 THEN least(cap, weight * level) / source_size ELSE 0 END AS rate
  FROM weighed, level
), taken AS (
  SELECT doc_id, size, source_size, target,
    (floor(rate) + CASE WHEN ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM taken
"""



def op12_sql(rounds: int = 4) -> str:
    """Lloyd's rounds written out: books, and what is nearest in them, by turns. All numbers are whole and exact in doubles."""
    parts = """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), parts AS MATERIALIZED (
  SELECT row, vec_id, position, v[position * len(v) // 4 + 1 : (position + 1) * len(v) // 4] AS part FROM kept, (SELECT unnest(range(4)) AS position)
), book0 AS MATERIALIZED (
  SELECT position, row_number() OVER (PARTITION BY position ORDER BY vec_id) - 1 AS entry, part FROM parts QUALIFY entry < 256
)"""
    near = """, near{k} AS MATERIALIZED (
  SELECT row, position, least.entry AS entry, least.d AS d FROM (
    SELECT row, p.position, min(struct_pack(d := list_inner_product(p.part, p.part) - 2 * list_inner_product(p.part, b.part) + list_inner_product(b.part, b.part), entry := b.entry)) AS least
    FROM parts p JOIN book{k} b ON p.position = b.position GROUP BY row, p.position)
)"""
    book = """, mean{k} AS MATERIALIZED (
  SELECT position, entry, list(x ORDER BY spot) AS part FROM (
    SELECT position, entry, spot, floor(sum(x) / count(*)) AS x
    FROM (SELECT n.position, n.entry, unnest(p.part) AS x, unnest(range(len(p.part))) AS spot FROM near{j} n JOIN parts p ON n.row = p.row AND n.position = p.position) GROUP BY position, entry, spot)
  GROUP BY position, entry
), book{k} AS MATERIALIZED (
  SELECT position, entry, coalesce(m.part, b.part) AS part FROM book{j} b LEFT JOIN mean{k} m USING (position, entry)
)"""
    steps = "".join(near.format(k=k - 1) + book.format(j=k - 1, k=k) for k in range(1, rounds + 1)) + near.format(k=rounds)
    return f"""WITH {parts}{steps}, coded AS (
  SELECT row, string_agg(printf('%02x', entry), '' ORDER BY position) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY row
), digest AS (
  SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY position, entry, spot)) AS codebooks_sha256 FROM (SELECT position, entry, unnest(part) AS x, unnest(range(len(part))) AS spot FROM book{rounds})
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN kept USING (row), digest"""


ORACLE_SQL: dict[str, str] = {"op4_mixing": OP4_SQL, "op12_vector_codes": op12_sql()}
