"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import shared_folder, table, with_package
from martflow.llm.decontaminate import find_leaks
from martflow.llm.fill_in_middle import fill_in_middle, with_digests
from martflow.llm.hard_negatives import mine_hard_negatives
from martflow.llm.language_model import score_texts
from martflow.llm.lsh_forest import near_dedup
from martflow.llm.near_duplicates import near_duplicates
from martflow.llm.packing import pack_documents
from martflow.llm.repeats import find_repeats
from martflow.llm.rules import quality_rules
from martflow.llm.sharding import shard_documents, uniform_tree, with_shard
from martflow.llm.token_counts import token_totals
from martflow.llm.toxicity import score_toxicity, train
from martflow.llm.urls import judge_urls

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the production runs.
SHARD_TREE = uniform_tree(regions=3, racks=2, shards=4)
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
#: The ids of this file and of the tokenizers library's byte_bpe_50k.json are the same (tests/llm/test_tokens.py).
PACKING_VOCABULARY = "byte_bpe_50k.tiktoken"
COUNTED_VOCABULARIES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")


def vocabulary(name: str) -> tuple[bytes, str]:
    """A public tokenizer's file and its pattern; both have a fixed size."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes(), public_tokenizers.PATTERN


def op1_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of a weighted hash tree, and in 25."""
    return shard_documents(table(spark, sf_dir, "documents"), SHARD_TREE, with_shard(SHARD_TREE))


def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), *vocabulary(PACKING_VOCABULARY))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages judged by the url rules."""
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and links of all documents at a similarity of 0.8 of five-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row", "class_row")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans", "items")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of all documents by source, language and tokenizer version."""
    found = {name: vocabulary(name) for name in COUNTED_VOCABULARIES}
    return token_totals(
        table(spark, sf_dir, "documents"),
        f"{shared_folder(spark)}/token-ledger-{uuid.uuid4().hex}",
        {name.removesuffix(".tiktoken"): ranks for name, (ranks, _) in found.items()},
        found[COUNTED_VOCABULARIES[0]][1],
    )


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated strings of 400 bytes."""
    return find_repeats(table(spark, sf_dir, "documents")).drop("row", "kept_text")


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents."""
    return score_texts(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule figures and verdicts of all documents."""
    return quality_rules(table(spark, sf_dir, "documents")).drop("text_hash", "host", "removed")


def op11_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a similarity of 0.85 of three-word shingles."""
    return near_dedup(table(spark, sf_dir, "documents")).drop("row", "component_row")


def op12_skip_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in fill-in-the-middle form, as digests."""
    return with_digests(fill_in_middle(table(spark, sf_dir, "documents")))


def op13_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; the labels of every seventh are moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return mine_hard_negatives(vectors, F.col("vec_id") % 50 == 0)


OP3_SQL = r"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL
), sized AS (
  SELECT *, least(10, len(words)) AS n FROM items WHERE len(words) > 0
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM sized)
), texts AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), doc_windows AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM texts, (SELECT DISTINCT n FROM sized) WHERE len(words) >= n)
), hits AS (
  SELECT d.doc_id, d.i, d.n, t.item_id FROM doc_windows d JOIN item_windows t ON d.n = t.n AND d.w = t.w
), hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids
  FROM hits GROUP BY doc_id
)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, coalesce(w.n_hit, 0)::BIGINT AS n_hit,
       coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(w.n_hit, 0) > 0 AS contaminated
FROM texts t LEFT JOIN hit_words w ON t.doc_id = w.doc_id LEFT JOIN hit_items i ON t.doc_id = i.doc_id
"""

OP5_SQL = r"""
WITH parts AS (
  SELECT page_id, row_number() OVER () AS row,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), hosts AS (
  SELECT row, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts
), urls AS (
  SELECT row, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts
), rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), best AS (
  SELECT u.row, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
         max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.row
)
SELECT u.page_id, u.host, u.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN best b ON u.row = b.row
"""

OP11_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS words
  FROM documents
), placed AS (
  SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(len(words))) AS i FROM texts
), runs AS (
  SELECT doc_id, n, i, word, lead(word, 1) OVER w AS second, lead(word, 2) OVER w AS third
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), shingles AS (
  SELECT DISTINCT doc_id, concat_ws(' ', word, second, third) AS shingle FROM runs WHERE third IS NOT NULL OR (n < 3 AND i = 0)
), sets AS (
  SELECT t.doc_id, count(s.shingle) AS size FROM texts t LEFT JOIN shingles s ON t.doc_id = s.doc_id GROUP BY t.doc_id
), links AS (
  SELECT p.a, p.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
        FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN sets s ON s.doc_id = p.a JOIN sets t ON t.doc_id = p.b
  WHERE 100 * shared >= 85 * (s.size + t.size - shared)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), found AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT s.doc_id, s.size AS n_shingles, f.component_id, s.doc_id = f.component_id AS kept
FROM sets s JOIN found f ON s.doc_id = f.doc_id
"""

OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS digest,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
  FROM documents
), drawn AS (
  SELECT *, len(lines) AS n, ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
         ('0x' || substr(digest, 25, 8))::BIGINT AS h4
  FROM texts
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle,
         array_to_string(lines[b + 1:], '') AS suffix
  FROM cut
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

OP13_SQL = r"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS vec_id, a.label = v.label AS same,
         list_sum(list_transform(list_zip(a.c, v.c), lambda x: x[1] * x[2]))::BIGINT AS score
  FROM vectors a JOIN vectors v ON a.vec_id <> v.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s USING (anchor_id)
WHERE NOT s.same AND 100 * s.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
QUALIFY rank <= 3
"""

QUERIES: dict[str, Query] = {
    query.__name__: with_package(query)
    for query in (
        op1_hash_tree,
        op2_near_duplicates,
        op3_decontaminate,
        op4_best_fit,
        op5_url_rules,
        op6_token_counts,
        op7_repeats,
        op8_language_model,
        op9_toxicity,
        op10_quality_rules,
        op11_lsh_forest,
        op12_skip_list,
        op13_four_russians,
    )
}

#: The large tables of queries that read others than documents.
INPUTS: dict[str, tuple[str, ...]] = {"op5_url_rules": ("pages",), "op13_four_russians": ("embeddings",)}

ORACLE: dict[str, str] = {
    "op3_decontaminate": OP3_SQL,
    "op5_url_rules": OP5_SQL,
    "op11_lsh_forest": OP11_SQL,
    "op12_skip_list": OP12_SQL,
    "op13_four_russians": OP13_SQL,
}
