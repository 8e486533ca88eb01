"""One query per operator over the driver's tables, each thin: it applies the operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarnflow.llm import balltree, language, merkle, negatives, packing, permutation, pii, simhash, sitetree, suffix, urls, weighted, wordbpe
from tarnflow.llm.common import table


def op1_permutation(spark: SparkSession, folder: str) -> DataFrame:
    return permutation.nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, k=10)


def op2_balltree(spark: SparkSession, folder: str) -> DataFrame:
    found = balltree.top_k(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20, factor=64)
    return found.withColumn("score", F.col("score").cast("bigint"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), distance=2, words=3)


#: Verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def op4_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages"), URL_RULES)


def op5_sitetree(spark: SparkSession, folder: str) -> DataFrame:
    return sitetree.extract(table(spark, folder, "pages"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = language.predict(docs, train_on=~held)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_suffix(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.dedup(table(spark, folder, "documents"), length=100)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.digest(pii.find(docs, pii.fit(docs)))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return wordbpe.digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("id") % 50 == 0, factor=256)


def op12_weighted(spark: SparkSession, folder: str) -> DataFrame:
    return weighted.edited(table(spark, folder, "documents"))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.documents_manifest(docs, {"n_chars": F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})


QUERIES = {
    "op1_permutation": op1_permutation,
    "op2_balltree": op2_balltree,
    "op3_simhash": op3_simhash,
    "op4_urls": op4_urls,
    "op5_sitetree": op5_sitetree,
    "op6_language": op6_language,
    "op7_suffix": op7_suffix,
    "op8_packing": op8_packing,
    "op9_pii": op9_pii,
    "op10_bpe": op10_bpe,
    "op11_negatives": op11_negatives,
    "op12_weighted": op12_weighted,
    "op13_merkle": op13_merkle,
}

#: CRC-32 of a string's bytes, bit by bit (0xEDB88320 is the fixed polynomial).
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda v, unused: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295::BIGINT)"""

_MERKLE = f"""
WITH RECURSIVE told AS (
    SELECT doc_id, lang,
        concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
            coalesce(strlen(lang) || ':' || lang, '-')) AS head,
        coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n,
        CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 7 = 0 THEN coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-')
            ELSE coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') END AS n_other,
        coalesce(strlen(text) || ':' || text, '-') AS body
    FROM documents),
leaves AS (SELECT doc_id, lang, sha256(head || n || body) AS leaf, sha256(head || n_other || body) AS other FROM told),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
tree(lang, level, nodes) AS (
    SELECT lang, 0, list(leaf ORDER BY pos) FROM placed GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda k: sha256(nodes[2 * k + 1] || coalesce(nodes[2 * k + 2], '')))
    FROM tree WHERE len(nodes) > 1),
runs AS (SELECT lang, nodes[1] AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS run_at FROM tree WHERE len(nodes) = 1),
upper_tree(level, nodes) AS (
    SELECT 0, list(subroot ORDER BY run_at) FROM runs
    UNION ALL
    SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda k: sha256(nodes[2 * k + 1] || coalesce(nodes[2 * k + 2], '')))
    FROM upper_tree WHERE len(nodes) > 1),
steps AS (
    SELECT p.doc_id, p.leaf, t.level, (p.pos >> t.level) & 1 AS odd, t.nodes[xor(p.pos >> t.level, 1) + 1] AS sibling
    FROM placed p JOIN tree t ON p.lang IS NOT DISTINCT FROM t.lang AND len(t.nodes) > 1
    UNION ALL
    SELECT p.doc_id, p.leaf, r.height + u.level, (r.run_at >> u.level) & 1, u.nodes[xor(r.run_at >> u.level, 1) + 1]
    FROM placed p JOIN runs r ON p.lang IS NOT DISTINCT FROM r.lang JOIN upper_tree u ON len(u.nodes) > 1),
witness AS (SELECT doc_id, leaf, list({{'odd': odd, 'sibling': coalesce(sibling, '')}} ORDER BY level) AS steps FROM steps GROUP BY doc_id, leaf),
climb(doc_id, leaf, k, node) AS (
    SELECT doc_id, leaf, 0, other FROM placed
    UNION ALL
    SELECT c.doc_id, c.leaf, k + 1, sha256(CASE WHEN w.steps[k + 1].odd = 1 THEN w.steps[k + 1].sibling || node ELSE node || w.steps[k + 1].sibling END)
    FROM climb c JOIN witness w ON c.doc_id = w.doc_id AND c.leaf = w.leaf WHERE k < len(w.steps)),
root AS (SELECT nodes[1] AS root FROM upper_tree WHERE len(nodes) = 1)
SELECT p.doc_id, p.leaf, r.subroot, root.root, sha256(array_to_string(list_transform(w.steps, lambda s: s.sibling), '')) AS proof_sha256,
    c.node AS folded_root, c.node = root.root AS verified
FROM placed p JOIN runs r ON p.lang IS NOT DISTINCT FROM r.lang JOIN witness w ON p.doc_id = w.doc_id AND p.leaf = w.leaf
    JOIN climb c ON p.doc_id = c.doc_id AND p.leaf = c.leaf AND c.k = len(w.steps) CROSS JOIN root
"""

#: The others are no plain SQL; tests/llm holds them against brute force, round trips or held-out accuracy.
ORACLE: dict[str, str] = {"op13_merkle": _MERKLE}
