"""The registered queries of the operators and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import conversation_trie, merkle, mixing, outliers, pii, secret_scan, sql, toxicity
from skyledger.llm.bpe import encode_documents
from skyledger.llm.common import read, stored
from skyledger.llm.exact_dedup import exact_groups
from skyledger.llm.language_model import language_model_scores
from skyledger.llm.near_dedup import near_duplicates
from skyledger.llm.ngram_join import similar_documents
from skyledger.llm.passages import remove_repeated_passages


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    fold = toxicity.remainder("_id")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn=fold != 0)
    scored = toxicity.with_score(docs, model, "score")
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.remainder("doc_id") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judged(read(spark, sf_dir, "documents"))


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_passages(read(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    taken = (F.col("first") + F.col("second")).alias("taken")
    return mixed.select("doc_id", "source", "size", "source_size", "target", taken)


def _with_spans(found: DataFrame, module) -> DataFrame:
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *(pii.count_of(spans, kind).alias(f"n_{kind}") for kind in module.BASE),
        F.sha2(pii.told(pii.base_only(spans, module.BASE)), 256).alias("base_sha256"),
        pii.told(spans).alias("spans"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_spans(pii.personal_data(read(spark, sf_dir, "documents")), pii)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_spans(secret_scan.secrets(read(spark, sf_dir, "documents")), secret_scan)


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(
        read(spark, sf_dir, "documents"), toxicity.remainder("doc_id") == 1
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(read(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lowered = F.translate("text", sql.UPPER, sql.LOWER)
    changed = merkle.leaf_digest(*(lowered if c == "text" else F.col(c) for c in merkle.FIELDS))
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    made = merkle.manifest(docs, carry={"tampered": F.when(chosen, changed)})
    leaf, siblings = merkle.told(F.col("h")), F.col("siblings")
    start = F.coalesce(merkle.told(F.col("tampered")), leaf)
    root = F.lit(made.root).cast("string")
    return merkle.proofs(made).select(
        "doc_id",
        leaf.alias("leaf"),
        merkle.told(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        F.sha2(merkle.told(siblings), 256).alias("proof_sha256"),
        merkle.folded(start, siblings, F.col("places"), F.col("runs")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(conversation_trie.turns_of(read(spark, sf_dir, "conversations")), "turns")
    conv_id = F.col("conv_id")
    base = turns.filter(conv_id % 100 == 0).select(
        conv_id.alias("_base"), F.slice("turns", 1, 5).alias("_first")
    )
    h = (F.crc32(conv_id.cast("string")) % 6).cast("int")
    met = turns.join(base, conv_id - conv_id % 100 == F.col("_base"), "left")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    first = F.coalesce(F.slice("_first", F.lit(1), h), F.array().cast("array<binary>"))
    return conversation_trie.trie(met.select("conv_id", F.concat(first, own).alias("turns")))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_outliers": op2_outliers,
    "op3_passages": op3_passages,
    "op4_mixing": op4_mixing,
    "op5_pii": op5_pii,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_secrets": op8_secrets,
    "op9_language_model": op9_language_model,
    "op10_bpe": op10_bpe,
    "op11_merkle": op11_merkle,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_ngram_join": op13_ngram_join,
}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLE = {
    "op3_passages": rf"""
WITH docs AS MATERIALIZED (SELECT doc_id, {_WORDS} AS words FROM documents),
starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM docs WHERE len(words) >= 13),
windows AS MATERIALIZED (
  SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS gram FROM starts),
firsts AS (SELECT gram, min(doc_id) AS first_id FROM windows GROUP BY gram),
gone AS (
  SELECT doc_id, list(DISTINCT q) AS places FROM (
    SELECT w.doc_id, unnest(range(w.p, w.p + 13)) AS q
    FROM windows w JOIN firsts f ON w.gram = f.gram WHERE f.first_id < w.doc_id)
  GROUP BY doc_id),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS q FROM docs),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY q) AS kept_text
  FROM placed p
  LEFT JOIN (SELECT doc_id, unnest(places) AS q FROM gone) g USING (doc_id, q)
  WHERE g.doc_id IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(len(g.places), 0) AS n_removed,
  sha256(coalesce(k.kept_text, '')) AS kept_sha256
FROM docs d LEFT JOIN gone g USING (doc_id) LEFT JOIN kept k USING (doc_id)""",
    "op6_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, h AS text_sha256
FROM n WINDOW g AS (PARTITION BY h)""",
    "op11_merkle": sql.MERKLE,
    "op12_conversation_trie": sql.TRIE,
    "op13_ngram_join": sql.joined(4, 85, ""),
}
