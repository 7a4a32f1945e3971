"""The operators as queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.llm import (
    alignment,
    decontaminate,
    licenses,
    lines,
    near_duplicates,
    packing,
    quality,
    sharding,
    spelling,
    tokens,
    toxicity,
    urls,
    vector_graph,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def public_tokenizer(name: str) -> str:
    """A tokenizer's file; every executor needs it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_tokenizer() -> str:
    return public_tokenizer("word_bpe_49k.json")


def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf, "documents"))


def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.length_histogram(table(spark, sf, "documents"), word_tokenizer(), ["lang"])


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every contaminated document with its items and its longest overlap."""
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf, "documents"), 8)
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its text after the removal of repeated lines."""
    deduped = lines.dedup_lines(table(spark, sf, "documents"))
    return deduped.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_removed", "text")


def op6_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf, "pages"))


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), word_tokenizer())


def op8_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    """Every license found in a document, with its coverage and place."""
    return licenses.scan_licenses(table(spark, sf, "documents"))


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf, "documents"))


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf, "labels")))


def op11_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align_tokenizers(
        table(spark, sf, "documents"),
        public_tokenizer("byte_bpe_50k.json"),
        public_tokenizer("piece_bpe_32k.model"),
    )


def op12_spelling_groups(spark: SparkSession, sf: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf, "documents"), slip=spelling.SLIP)
    return spelling.spelling_groups(words)


def op13_vector_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return vector_graph.link_vectors(table(spark, sf, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_token_counts": op2_token_counts,
    "op3_decontamination": op3_decontamination,
    "op4_sharding": op4_sharding,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filters": op6_url_filters,
    "op7_packing": op7_packing,
    "op8_license_scans": op8_license_scans,
    "op9_quality_rules": op9_quality_rules,
    "op10_toxicity": op10_toxicity,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_vector_dedup": op13_vector_dedup,
}

ORACLE: dict[str, str] = {
    "op9_quality_rules": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        w AS (
            SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
                list_filter(string_split(text, chr(10)),
                    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM t
        ),
        tri AS (
            SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)
        ),
        twice AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        rep AS (
            SELECT doc_id, count(DISTINCT i + d) AS n FROM twice, (VALUES (0), (1), (2)) AS v(d)
            GROUP BY doc_id
        ),
        m AS (
            SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
                coalesce(rep.n, 0) AS n_repeat_words,
                length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS n_upper,
                length(text) - length(replace(text, '!', '')) AS n_exclaims
            FROM w LEFT JOIN rep USING (doc_id)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 2 * n_words
                OR word_chars > 15 * n_words OR 2 * word_chars < 3 * n_words
                OR 10 * n_dup_lines > 7 * n_lines OR 10 * n_upper > 5 * word_chars
                OR 10 * n_exclaims > 3 * n_words) AS kept
        FROM m
    """,
    "op13_vector_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93
        ),
        reached AS (
            SELECT a, b FROM links
            UNION
            SELECT r.a, l.b FROM reached AS r JOIN links AS l ON r.b = l.a
        ),
        least AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links,
            least(vec_id, coalesce(least.b, vec_id)) AS component_id,
            vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
        FROM embeddings
        LEFT JOIN counted ON counted.a = vec_id LEFT JOIN least ON least.a = vec_id
    """,
}
