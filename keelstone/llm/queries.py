"""The operators over the given tables, with production parameters, and their comparison SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keelstone.llm import (
    embeddings,
    exact_dedup,
    fingerprints,
    html_text,
    licenses,
    mixing,
    packing,
    pii,
    quality,
    secrets,
    simhash,
    source_audit,
    whitening,
)
from keelstone.llm.common import read


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for secrets in every document, and which of them are."""
    return secrets.scan(read(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprint(read(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and decision for every document, trained on those labelled as good."""
    documents, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality.classify(documents, labels).drop("key")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the weighted mix of all sources takes."""
    return mixing.mix(read(spark, sf_dir, "documents")).drop("key")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find(read(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(read(spark, sf_dir, "pages"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of every document."""
    return licenses.label(read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near-duplicates of every document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into windows of 1024 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), *vocabulary())


def vocabulary() -> tuple[str, str]:
    """The tokenizer's file and the same vocabulary as ranks."""
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of near-duplicates of every embedding."""
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and which terms set them apart."""
    return source_audit.audit(read(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the documents with equal text stays, for every document."""
    return exact_dedup.classify(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading whitened components of every embedding."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets,
        op2_fingerprints,
        op3_quality,
        op4_mixing,
        op5_pii,
        op6_html_text,
        op7_licenses,
        op8_simhash,
        op9_packing,
        op10_embeddings,
        op11_source_audit,
        op12_exact_dedup,
        op13_whitening,
    )
}
SQL: dict[str, str] = {
    "op11_source_audit": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS id, coalesce(text, '') AS text,
                   coalesce(lang, '') AS lang, coalesce(source, '') AS source
            FROM documents
        ),
        words AS (
            SELECT id, lang, source, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM docs
        ),
        kept AS (
            SELECT lang, term, count(*) AS total FROM words
            GROUP BY lang, term HAVING count(DISTINCT id) >= 3
        ),
        langs AS (SELECT lang, count(*) AS terms, sum(total) AS words FROM kept GROUP BY lang),
        counts AS (
            SELECT lang, source, term, count(*) AS n
            FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
        ),
        sources AS (
            SELECT lang, source, coalesce(own.words, 0) AS words, coalesce(langs.terms, 0) AS terms
            FROM (SELECT DISTINCT lang, source FROM docs)
            LEFT JOIN (SELECT lang, source, sum(n) AS words FROM counts GROUP BY lang, source) own
                USING (lang, source)
            LEFT JOIN langs USING (lang)
        ),
        chances AS (
            SELECT s.lang, s.source, k.term, c.n,
                   (1 + 1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT // (s.words + s.terms))::BIGINT AS p,
                   (1 + 1000000000 * (k.total + 1)::HUGEINT // (l.words + l.terms))::BIGINT AS q
            FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang)
            LEFT JOIN counts c USING (lang, source, term)
        ),
        sums AS (
            SELECT a.lang, a.source, b.source AS item,
                   sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
            FROM chances a JOIN chances b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source
        ),
        parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0) AS value
            FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM chances WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value, row_number() OVER (
            PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
        FROM parts
        QUALIFY part = 'pair' OR rank <= 200
    """,
    "op12_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents
        )
        WINDOW w AS (PARTITION BY norm)
    """,
}
