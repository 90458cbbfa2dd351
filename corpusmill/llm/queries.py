"""Queries of the training-data operators over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import (
    bpe, conversation_trie, main_text, multiset_hash, neighbours, packing, pseudonyms, quality, recompression, signature_tree,
    toxicity, url_filter, whitening,
)
from corpusmill.sources.tables import load_table

URL_RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _register(query):
    _QUERIES[query.__name__] = query
    return query


@_register
def op1_pseudonyms(spark, folder):
    documents = load_table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(documents, pseudonyms.EXAMPLE_KEY)


@_register
def op2_url_filter(spark, folder):
    pages = load_table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.filter_urls(pages, url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@_register
def op3_neighbours(spark, folder):
    vectors = load_table(spark, folder, "embeddings").select("vec_id", "embedding")
    queries = vectors.filter(F.pmod("vec_id", F.lit(50)) == 0)
    return neighbours.nearest(neighbours.build_index(vectors), queries, k=5)


@_register
def op4_multiset_hash(spark, folder):
    return multiset_hash.fingerprint_edits(load_table(spark, folder, "documents"))


@_register
def op5_bpe(spark, folder):
    documents = load_table(spark, folder, "documents")
    return bpe.token_digests(documents, bpe.broadcast_vocabulary(spark))


@_register
def op6_recompression(spark, folder):
    documents = load_table(spark, folder, "documents").select("doc_id", "text")
    left = recompression.remove_repeats(documents, joined=True)
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return left.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


@_register
def op7_toxicity(spark, folder):
    documents = load_table(spark, folder, "documents")
    labels = load_table(spark, folder, "labels").select("doc_id", "toxic")
    return toxicity.score(documents, toxicity.fit_flags(documents, labels))


def held_out(key) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@_register
def op8_quality(spark, folder):
    documents = load_table(spark, folder, "documents")
    labels = load_table(spark, folder, "labels").select("doc_id", "quality")
    model = quality.fit(documents, labels.filter(~held_out(F.col("doc_id"))), "quality")
    scored = quality.score(documents, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_register
def op9_signature_tree(spark, folder):
    return signature_tree.jaccard_groups(load_table(spark, folder, "documents"))


@_register
def op10_packing(spark, folder):
    return packing.pack_texts(load_table(spark, folder, "documents"), bpe.broadcast_vocabulary(spark))


@_register
def op11_main_text(spark, folder):
    return main_text.extract(load_table(spark, folder, "pages").select("page_id", "url", "html"))


@_register
def op12_conversation_trie(spark, folder):
    return conversation_trie.prefix_trie(load_table(spark, folder, "conversations"))


@_register
def op13_whitening(spark, folder):
    return whitening.whiten(load_table(spark, folder, "embeddings"))


@_register
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)


_ORACLES = {
    "op2_url_filter": r"""
        WITH parts AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
            FROM pages),
        rules(h, p, action) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                   ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        fits AS (
            SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule,
                   arg_max(action, length(h || p)) AS action
            FROM parts LEFT JOIN rules
              ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
            GROUP BY ALL)
        SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM fits
    """,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
