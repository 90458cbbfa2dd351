"""From raw documents to packed batches of training text.

Each stage takes the documents that the one before it kept, all whole, and gives
documents of the same columns; the last gives the plan of the batches. Every
stage is written and read again, so a lost executor costs a part of one stage.
Documents without text or without an id pass through; see each operator for its
rules on nulls, repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, packing, pseudonyms, recompression, signature_tree, toxicity
from corpusmill.runtime import materialize
from corpusmill.sources.tables import load_table

#: The toxicity model, the trees and the recompression are not expressible in SQL;
#: tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None

KEY_SETTING = "spark.corpusmill.pseudonyms.key"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones among them, does not reject."""
    labels = load_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.keep_clean(docs, toxicity.fit_flags(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document, that with the least id.

    Documents are told apart by id and text, so those that share an id, or have
    none, stand each for itself; without any id in a group, or with several texts
    of its least id, one of these texts stays. Rows that repeat an id (or its
    lack) with the same text count as one.
    """
    rows = materialize(signature_tree.surplus_rows(docs), "surplus")
    gone = rows.filter("surplus").select(F.col("doc_id").alias("gone_id"), "mark").distinct()
    again = rows.groupBy("doc_id", "mark").count().filter("count > 1")
    same_id = docs["doc_id"].cast("bigint").eqNullSafe(gone["gone_id"])
    same_text = signature_tree.text_mark(docs["text"]) == gone["mark"]
    kept = docs.join(gone, same_id & same_text, "left_anti")
    return kept if again.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones hold; what loses all its words goes."""
    left = recompression.remove_repeats(docs)
    left = left.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return _as_documents(left, docs)


def hide_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal data.

    The secret key is the session's setting `KEY_SETTING`. Without it the public
    example key is taken, whose pseudonyms anyone can undo: for trials only.
    """
    key = spark.conf.get(KEY_SETTING, pseudonyms.EXAMPLE_KEY)
    return _as_documents(pseudonyms.pseudonymise(docs, key), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document, by its tokens."""
    return packing.pack_texts(docs, bpe.broadcast_vocabulary(spark))


def _as_documents(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, with `n_chars` counted anew."""
    size = F.length("text").cast("bigint").alias("n_chars")
    return changed.select(*[size if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeated_passages", cut_repeats),
    ("personal_data", hide_persons),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
