"""The stages of the training-data pipeline, one operator of this subpackage each.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
docs, in their order, whatever their names. An empty table passes through every stage as an empty
one. What a stage does with nulls, long texts, ties and repeated rows stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import bpe, langid, mixing, simhash, substring
from gridloom.llm.common import read, remove_tables, small_batches, tables_so_far, written

#: Columns that operators see; all others travel in one struct, so that no name of theirs clashes.
SEEN = ["doc_id", "text", "lang", "source"]


def _packed(docs: DataFrame) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in SEEN]
    return docs.select(*SEEN, *([F.struct(*rest).alias("rest")] if rest else []))


def _unpacked(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs again, in their order."""
    return found.select(*(c if c in SEEN else F.col(f"rest.`{c}`").alias(c) for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models reject go; a missing lang becomes the predicted one.

    Null and empty texts and those without a letter are rejected. A long text is judged as a whole,
    by its mean. Repeated rows go or stay together; equal cross-entropies give the language that
    comes first by name. Without any labelled text all are rejected.
    """
    small_batches(spark)
    found = langid.identify(_packed(docs), langid.learn(docs)).where(~F.col("rejected"))
    return _unpacked(found.withColumn("lang", F.coalesce("lang", "lang_pred")), docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the document with the smallest doc_id stays.

    Texts without a word and rows without doc_id stay, whatever they are like. Rows that repeat a
    doc_id go or stay together: all of them go if one is a near copy of a document with a smaller
    doc_id. A long text counts with all its shingles.
    """
    small_batches(spark)
    gone = simhash.near_copies(docs).where("doc_id != component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(written(gone, "gone"), F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 20 that stand earlier in the corpus go from text; n_chars follows.

    Null and empty texts stay as they are. Of equal windows in one document the first stays. Rows
    that repeat a doc_id are one document as to order, and a row without one loses nothing. A long
    text is treated whole; a document may lose all its words and stays with an empty text.
    """
    small_batches(spark)
    found = _unpacked(substring.dedup_text(_packed(docs)), docs)
    return found.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else found


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mixture of domains, languages and sources takes, each once.

    Null and empty texts cost nothing; a null language or source is a leaf of its own; rows alike in
    doc_id, text and leaf are taken or left together; a long text is taken whole or not at all.
    """
    return _unpacked(mixing.mix(_packed(docs), mixing.PIPELINE_TARGETS), docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and the digest of the decoded text, for every row of docs: null texts count as empty, long ones are encoded whole."""
    small_batches(spark)
    return bpe.encode_decode(docs.select(*SEEN), outputs=("ids", "decoded_sha256"))


STAGES = [("language_id", language_id), ("simhash_dedup", simhash_dedup), ("substring_dedup", substring_dedup), ("mixture", mixture), ("bpe", bpe_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents, each written to the shared folder and read again; tables that a stage needed for itself go once it is written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = tables_so_far()
        docs = written(stage(spark, docs, sf_dir), name)
        remove_tables(spark, before, keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
