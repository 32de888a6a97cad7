"""The dealt operators as queries over their whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lotforge.llm.alignment import align_documents, public_paths
from lotforge.llm.audit import audit
from lotforge.llm.bytecnn import languages
from lotforge.llm.common import read, ship
from lotforge.llm.dartminhash import near_duplicates
from lotforge.llm.deepshallow import without_repeats
from lotforge.llm.hilbert import document_shards
from lotforge.llm.licences import licences
from lotforge.llm.lineblocks import extract
from lotforge.llm.lingroup import pack, word_vocabulary
from lotforge.llm.pivots import near_vectors
from lotforge.llm.prefixchat import digests, expand
from lotforge.llm.sql import ORACLE
from lotforge.llm.vafile import top_k
from lotforge.llm.waterfill import mixture

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(read(spark, sf_dir, "pages"))


def op2_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards along a Hilbert curve, by the law of rows."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return document_shards(docs, 40)


def op3_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 rows with the highest integer inner product for every hundredth vec_id."""
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op4_waterfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixture(docs, weights=(5, 2, 1), share=(3, 2), epochs=2, seed=0).drop("times")


def op5_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that strings of 200 bytes cover which also start elsewhere."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).drop("kept")


def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under weighted shingle similarity of 0.8 or more."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, 0.8).drop("t1", "t2")


def op7_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every vector to vectors of its label with cosine 0.93 or more."""
    return near_vectors(read(spark, sf_dir, "embeddings"), 0.93)


def op8_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return languages(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op9_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, word_vocabulary(), 4096, end=1)


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own or inherited licence of every document, filed as source/.../ by its doc_id.

    A directory holds the documents of a hundred ids; the one that ends in 00 is its licence file,
    and one that ends in 0000 is that of the directory above."""
    docs = read(spark, sf_dir, "documents")
    number = F.abs("doc_id")
    top = F.concat_ws("/", "source", F.floor(number / 10000).cast("string"))
    directory = F.concat_ws("/", top, F.floor(number / 100 % 100).cast("string"))
    path = (
        F.when(number % 10000 == 0, F.concat(top, F.lit("/LICENSE")))
        .when(number % 100 == 0, F.concat(directory, F.lit("/LICENSE")))
        .otherwise(F.concat_ws("/", directory, "doc_id"))
    )
    whole = F.col("source").isNotNull() & F.col("doc_id").isNotNull()
    files = docs.select(
        "doc_id", F.when(whole, path).alias("path"), "text", F.coalesce(number % 100 == 0, F.lit(False)).alias("is_licence_file")
    )
    return licences(files, 0.8)


def op11_prefix_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as prefix-target examples, read back; with one that tries the markers."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tried = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return digests(expand(turns.unionByName(tried)))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens that two tokenizers give every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return align_documents(docs, *public_paths())


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters do to the documents of every source, in each of their 120 orders."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit(docs, read(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline over the documents."""
    return corpus_pipeline.run(spark, sf_dir)


def _sent(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    named = (
        op1_line_blocks,
        op2_hilbert,
        op3_va_file,
        op4_waterfill,
        op5_deep_shallow,
        op6_dart_minhash,
        op7_pivots,
        op8_byte_cnn,
        op9_linear_grouping,
        op10_licences,
        op11_prefix_chat,
        op12_token_alignment,
        op13_filter_audit,
        pipeline,
    )
    return {query.__name__: _sent(query) for query in named}


def oracle_sql() -> dict[str, str]:
    whole = corpus_pipeline.ORACLE_SQL
    return ORACLE | ({"pipeline": whole} if whole else {})
