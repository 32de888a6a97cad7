"""A training-data pipeline over `documents`: each stage takes what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotforge.llm.bytecnn import UNKNOWN, fit, predict
from lotforge.llm.common import content_key, read, ship, stored
from lotforge.llm.dartminhash import near_duplicates
from lotforge.llm.deepshallow import without_repeats
from lotforge.llm.lingroup import pack, word_vocabulary
from lotforge.llm.waterfill import mixed_documents

#: Least probability of the predicted language that a document needs.
SURE = 0.5
#: Whole texts go to Python; of a batch of them, a worker and its executor hold several copies.
BATCH_BYTES = "2m"


def _ready(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones have. Texts that are null, have no letter,
    or are predicted with a probability below `SURE` go."""
    _ready(spark)
    rows = docs.select(F.struct("*").alias("document"), "text")
    known = predict(rows, fit(docs), ["document"])
    return known.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= SURE)).select("document.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the smallest doc_id; one of
    repeated rows. Rows with a null doc_id are in no class; one of those with equal texts stays."""
    _ready(spark)
    key = content_key(F.coalesce("text", F.lit("")))
    keyed = docs.select(F.col("doc_id").alias("_id"), F.struct("*").alias("document"), *key)
    keep = near_duplicates(docs.select("doc_id", "text")).where("kept").select("doc_id", "t1", "t2")
    kept = keyed.join(keep.distinct(), ["t1", "t2"]).where(F.col("_id").eqNullSafe(F.col("doc_id")))
    return kept.dropDuplicates(["t1", "t2", "_id"]).select("document.*")


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeated strings cover; a character of which a part
    went goes whole. A null text stays null."""
    _ready(spark)
    others = F.struct(*(c for c in docs.columns if c != "text"))
    rows = docs.select("doc_id", "text", others.alias("row"), F.col("text").isNull().alias("empty"))
    cut = without_repeats(rows, with_text=True)
    cut = cut.withColumn("kept", F.when(~F.col("empty"), F.col("kept")))
    values = {c: F.col(f"row.{c}") for c in docs.columns if c not in ("text", "n_chars")}
    values |= {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cut.select(*(values[c].alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    _ready(spark)
    return mixed_documents(docs, weights=(5, 2, 1), share=(3, 2), epochs=2, seed=0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    _ready(spark)
    return pack(docs, word_vocabulary(), 4096, end=1)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", remove_repeats),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Learnt, sorted and packed results have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written to the shared folder and read again."""
    _ready(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
