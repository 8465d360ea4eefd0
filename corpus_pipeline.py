"""Raw documents to packed training sequences, in five stages; each is one operator of ``webcapture.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from webcapture.llm.common import saved
from webcapture.llm.decontaminate import build_index, contamination, find_items
from webcapture.llm.jaccard_join import jaccard_components
from webcapture.llm.langid import UNKNOWN, identify
from webcapture.llm.packing import pack_documents
from webcapture.llm.suffix_dedup import remove_repeats
from webcapture.shipping import ship

#: Bytes of a batch that goes to Python: it is held twice by an executor's JVM and once by each worker.
BATCH_BYTES = 8 << 20
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least probability of the likeliest language; texts below it, and those without a letter, are rejected.
LEAST_SCORE = 0.5
#: Bytes of a passage that is removed wherever it occurs, and the words of shorter passages that are removed too.
PASSAGE, GRAM, WORDS = 250, 96, 51


def _prepare(spark: SparkSession) -> None:
    """Sends the code to the executors, bounds what a batch of whole texts takes there, and lets shuffles go with their job.

    Every job of a stage ends in a table that is read back, so no later one reads its shuffles again.
    """
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose language cannot be told; the rows of five crc32 classes but one teach it."""
    _prepare(spark)
    known = identify(docs.select(*COLUMNS))
    return known.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the one with the smallest id stays.

    Rows without an id stay, as no other can be told to stand for them. Of rows with the same id and text one
    stays; rows with one id but different texts are different documents, of which a linked group keeps the one
    whose text has the smallest hash. Rows without words stay.
    """
    _prepare(spark)
    found = saved(jaccard_components(docs, k=5, num=80, den=100, hashes=True), "components")
    # Only where some row stands twice: without one there is nothing to drop.
    if not found.groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty():
        docs = docs.dropDuplicates(["doc_id", "text"])
    stands = (F.col("doc_id") == F.col("component_id")) & (F.col("text_hash") == F.col("component_hash"))
    dropped = found.filter(F.col("doc_id").isNotNull() & ~stands).select("doc_id", "text_hash").distinct()
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    return docs.join(dropped, ["doc_id", "text_hash"], "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every passage of ``PASSAGE`` bytes or ``WORDS`` words that also occurs elsewhere out of the texts.

    All documents stay. A character that a cut would part goes with the passage.
    """
    _prepare(spark)
    kept = remove_repeats(docs, length=PASSAGE, gram=GRAM, carry=("lang", "source"), as_text=True, words=WORDS)
    return kept.withColumn("n_chars", F.length("kept").cast("long")).withColumnRenamed("kept", "text").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which at least a twentieth of the words stand in benchmark windows."""
    _prepare(spark)
    own = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(find_items(build_index(own, id_col="row_key"), items))
    return own.join(found.filter("contaminated").select(F.col("id").alias("row_key")).distinct(), "row_key", "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    _prepare(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("packing", packing),
]
#: SQL cannot express the language model, the removal of passages or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
