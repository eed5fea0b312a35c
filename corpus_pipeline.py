"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before it kept and is written as Parquet before the next one
reads it. All but the last return the columns of ``documents``; further columns are left out.

A null text counts as empty and stays null. Rows that share an id are one document for the
stages that drop whole documents: a hit in one of them drops all, and of rows that also share the
text one stays. A row without an id is scored and cut like any other, but the stages that drop
by id (near copies, benchmark phrases) leave it in. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import decontaminate, packing, setjoin, suffix, toxicity
from cohortkit.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from ``labels`` of the documents given."""
    weights = toxicity.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs.select(*COLUMNS), weights).where("toxicity < 0.5").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 stays."""
    return setjoin.keep_one(docs.select(*COLUMNS), k=5, num=80, den=100)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Characters inside 200-byte strings that occur more than once go; documents stay, though perhaps empty."""
    cut = suffix.cut_repeats(docs.select(*COLUMNS), whole_characters=True)
    kept = F.decode("kept", "UTF-8")
    return cut.withColumn("text", F.when(F.col("text").isNotNull(), kept)).withColumn(
        "n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of ten words of a benchmark item go."""
    index = decontaminate.build_index(docs.select("doc_id", "text"))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    spans = decontaminate.find_phrases(index, decontaminate.phrases(items))
    hit = decontaminate.documents_of(index).join(spans.select("doc_row").distinct(), "doc_row").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(hit, "doc_id", "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("suffix_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# No stage but the fourth can be said in SQL; tests/llm compares the operators of the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
