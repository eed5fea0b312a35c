"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import (
    chat, decontaminate, knn, language, lines, oracles, ordering, packing, resample, scoring, search, setjoin, suffix, toxicity,
)
from cohortkit.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame, with its SQL if there is one."""

    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op5_training_order")
def op5_training_order(spark, folder):
    """Slot, crc32 and number of real tokens of each sequence, read back from the shards."""
    shards = ordering.write_training_order(table(spark, folder, "documents"), scratch_path(spark, "shards"))
    if not shards.sequences:
        return spark.createDataFrame([], "slot long, shard long, ids_crc32 long")
    return shards.records(spark).select(
        "slot", F.floor(F.col("slot") / shards.per_shard).alias("shard"), "ids_crc32")


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


def remainder(parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query("op2_voronoi_top_k", oracles.TOP_K)
def op2_voronoi_top_k(spark, folder):
    vectors = knn.scaled(table(spark, folder, "embeddings"))
    return knn.top_k(vectors.where("vec_id % 100 = 0"), vectors)


@query("op3_toxicity_ftrl")
def op3_toxicity_ftrl(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights = toxicity.fit(docs, table(spark, folder, "labels").where(remainder(5) != 0))
    return toxicity.score(docs, weights).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"))


@query("op6_chat_windows")
def op6_chat_windows(spark, folder):
    tricky = spark.createDataFrame(
        [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")],
        "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_windows(chat.format_windows(turns.unionByName(tricky)))


@query("op7_ngram_scores")
def op7_ngram_scores(spark, folder):
    held_out = remainder(5) == 1
    _, scored = scoring.train_and_score(table(spark, folder, "documents"), ~held_out)
    return scored.select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op8_language")
def op8_language(spark, folder):
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(remainder(3) != 1).select("text", "lang"))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


@query("op9_benchmark_phrases", oracles.PHRASES)
def op9_benchmark_phrases(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark, folder):
    cut = suffix.cut_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["length"])
    return cut.select(
        "doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op1_shingle_jaccard", oracles.SHINGLE_JACCARD)
def op1_shingle_jaccard(spark, folder):
    return setjoin.components(table(spark, folder, "documents"), k=3, num=90, den=100)


@query("op11_importance_resampling", oracles.RESAMPLE)
def op11_importance_resampling(spark, folder):
    drawn = resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_line_dedup", oracles.LINES)
def op12_line_dedup(spark, folder):
    kept = lines.drop_repeated_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op13_ranked_search", oracles.SEARCH)
def op13_ranked_search(spark, folder):
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
