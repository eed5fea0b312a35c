"""Arriving patients as a stream of micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cohortkit import domain
from cohortkit.functions.columns import normal_name, quoted
from cohortkit.plans.arrivals import SCORED_BEFORE, Scoring, arrival_errors, score_arrivals, store_arrivals
from cohortkit.plans.store import CohortStore
from cohortkit.session import materialise

# How long a stream remembers a scored patient after its last arrival.
REMEMBER_DAYS = 90.0

# Groups of keys whose patients share one state. A running stream's checkpoint depends on it.
STATE_GROUPS = 1024


def arriving(spark: SparkSession, folder: str, schema: T.StructType, *, max_files: int | None = None) -> DataFrame:
    """A stream over Parquet files that uploads drop into a folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to the end: the committed write leaves this mark."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def _packed(deadlines: pd.Series) -> bytes:
    table = pa.table({"key": pa.array(deadlines.index, pa.string()), "deadline": pa.array(deadlines.to_numpy(), pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(state: bytes | None) -> pd.Series:
    """Deadline (ms) by remembered key."""
    if state is None:
        return pd.Series(index=pd.Index([], dtype=object), dtype=np.int64)
    table = pa.ipc.open_stream(state).read_all()
    return pd.Series(table.column("deadline").to_numpy(), pd.Index(table.column("key").to_pylist(), dtype=object))


def mark_scored_before(arrivals: DataFrame, scoring: Scoring, *, days: float = REMEMBER_DAYS, clock_skew: str = "1 hour") -> DataFrame:
    """Add whether an earlier micro-batch scored the row's patient, from state kept per patient.

    A patient is remembered when it arrives in a single row without errors, so a
    corrected row of a rejected patient is still scored. Each arrival renews the
    time limit, which runs on the times of the micro-batches; ``clock_skew`` is how far the
    driver's clock may step back before rows would count as late. Patients meet in ``STATE_GROUPS`` groups by a hash of the
    key, each with one state of its remembered keys and their limits, because a call in Python costs the same for one row as
    for thousands. Rows without a key are remembered by nothing and spread by their content. The other columns of a row pass the state as one text.
    """
    key, duration = domain.KEY, int(days * 86_400_000)
    arrivals = arrivals.toDF(*[normal_name(c) for c in arrivals.columns])
    fields = arrivals.schema.fields
    # As text no value changes on its way through pandas, whose integers and flags hold no nulls.
    row = F.to_json(F.struct(*[quoted(f.name).cast("string").alias(f.name) for f in fields]))
    keyless = F.xxhash64(*[quoted(f.name) for f in fields])
    group_of = F.pmod(F.when(quoted(key).isNull(), keyless).otherwise(F.xxhash64(quoted(key).cast("string"))), F.lit(STATE_GROUPS))
    rows = arrivals.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", clock_skew).select(
        "_arrived", F.unix_millis("_arrived").alias("_millis"), quoted(key).cast("string").alias("_state_key"), group_of.cast("int").alias("_group"),
        (F.size(arrival_errors(arrivals, scoring)) == 0).alias("_valid"), row.alias("_row"),
    )

    def mark(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, seen = _unpacked(state.get[0] if state.exists else None), []
        for frame in frames if not state.hasTimedOut else ():
            yield pd.DataFrame({"_row": frame["_row"], SCORED_BEFORE: frame["_state_key"].isin(known.index)})
            seen.append(frame.loc[frame["_state_key"].notna(), ["_state_key", "_valid", "_millis"]])
        if seen:
            rows = pd.concat(seen).groupby("_state_key").agg(rows=("_valid", "size"), valid=("_valid", "sum"), millis=("_millis", "first"))
            again = rows["millis"][rows.index.isin(known.index) | ((rows["rows"] == 1) & (rows["valid"] == 1))] + duration
        # As with a state of its own, a patient is forgotten at its limit unless it has just arrived.
        watermark = state.getCurrentWatermarkMs()
        known = known[known >= watermark]
        if seen and len(again):
            known = pd.concat([known[~known.index.isin(again.index)], again.astype(np.int64)])
        if len(known):
            state.update((_packed(known),))
            state.setTimeoutTimestamp(max(int(known.min()), watermark + 1))
        elif state.exists:
            state.remove()

    marked = rows.groupBy("_group").applyInPandasWithState(
        mark, f"_row string, {SCORED_BEFORE} boolean", "remembered binary", "append", GroupStateTimeout.EventTimeTimeout
    )
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    read = marked.select(F.from_json("_row", texts).alias("_row"), SCORED_BEFORE)
    return read.select(*[F.col("_row")[f.name].cast(f.dataType).alias(f.name) for f in fields], SCORED_BEFORE)


def score_stream(
    arrivals: DataFrame, scoring: Scoring, store: CohortStore, results: str, checkpoint: str,
    *, remember_days: float = REMEMBER_DAYS,
) -> DataStreamWriter:
    """Process each micro-batch like a batch; results are written per batch id.

    A patient is scored once within ``remember_days``, whatever was stored of it. A batch
    is written before it is used, so its state is computed once.

    Results are written before anything is stored. A batch that runs again after
    a failure keeps its results if they were written to the end, writes them anew if
    not, and completes the storing.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = materialise(batch, f"arrived-{batch_id}")
        if batch.isEmpty():
            return
        path = f"{results.rstrip('/')}/batch={batch_id}"
        spark = batch.sparkSession
        if not _complete(spark, path):
            score_arrivals(batch, scoring, store, label=f"batch-{batch_id}").write.mode("overwrite").parquet(path)
        store_arrivals(batch, spark.read.parquet(path), scoring, store)

    return (
        mark_scored_before(arrivals, scoring, days=remember_days).writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
