"""Scans: CSV, JSON, Parquet, catalog tables, predictions and selection logs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from cohortkit import domain
from cohortkit.functions.columns import quoted
from cohortkit.operators import columns as cols
from cohortkit.operators.quality import require_rows
from cohortkit.operators.selection import Selection


def read_csv(spark: SparkSession, path: str, types: Mapping[str, str] | None = None) -> DataFrame:
    """CSV with a header. Given ``types`` apply by column name, in any order; other columns are text.

    Files below ``path`` may differ in the order of their columns and in which they have: files of one
    header are read together, and the groups are put together by name, with nulls for what a file
    lacks. Only the first line of each file is read for that. Without ``types`` the types are
    inferred, which reads the data twice, and types that differ between groups become text.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    files = [r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").collect()]
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPool(8) as pool:
        first_lines = inheritable_thread_target(spark)(lambda file: tuple(reader.csv(file).columns))
        for file, header in zip(files, pool.map(first_lines, files), strict=True):
            groups.setdefault(header, []).append(file)
    if len(groups) <= 1:
        return _read_group(reader, path, next(iter(groups), None), types)
    parts = [_read_group(reader, group, header, types) for header, group in groups.items() if header]
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for name, kind in part.dtypes:
            kinds.setdefault(name, set()).add(kind)
    parts = [
        part.select(*[quoted(c).cast("string").alias(c) if len(kinds[c]) > 1 else quoted(c) for c in part.columns]) for part in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read_group(reader: DataFrameReader, files: str | list[str], header: Sequence[str] | None, types: Mapping[str, str] | None) -> DataFrame:
    """Files of one header; a file that is changed meanwhile fails instead of being read by position."""
    if types is None:
        return reader.option("inferSchema", True).csv(files)
    names = reader.csv(files).columns if header is None else header
    schema = T.StructType([T.StructField(c, T.DataType.fromDDL(types.get(c, "string"))) for c in names])
    return reader.schema(schema).csv(files)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A JSON file holding an array of records."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_phenotypes(spark: SparkSession, path: str) -> DataFrame:
    """Raw phenotype CSV with the known column types."""
    return read_csv(spark, path, domain.RAW_PHENOTYPE_TYPES)


def read_genotypes(spark: SparkSession, path: str) -> DataFrame:
    """Raw genotype CSV; dosages stay text so that bad ones can be told from missing ones."""
    return read_csv(spark, path, {domain.KEY: "bigint"})


def load_table(spark: SparkSession, name: str, target: str | None = domain.TARGET) -> DataFrame:
    """A catalog table; fails if it is empty or lacks the target."""
    df = require_rows(spark.table(name), name)
    if target:
        cols.require_columns(df, [target])
    return df


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def count_rows(spark: SparkSession, name: str) -> int:
    """Rows of a table; 0 if there is no such table."""
    return spark.table(name).count() if table_exists(spark, name) else 0


PREDICTION_COLUMNS = ["y_true", "y_pred", "y_prob"]


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Saved test predictions; all three parts must be there."""
    df = spark.read.parquet(path)
    cols.require_columns(df, PREDICTION_COLUMNS)
    return df


def load_selection(spark: SparkSession, path: str) -> Selection:
    """The selection log as an object."""
    return Selection.from_frame(spark.read.parquet(path))


def load_selected_features(log: DataFrame) -> DataFrame:
    """Selected features of a log in their order: ``family``, ``feature``, ``rank``."""
    return log.where("status = 'selected'").select("family", "feature", "rank").orderBy("family", "rank")


class DatasetRegistry:
    """Named datasets, each a function from a session to a DataFrame."""

    def __init__(self, loaders: Mapping[str, tuple[str, Callable[[SparkSession], DataFrame]]]):
        self._loaders = dict(loaders)

    @property
    def names(self) -> list[str]:
        return list(self._loaders)

    def load(self, spark: SparkSession, name: str) -> tuple[DataFrame, str]:
        """The dataset and its label; an unknown name is an error."""
        if name not in self._loaders:
            raise ValueError(f"unknown dataset {name!r}, known: {self.names}")
        label, loader = self._loaders[name]
        return loader(spark), label
