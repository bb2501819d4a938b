"""Datasets by id: registered loaders, else files by format, else catalog tables.

Source order is a column, ``row_index``: of Parquet it is the reader's own row number shifted by the
rows of the files before, by path; other sources must carry it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Loader = Callable[[SparkSession, str, str | None], DataFrame]
_LOADERS: dict[str, Loader] = {}
#: Files of a source whose names are broadcast; of more, rows are joined with them by a shuffle.
MAX_FILES = 1_000_000
FORMATS = {".parquet": "parquet", ".json": "json", ".jsonl": "json", ".ndjson": "json", ".csv": "csv", ".orc": "orc"}


def register(dataset_id: str, loader: Loader) -> None:
    """``loader`` is a function of (session, split, configuration name)."""
    _LOADERS[dataset_id] = loader


def with_row_index(df: DataFrame) -> DataFrame:
    """Adds ``row_index`` to a Parquet scan unless it is there: files in the order of their paths,
    rows in the order of their file.  Only file names and counts are shuffled; they are broadcast, up to
    ``MAX_FILES`` of them."""
    if "row_index" in df.columns:
        return df
    rows = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    sizes = rows.groupBy("__file").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = sizes.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    starts = F.broadcast(starts) if len(df.inputFiles()) <= MAX_FILES else starts
    return rows.join(starts, "__file").withColumn("row_index", F.col("__at") + F.col("__start")).drop("__file", "__at", "__start")


def load(spark: SparkSession, dataset_id: str, split: str, name: str | None = None, split_col: str = "dataset_split") -> DataFrame:
    """The rows of a split.  A path's format follows its ending (a folder is Parquet); where rows
    carry their split, it is compared trimmed and in lower case."""
    if dataset_id in _LOADERS:
        return _LOADERS[dataset_id](spark, split, name)
    path = f"{dataset_id}/{name}" if name else dataset_id
    kind = next((f for ending, f in FORMATS.items() if path.rstrip("/").endswith(ending)), None)
    if kind is None and "/" not in path:
        df = spark.table(path)
    elif kind == "csv":
        df = spark.read.option("header", True).csv(path)
    elif kind in (None, "parquet"):
        df = with_row_index(spark.read.parquet(path))
    else:
        df = spark.read.format(kind).load(path)
    if split_col in df.columns:
        df = df.where(F.lower(F.trim(split_col)) == split.strip().lower())
    return df
