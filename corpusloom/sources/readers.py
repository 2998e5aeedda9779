"""Reading named sources."""

from __future__ import annotations

import os
import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.sources.catalogue import Source

FORMATS = ("parquet", "orc", "json", "csv")


@dataclass(frozen=True)
class Layout:
    """Where sources live: ``root/name[/config]``, as a folder, a single file ``name.format`` or a catalog table.

    A split is a partition directory ``split=…`` below, so that asking for it prunes the others; a source without such
    directories is one split.
    """

    root: str
    format: str = "parquet"
    tables: bool = False

    def path(self, source: Source) -> str:
        parts = [self.root, source.name]
        if source.config_name:
            parts.append(source.config_name)
        return os.path.join(*parts)


def scan(spark: SparkSession, layout: Layout, source: Source) -> DataFrame:
    """A bounded frame of a source. Files are not opened beyond their schema."""
    if layout.tables:
        df = spark.table(source.name)
    else:
        path = layout.path(source)
        try:
            df = spark.read.format(layout.format).load(path)
        except PySparkException as missing:
            try:
                df = spark.read.format(layout.format).load(f"{path}.{layout.format}")
            except PySparkException:
                raise missing from None
    return _split(df, source)


def scan_stream(
    spark: SparkSession, layout: Layout, source: Source, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """The same source as a stream of its files, which are read where they lie; a batch takes up to ``files_per_batch`` of them."""
    reader = spark.readStream.format(layout.format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _split(reader.load(layout.path(source)), source)


def _split(df: DataFrame, source: Source) -> DataFrame:
    if source.split is None or "split" not in df.columns:
        return df
    return df.where(F.col("split") == source.split).drop("split")


ROWS_PER_FILE_BITS = 40


def with_order_key(df: DataFrame, out: str = "key") -> DataFrame:
    """Number the rows of a parquet scan in file order: by file name, then by place in the file.

    Must be called on the scan itself. Only file names are gathered, one row per file, to give them numbers.
    """
    files = df.select(F.col("_metadata.file_path").alias("__file")).groupBy("__file").agg(F.count(F.lit(1)).alias("n"))
    number = F.row_number().over(Window.orderBy("__file")).cast("bigint") - 1
    too_many = F.raise_error(F.lit(f"more than {1 << 63 - ROWS_PER_FILE_BITS} files")).cast("bigint")
    numbered = files.select("__file", F.when(number < 1 << 63 - ROWS_PER_FILE_BITS, number).otherwise(too_many).alias("__number"))
    located = df.withColumns({"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")})
    return (
        located.join(numbered, "__file")
        .withColumn(out, F.shiftleft(F.col("__number"), ROWS_PER_FILE_BITS) + F.col("__row"))
        .drop("__file", "__number", "__row")
    )


def columns_of(df: DataFrame) -> list[str]:
    """The columns of a source, known from its schema without reading a row."""
    return df.columns


@dataclass(frozen=True)
class Loaded:
    """What became of one source."""

    source: Source
    loaded_from: str | None
    error: str | None
    frame: DataFrame | None


def load_sources(read: Callable[[Source], DataFrame], sources: list[Source]) -> list[Loaded]:
    """Open every source; one that fails is replaced by its fallback or skipped with a warning.

    The fallback keeps split and weight and drops the configuration. It is an error when nothing can be opened.
    """
    report = []
    for source in sources:
        attempts = [source]
        if source.fallback_name:
            attempts.append(
                Source(source.fallback_name, source.weight, source.streaming, source.split)
            )
        loaded, errors = None, []
        for attempt in attempts:
            try:
                frame = read(attempt)
                frame.schema  # noqa: B018 - resolves the source now, so that a failure shows here
                loaded = Loaded(source, attempt.name, None, frame)
                break
            except Exception as error:  # any failure of one source leaves the others usable
                errors.append(str(error).split("\n")[0])
                warnings.warn(f"could not load {attempt.name}: {errors[-1]}", stacklevel=2)
        report.append(loaded or Loaded(source, None, "; ".join(errors), None))
    if not any(entry.frame is not None for entry in report):
        raise ValueError("none of the sources could be loaded")
    return report


def load_report(spark: SparkSession, report: list[Loaded]) -> DataFrame:
    rows = [(e.source.name, e.loaded_from, e.source.weight, e.frame is not None) for e in report]
    return spark.createDataFrame(rows, "name string, loaded_from string, weight double, loaded boolean")
