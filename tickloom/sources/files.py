"""File sources: headered and positional CSV, event NDJSON, run summaries."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.ingest import classify, normalise_headers, parse_event_json
from tickloom.schemas import MARKET_ZONE, POSITIONAL
from tickloom.session import check_utc
from tickloom.sources.manifest import write_text


def _with_position(df: DataFrame) -> DataFrame:
    """Where each row came from: file, split and a number rising in row order inside the split."""
    return df.withColumns(
        {
            "source_file": F.col("_metadata.file_path"),
            "block_start": F.col("_metadata.file_block_start"),
            "row_id": F.monotonically_increasing_id(),
        }
    )


def discover_inputs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Input files (path, length): a folder gives its top-level ``*.csv`` files in any case, a file itself.

    A path that does not exist is an error. Only the listing is read, no content.
    """
    listing = spark.read.format("binaryFile").load(paths).select("path", "length")
    # A folder's entry continues the given path after a slash; a given file ends with it.
    named = F.lit(False)
    for path in paths:
        named = named | F.col("path").endswith(path.rstrip("/"))
    return listing.where(named | F.lower("path").endswith(".csv"))


def _header(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Column names of a file's first line that is neither blank nor a comment; only its first bytes are read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        while (line := reader.readLine()) is not None:
            line = line.lstrip("\ufeff")
            if line.strip() and not line.startswith("#"):
                cells = [cell or f"_c{n}" for n, cell in enumerate(next(csv.reader([line])))]
                low = [cell.lower() for cell in cells]
                return tuple(cell if low.count(cell.lower()) == 1 else f"{cell}{n}" for n, cell in enumerate(cells))
    finally:
        reader.close()
    return None


def _by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header line, several looked at side by side and without a Spark job; a file without any has no rows."""
    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for path, header in zip(paths, pool.map(lambda path: _header(spark, path), paths)):
            if header is not None:
                found.setdefault(header, []).append(path)
    return found


def read_ticks_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Headered CSV as text columns with normalised names, plus ``source_file``, ``block_start``, ``row_id``.

    ``#`` lines are comments, quotes are doubled inside quoted fields. A folder
    stands for its ``*.csv`` files. Columns are named by each file's own header,
    so files may differ in their order; a column a file lacks is NULL.
    """
    check_utc(spark)
    options = {"header": True, "comment": "#", "quote": '"', "escape": '"'}
    files = [r.path for r in discover_inputs(spark, [paths] if isinstance(paths, str) else paths).orderBy("path").collect()]
    frames = []
    for header, group in _by_header(spark, files).items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        rows = spark.read.options(**options).schema(schema).csv(group)
        frames.append(normalise_headers(_with_position(rows)))
    if not frames:
        raise ValueError(f"no CSV file in {paths}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_inputs(spark: SparkSession, feed: str | list[str], ndjson: str | list[str], zone: str = MARKET_ZONE) -> DataFrame:
    """Events of CSV and NDJSON inputs with ``status``, ``reason`` and ``source_rank``: in a replay all CSV files come first."""
    columns = ["status", "reason", "symbol", "security_type", "price", "event_ts", "source_file", "block_start", "row_id"]
    first = classify(read_ticks_csv(spark, feed)).select(*columns, F.lit(0).alias("source_rank"))
    return first.unionByName(read_ticks_ndjson(spark, ndjson, zone).select(*columns, F.lit(1).alias("source_rank")))


def read_positional(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """39 text columns ``c00``…``c38`` by position; short rows are padded with NULL, no quoting."""
    check_utc(spark)
    return spark.read.schema(POSITIONAL).option("comment", "#").option("quote", "").option("mode", "PERMISSIVE").csv(paths)


def read_ticks_ndjson(spark: SparkSession, paths: str | list[str], zone: str = MARKET_ZONE) -> DataFrame:
    """One JSON event per line → event columns with ``status`` and ``reason`` and the row's position."""
    check_utc(spark)
    return parse_event_json(_with_position(spark.read.text(paths)), zone=zone).drop("value")


def follow_ndjson(spark: SparkSession, folder: str, files_per_trigger: int | None = None, zone: str = MARKET_ZONE) -> DataFrame:
    """The streaming form: new files in ``folder`` are read as they appear (the unit of arrival is a file).

    ``arrival`` orders rows by file time, path and position.
    """
    check_utc(spark)
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.load(folder).select(
        "value",
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    numbered = lines.mapInArrow(_number_rows, T.StructType(lines.schema.fields + [T.StructField("row_id", T.LongType())]))
    arrival = F.struct("file_time", "source_file", "block_start", "row_id").alias("arrival")
    return parse_event_json(numbered.select("value", arrival), zone=zone).drop("value")


def _number_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count a task's rows in reading order; a stream has no built-in row number."""
    seen = 0
    for batch in batches:
        numbers = pa.array(range(seen, seen + batch.num_rows), pa.int64())
        seen += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, numbers], names=[*batch.schema.names, "row_id"])


def write_runs(runs: DataFrame, folder: str) -> None:
    """One ``<run>/summary.json`` per row; runs are few, and a summary is a row."""
    spark = runs.sparkSession
    for row in runs.select("run", F.to_json(F.struct(*[c for c in runs.columns if c != "run"])).alias("body")).toLocalIterator():
        write_text(spark, f"{folder.rstrip('/')}/{row.run}/summary.json", row.body)


def read_runs(spark: SparkSession, folder: str, schema: str | T.StructType | None = None) -> DataFrame:
    """``<run>/summary.json`` of every run below ``folder``, with the run's name."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    runs = reader.json(f"{folder.rstrip('/')}/*/summary.json")
    return runs.withColumn("run", F.element_at(F.split("_metadata.file_path", "/"), -2))
