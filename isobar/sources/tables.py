"""Table readers and writers. Schemas are declared, never inferred."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar import schema as S
from isobar.session import scratch_path


# --- headers --------------------------------------------------------------------------

CHUNK = 1 << 16  # bytes read from a file at once while its header is looked for
BOM = "\ufeff"
HEADERS = "path string, header string, error string"


def first_line(stream: BinaryIO, chunk: int = CHUNK) -> str | None:
    """The first line of ``stream`` that is not blank; nothing behind its chunk is read."""
    rest = b""
    while part := stream.read(chunk):
        rest += part
        *lines, rest = re.split(rb"[\r\n]+", rest)
        for line in lines:
            if text := line.decode("utf-8", "replace").lstrip(BOM).strip():
                return line.decode("utf-8", "replace").lstrip(BOM)
    text = rest.decode("utf-8", "replace").lstrip(BOM)
    return text if text.strip() else None


def opened(uri: str, plain: str) -> BinaryIO:
    """A file by its address, or by its path where that is a plain one; compressed by its ending."""
    if uri.startswith("file:"):
        system, place = pafs.LocalFileSystem(), re.sub("^file:/*", "/", plain)
    else:
        system, place = pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))
    return system.open_input_stream(place, compression="detect")


def read_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Opens each file and stops behind its first line; a file that cannot be opened is reported."""
    for batch in batches:
        uris = batch.column("path").to_pylist()
        lines, errors = [], []
        for uri, plain in zip(uris, batch.column("plain").to_pylist()):
            line = error = None
            try:
                with opened(uri, plain) as stream:
                    line = first_line(stream)
            except (OSError, NotImplementedError, pa.ArrowException) as e:
                error = f"{type(e).__name__}: {e}"
            lines.append(line)
            errors.append(error)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.string()) for x in (uris, lines, errors)], ["path", "header", "error"]
        )


def file_headers(spark: SparkSession, path: str | list[str], fragment: str = "", **options) -> DataFrame:
    """(path, header) of every file that has one and whose path contains ``fragment``, whatever the case.

    Tasks take groups of files and read the first chunk of each, so the work does not grow with
    the files. Where the tasks' own file systems cannot open a file, Spark's text reader is asked for
    all first lines; that is one pass over the text. The result is a written table.
    """
    here = F.col("_metadata.file_path")
    named = F.lower(here).contains(fragment.lower())
    # Without its content a file is listed, not read.
    listed = spark.read.format("binaryFile").options(**options).load(path).filter(named)
    found = listed.select(here.alias("path"), F.col("path").alias("plain")).mapInArrow(read_headers, HEADERS)
    place = scratch_path(spark, "headers")
    found.write.parquet(place)
    found = spark.read.parquet(place)
    if found.filter(F.col("error").isNotNull()).isEmpty():
        return found.filter(F.col("header").isNotNull()).select("path", "header")
    lines = spark.read.text(path, **options).select(
        "value", here.alias("path"), F.monotonically_increasing_id().alias("line"),
        F.col("_metadata.file_block_start").alias("block"),
    ).filter((F.col("block") == 0) & F.lower("path").contains(fragment.lower()) & (F.trim("value") != ""))
    place = scratch_path(spark, "headers")
    first = lines.groupBy("path").agg(F.min_by("value", "line").alias("header"))
    first.select("path", F.ltrim("header", F.lit(BOM)).alias("header")).write.parquet(place)
    return spark.read.parquet(place)


def column_names(header: str, example: str) -> list[str]:
    names = next(csv.reader([header]))
    if len(set(names)) < len(names):
        raise ValueError(f"a column stands twice in the header {header!r}, for example in {example}")
    return names


@dataclass(frozen=True)
class HeadedLines:
    """The lines of CSV files without their headers: value, path, and the number of the file's header."""

    lines: DataFrame
    kinds: list[list[str]]  # column names of each distinct header, the most frequent first

    def parsed(self, kind: int) -> Column:
        """The line as a struct of text columns; NULL for lines below another header."""
        row = F.from_csv("value", F.lit(S.all_string(self.kinds[kind]).toDDL()))
        return F.when(F.col("kind") == kind, row)


def headed_lines(spark: SparkSession, path: str | list[str], fragment: str = "", **options) -> HeadedLines:
    """All lines of the files, each with its file's header, from one pass over the text.

    The driver receives the distinct headers. Files below another header than the most frequent one
    are joined by path, with no hint: Catalyst sees how large their written list is. A line
    equal to its file's header counts as a header wherever it stands.
    """
    headers = file_headers(spark, path, fragment, **options)
    counted = headers.groupBy("header").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("example"))
    kinds = sorted(counted.collect(), key=lambda r: (-r["n"], r["header"]))
    here = F.col("_metadata.file_path")
    text = spark.read.text(path, **options).select("value", here.alias("path"))
    text = text.filter(F.lower("path").contains(fragment.lower()) & (F.trim("value") != ""))
    if not kinds:
        return HeadedLines(text.withColumn("kind", F.lit(0)).limit(0), [])
    if len(kinds) == 1:
        lines = text.withColumn("kind", F.lit(0))
    else:
        number = F.lit(None).cast("int")
        for i, r in enumerate(kinds[1:], 1):
            number = F.when(F.col("header") == r["header"], F.lit(i)).otherwise(number)
        place = scratch_path(spark, "other-headers")
        headers.select("path", number.alias("kind")).filter(F.col("kind").isNotNull()).write.parquet(place)
        lines = text.join(spark.read.parquet(place), "path", "left").withColumn("kind", F.coalesce("kind", F.lit(0)))
    own = F.get(F.array(*[F.lit(r["header"]) for r in kinds]), F.col("kind"))
    lines = lines.filter((F.col("value") != own) & (F.col("value") != F.concat(F.lit(BOM), own)))
    return HeadedLines(lines, [column_names(r["header"], r["example"]) for r in kinds])


def read_by_header(spark: SparkSession, path: str | list[str], fragment: str = "", **options) -> list[DataFrame]:
    """CSV files as text columns, one table per distinct header, each with its files' ``path``."""
    found = headed_lines(spark, path, fragment, **options)
    return [
        found.lines.filter(F.col("kind") == k).select(found.parsed(k).alias("row"), "path").select("row.*", "path")
        for k in range(len(found.kinds))
    ]


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw observations from a folder or glob of CSV files, each with a header of its own.

    Every column is text: inference would scan the files twice, turn station ids into
    numbers and dates into zoned timestamps. Columns are matched by name, so files may
    order them differently or lack some, which are then NULL. The text is read once, whatever
    the number of headers.
    """
    found = headed_lines(spark, path)
    if not found.kinds:
        raise ValueError(f"no file with a header in {path}")
    names = [c for c in S.RAW_COLUMNS if any(c in kind for kind in found.kinds)]
    rows = found.lines.select(*[found.parsed(k).alias(f"row_{k}") for k in range(len(found.kinds))])
    # Only one of the structs of a line is not NULL.
    return rows.select(*[
        F.coalesce(*[F.col(f"row_{k}")[c] for k, kind in enumerate(found.kinds) if c in kind]).alias(c) for c in names
    ])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_csv(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_parquet(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def files_under(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path) of the files below ``root`` whose names match ``pattern``; they are listed, not read."""
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(root)
    return listed.select(F.col("_metadata.file_path").alias("path"))


def read_csv_under(spark: SparkSession, root: str, fragment: str, without: str = "") -> list[DataFrame]:
    """All CSV files below ``root`` whose path contains ``fragment`` and not ``without``, by header, as text columns."""
    found = read_by_header(spark, root, fragment, recursiveFileLookup=True, pathGlobFilter="*.csv")
    return [t.filter(~F.col("path").contains(without)) for t in found] if without else found


def read_json_under(spark: SparkSession, root: str, schema: T.StructType, single: bool = False) -> DataFrame:
    """First record of every JSON file below ``root``, array or line-delimited, with its path.

    These are one-record metric files, so each is read as a single text value. With ``single``
    a file with more than one record is an error.
    """
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    path = F.col("_metadata.file_path")
    records = F.from_json("value", T.ArrayType(schema))
    several = (F.size(records) > 1) | (F.regexp_count("value", F.lit(r"(?m)^\s*\{.*\}\s*$")) > 1)
    checked = F.when(several, F.raise_error(F.concat(F.lit("more than one record in "), path))).otherwise(F.get(records, F.lit(0)))
    record = checked if single else F.get(records, F.lit(0))
    return files.select(record.alias("r"), path.alias("path")).filter(F.col("r").isNotNull()).select("r.*", "path")
