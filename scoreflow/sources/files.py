"""Bounded inputs and streams over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

# Schema of Spark's image source, which a stream needs up front.
IMAGE_SCHEMA = (
    "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
)


def read_lines(spark: SparkSession, path: str | list[str], blank: bool = True) -> DataFrame:
    """One row per line in `value`; line ends of either kind are removed.

    `blank=False` leaves blank lines out.
    """
    lines = spark.read.text(path)
    return lines if blank else lines.filter(lines.value != "")


def read_csv(
    spark: SparkSession, path: str | list[str], schema: str | StructType | None = None, header: bool = True
) -> DataFrame:
    """CSV with a header line. Without `schema` the types are inferred, at the
    price of reading the data one more time."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


# Streams over folders take `limits`, which bound a micro-batch and with it what a
# failed batch has to do again: max_files=..., or max_bytes=... of input.


def stream_lines(spark: SparkSession, path: str, **limits) -> DataFrame:
    """New text files of a folder as a stream of lines."""
    return _stream(spark, "text", None, **limits).load(path)


def stream_parquet(
    spark: SparkSession, path: str, schema: str | StructType, glob: str | None = None, **limits
) -> DataFrame:
    """A folder of Parquet files as a stream; `glob` selects by file name."""
    reader = _stream(spark, "parquet", schema, **limits)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def stream_table(spark: SparkSession, path: str, schema: str | StructType, **limits) -> DataFrame:
    """A Parquet table as a stream, be it one file or a folder of part files.

    A table that is not there is an error, not an empty stream.
    """
    spark.read.schema(schema).parquet(path)  # raises where nothing is
    # Streams take folders; a pattern may also match a file.
    return _stream(spark, "parquet", schema, **limits).load(f"{path[:-1]}[{path[-1]}]")


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Whole files as (`key`, `value`): path and bytes, like a keyed byte topic."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).selectExpr("path AS key", "content AS value")


def read_images(spark: SparkSession, path: str, drop_invalid: bool = True) -> DataFrame:
    """Decoded images in the struct column `image`: origin, size, channels, pixels."""
    return spark.read.format("image").option("dropInvalid", drop_invalid).load(path)


def stream_images(spark: SparkSession, path: str, **limits) -> DataFrame:
    """New image files of a folder; files that are no image are left out."""
    images = _stream(spark, "image", IMAGE_SCHEMA, **limits).load(path)
    return images.filter("image.width > 0")


def _stream(
    spark: SparkSession, fmt: str, schema, max_files: int | None = None, max_bytes: int | None = None
) -> DataStreamReader:
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader
