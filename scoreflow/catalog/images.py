"""Image files made from the `pages` table: one gray pixel per byte of the page."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from scoreflow.operators import visit_partitions
from scoreflow.session import scratch_path


def write_page_images(pages: DataFrame) -> str:
    """Write each page as `page-<id>.png` from the executors; return the folder."""
    path = scratch_path(pages.sparkSession, "page-images")

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    def png(pixels: bytes) -> bytes:
        header = struct.pack(">IIBBBBB", len(pixels), 1, 8, 0, 0, 0, 0)
        rows = zlib.compress(b"\0" + pixels)
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", rows) + chunk(b"IEND", b"")

    def write(batches: Iterator[pd.DataFrame]) -> None:
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(path)
        system.create_dir(folder, recursive=True)
        for batch in batches:
            for page_id, html in zip(batch["page_id"], batch["html"]):
                with system.open_output_stream(f"{folder}/page-{page_id}.png") as out:
                    out.write(png(html.encode("utf-8")))

    visit_partitions(pages.select("page_id", "html"), write)
    return path


def gather_image_tasks(images: DataFrame, pages: DataFrame) -> DataFrame:
    """The image scan with its files dealt over as many tasks as the pages were read in (one a core
    at least), not a task for each few files; every file is still read, with no shuffle."""
    spark = pages.sparkSession
    return images.coalesce(max(pages.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism))


def page_of(origin: str) -> Column:
    return F.regexp_extract(origin, r"page-(\d+)\.png$", 1)


def page_pixels(pixels: DataFrame, page: Column) -> DataFrame:
    """Page id and image facts, with a digest of the pixels."""
    return pixels.select(
        page.cast("bigint").alias("page_id"),
        F.col("width").cast("bigint").alias("width"),
        F.col("height").cast("bigint").alias("height"),
        F.col("nChannels").cast("bigint").alias("channels"),
        F.md5("data").alias("pixels_md5"),
    )


def page_payloads(pages: DataFrame) -> DataFrame:
    """(`key`, `value`) with each page as a raw pixel map: a header line, then a pixel for each byte.

    By turns the pixels are gray of 8 bits, gray of 16 bits (the byte twice, as in scaling up) and
    color (the byte three times).
    """
    kind = F.col("page_id") % 3
    size = F.octet_length("html")
    header = (
        F.when(kind == 0, F.format_string("P5 %s 1 255\n", size))
        .when(kind == 1, F.format_string("P5 %s 1 65535\n", size))
        .otherwise(F.format_string("P6 %s 1 255\n", size))
    )
    digits = F.hex(F.encode("html", "UTF-8"))
    times = F.when(kind == 0, digits).when(kind == 1, F.regexp_replace(digits, "(..)", "$1$1")).otherwise(
        F.regexp_replace(digits, "(..)", "$1$1$1")
    )
    value = F.concat(F.encode(header, "UTF-8"), F.unhex(times))
    return pages.select(F.col("page_id").cast("string").alias("key"), value.alias("value"))


def decode_map(payload: bytes) -> np.ndarray | None:
    """A raw gray or color map; 16-bit pixels have the high byte first."""
    header, _, pixels = payload.partition(b"\n")
    kind, width, height, largest = header.split(b" ")
    if kind not in (b"P5", b"P6"):
        return None
    values = np.frombuffer(pixels, ">u2" if int(largest) > 255 else np.uint8)
    return values.reshape(int(height), int(width), *((3,) if kind == b"P6" else ()))
