"""Jobs on byte payloads: text cleaning and images."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from scoreflow.functions import clean_utf8, encode_utf8

PIXELS_DDL = "width int, height int, nChannels int, dtype string, data binary"

#: Decoded pixels that one Arrow batch hands back, about; one image is never cut.
OUTPUT_BYTES = 32 << 20


def payload_text(records: DataFrame) -> DataFrame:
    """(`key`, bytes `value`) to (`key`, `text`), invalid bytes left out."""
    return records.select("key", clean_utf8(F.col("value")).alias("text"))


def payload_bytes(records: DataFrame) -> DataFrame:
    """(`key`, string `value`) to (`key`, `bytes`)."""
    return records.select("key", encode_utf8(F.col("value")).alias("bytes"))


def image_pixels(images: DataFrame) -> DataFrame:
    """The fields of the `image` column, pixels as bytes in `data`."""
    return images.select(
        "image.origin", "image.width", "image.height", "image.nChannels", "image.data"
    )


def decode_images(
    records: DataFrame, decode: Callable[[bytes], np.ndarray | None], value: str = "value"
) -> DataFrame:
    """Image bytes in a column, as from a topic, to pixels.

    `decode` turns bytes into an array of rows, columns and, if there are
    several, channels, e.g. with the codec of an image library. Pixels keep the
    array's own type, named in `dtype`, so 16-bit images stay 16-bit. Payloads it
    answers with None are left out. For files prefer `read_images`, which needs
    no Python.
    """

    kept = [c for c in records.columns if c != value]
    fields = ["width", "height", "nChannels", "dtype", "data"]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.binary()]

    def decoded(payload: bytes) -> tuple | None:
        pixels = decode(payload)
        if pixels is None or not pixels.size:
            return None
        height, width, channels = (*pixels.shape, 1)[:3]
        little = pixels.astype(pixels.dtype.newbyteorder("<"), copy=False)
        return width, height, channels, pixels.dtype.name, np.ascontiguousarray(little).tobytes()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, size = [], [], 0
            for i, payload in enumerate(batch.column(value)):
                row = decoded(payload.as_py()) if payload.is_valid else None
                if row is not None:
                    rows.append(row)
                    places.append(i)
                    size += len(row[-1])
                if rows and (size >= OUTPUT_BYTES or i + 1 == batch.num_rows):
                    own = batch.take(pa.array(places))
                    columns = [own.column(c) for c in kept] + [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays(columns, [*kept, *fields])
                    rows, places, size = [], [], 0

    schema = StructType([*(records.schema[c] for c in kept), *StructType.fromDDL(PIXELS_DDL).fields])
    return records.mapInArrow(unpack, schema)
