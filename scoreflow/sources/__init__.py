from scoreflow.sources.files import (
    IMAGE_SCHEMA,
    read_binary,
    read_csv,
    read_images,
    read_lines,
    stream_images,
    stream_lines,
    stream_parquet,
    stream_table,
)
from scoreflow.sources.topics import (
    kafka_options,
    keyed_bytes,
    keyed_text,
    stream_kafka,
    stream_kafka_binary,
    stream_socket,
)

__all__ = [
    "IMAGE_SCHEMA", "kafka_options", "keyed_bytes", "keyed_text", "read_binary", "read_csv",
    "read_images", "read_lines", "stream_images", "stream_kafka", "stream_kafka_binary",
    "stream_lines", "stream_parquet", "stream_table", "stream_socket",
]
