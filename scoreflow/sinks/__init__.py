from scoreflow.sinks.batch_sinks import (
    Sink,
    console_sink,
    csv_sink,
    kafka_sink,
    fitting,
    key_minutes_sink,
    parquet_sink,
    rejects_sink,
    partition_sink,
    placed_result_rows,
    result_jdbc_sink,
    result_rows,
    result_table_sink,
    text_sink,
)
from scoreflow.sinks.identity import each_once, id_header, with_message_id, with_place
from scoreflow.sinks.writers import (
    Batch,
    first_delivery,
    jdbc_options,
    jdbc_rows,
    kafka_records,
    write_csv,
    write_jdbc,
    write_kafka,
    write_parquet,
    write_table,
    write_text,
)

__all__ = [
    "Batch", "Sink", "console_sink", "csv_sink", "each_once", "first_delivery", "id_header", "jdbc_options", "jdbc_rows", "kafka_records", "kafka_sink",
    "key_minutes_sink", "fitting", "parquet_sink", "partition_sink", "placed_result_rows", "rejects_sink", "result_jdbc_sink", "result_rows",
    "result_table_sink", "text_sink", "write_csv", "write_jdbc", "write_kafka", "write_parquet",
    "with_message_id", "with_place", "write_table", "write_text",
]
