from scoreflow.streaming.ledger import Ledger
from scoreflow.streaming.queries import (
    RowVisitor,
    fan_out,
    ledger_folder,
    numbered,
    sql_sink,
    start_console,
    start_fan_out,
    start_files,
    start_kafka,
    start_table,
    start_visitor,
)

__all__ = [
    "Ledger", "RowVisitor", "fan_out", "ledger_folder", "numbered", "sql_sink", "start_console", "start_fan_out", "start_files", "start_kafka", "start_table",
    "start_visitor",
]
