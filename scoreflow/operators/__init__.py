from scoreflow.operators.batches import map_batches, visit_partitions
from scoreflow.operators.evaluation import ObservedError, mape, with_observed_error
from scoreflow.operators.lines import (
    cast_columns,
    drop_blank,
    keep_int_field,
    parse_delimited,
    parse_with_rejects,
    project_pair,
    split_fields,
)
from scoreflow.operators.preview import preview, schema_report
from scoreflow.operators.rowid import distribute, with_dense_index
from scoreflow.operators.scoring import (
    python_scorer,
    score_mllib,
    score_python,
    score_trees,
    with_minutes,
    with_seconds,
)
from scoreflow.operators.sql import register_view, run_sql

__all__ = [
    "ObservedError", "cast_columns", "distribute", "drop_blank", "keep_int_field", "map_batches", "mape",
    "parse_delimited", "parse_with_rejects", "preview", "project_pair", "python_scorer", "register_view", "run_sql",
    "schema_report", "score_mllib", "score_python", "score_trees", "split_fields",
    "visit_partitions", "with_dense_index", "with_minutes", "with_observed_error", "with_seconds",
]
