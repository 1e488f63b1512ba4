from scoreflow.plans.batch_score import score, score_indexed_lines, score_lines
from scoreflow.plans.payloads import decode_images, image_pixels, payload_bytes, payload_text
from scoreflow.plans.people_sql import export_people, people, query_people
from scoreflow.plans.stream_score import (
    named_pairs,
    publish_minutes,
    score_keyed_stream,
    score_keyed_with_rejects,
    score_stream,
)

__all__ = [
    "decode_images", "export_people", "image_pixels", "named_pairs", "payload_bytes",
    "payload_text", "people", "publish_minutes", "query_people", "score", "score_indexed_lines",
    "score_keyed_stream", "score_keyed_with_rejects", "score_lines", "score_stream",
]
