from scoreflow.models.shared import MAX_MODEL_BYTES, broadcast_model
from scoreflow.models.trees import TreeEnsemble

__all__ = ["MAX_MODEL_BYTES", "TreeEnsemble", "broadcast_model"]
