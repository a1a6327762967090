"""Model graph (lazy, materialisable) and sinks."""

from tallyspark.plans.models import SHARED_MODELS, ModelSet

__all__ = ["SHARED_MODELS", "ModelSet"]
