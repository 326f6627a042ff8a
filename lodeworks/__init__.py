"""Spark-native lakehouse ingest, quality and upsert library."""

from lodeworks.errors import DataError, LakeError, PipelineError, ValidationError
from lodeworks.layout import LakeLayout

__all__ = ["DataError", "LakeError", "LakeLayout", "PipelineError", "ValidationError"]
