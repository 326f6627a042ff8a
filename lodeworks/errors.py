"""Typed errors raised by table operators and jobs.

The error codes and the keys of ``to_dict`` are fixed values: callers match on them.
"""

from __future__ import annotations

from typing import Any


class LakeError(Exception):
    """Base error: a message, a stable code and whatever context the raiser knows."""

    error_code = "UNKNOWN_ERROR"

    def __init__(self, message: str, **details: Any):
        super().__init__(message)
        self.message = message
        self.details = {k: v for k, v in details.items() if v is not None}

    def to_dict(self) -> dict[str, Any]:
        return {
            "error_type": type(self).__name__,
            "error_code": self.error_code,
            "message": self.message,
            "details": dict(self.details),
        }


class DataError(LakeError):
    """A dataset or table is missing, unreadable or in conflict (``source``, ``table``)."""

    error_code = "DATA_ERROR"


class ValidationError(DataError):
    """Data broke a rule (``column``, ``validation_rule``)."""

    error_code = "VALIDATION_ERROR"


class PipelineError(LakeError):
    """A job stage failed (``pipeline_name``, ``stage``)."""

    error_code = "PIPELINE_ERROR"
