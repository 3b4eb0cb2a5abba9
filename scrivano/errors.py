"""Errors with details."""

from __future__ import annotations


class ScrivanoError(Exception):
    def __init__(self, message: str, **details: object):
        super().__init__(message)
        self.message, self.details = message, details

    def to_dict(self) -> dict[str, object]:
        return {"error_type": type(self).__name__, "message": self.message, "details": self.details}


class ConfigError(ScrivanoError):
    pass


class SourceError(ScrivanoError):
    pass


class ExtractionError(ScrivanoError):
    pass


class ModelError(ScrivanoError):
    pass


class QuotaError(ModelError):
    pass


class AllModelsFailed(ModelError):
    pass
