"""Errors with codes and causes, and JSON-line logging."""

from __future__ import annotations

import json
import logging
import os
import re
import sys
from datetime import datetime, timezone


class LodestoneError(Exception):
    """An error whose code is its class name in upper snake case."""

    def __init__(self, message: str, metadata: dict | None = None):
        super().__init__(message)
        self.message, self.metadata = message, metadata or {}

    @property
    def code(self) -> str:
        """Such as EXTERNAL_SCHEMA for ExternalSchemaError."""
        return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", type(self).__name__.removesuffix("Error")).upper()

    def to_json(self) -> dict:
        """Code, message, metadata and the chain of causes."""
        return {"code": self.code, "message": self.message, "metadata": self.metadata, "causes": [str(c) for c in self.flatten()[1:]]}

    def flatten(self) -> list[BaseException]:
        """The error and its causes, outermost first."""
        out, e = [], self
        while e is not None and e not in out:
            out.append(e)
            e = e.__cause__
        return out


class ExternalSchemaError(LodestoneError):
    """A schema file that cannot be read."""


class FileOutputError(LodestoneError):
    """A sink that failed."""


class OutputConfigError(LodestoneError):
    """An output block that is not valid."""


class QuarantineError(LodestoneError):
    """Quarantine files that cannot be written."""


class RunConfigError(LodestoneError):
    """A configuration that is not valid."""


class JsonLines(logging.Formatter):
    """One JSON object a line: time, level, component, operation, message, context."""

    def format(self, record: logging.LogRecord) -> str:
        told = {
            "time": datetime.fromtimestamp(record.created, timezone.utc).isoformat(), "level": record.levelname.lower(), "component": record.name,
            "operation": getattr(record, "operation", record.funcName), "message": record.getMessage(), "context": getattr(record, "context", {}),
        }
        return json.dumps(told, default=str)


def logger(component: str) -> logging.Logger:
    """A logger of JSON lines; warnings and errors go to stderr, the level comes from LOG_LEVEL."""
    log = logging.getLogger(component)
    if not log.handlers:
        low, high = logging.StreamHandler(sys.stdout), logging.StreamHandler(sys.stderr)
        low.addFilter(lambda r: r.levelno < logging.WARNING)
        high.setLevel(logging.WARNING)
        for h in (low, high):
            h.setFormatter(JsonLines())
            log.addHandler(h)
        log.setLevel(os.environ.get("LOG_LEVEL", "INFO").upper())
        log.propagate = False
    return log
