"""Registered queries: each runs the library over the given tables."""

from . import exports, fields, joins, logs, pages, resolving, sequences, streams  # noqa: F401
from .base import REGISTRY

__all__ = ["REGISTRY"]
