"""Structured Streaming forms of the gates and appliers."""

from rivulet.streaming.apply import (
    apply_documents_stream,
    apply_rows_stream,
    apply_tables_stream,
)
from rivulet.streaming.gate import gate_stream
from rivulet.streaming.rejects import RejectStore
from rivulet.streaming.store import BatchStore, drain

__all__ = [
    "BatchStore",
    "RejectStore",
    "apply_documents_stream",
    "apply_rows_stream",
    "apply_tables_stream",
    "drain",
    "gate_stream",
]
