"""The two append-only tables as Structured Streaming queries."""

from .runs import RunSummary, bronze_stream, finish, quarantine_stream, silver_stream

__all__ = ["RunSummary", "bronze_stream", "finish", "quarantine_stream", "silver_stream"]
