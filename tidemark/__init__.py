"""tidemark: repeatable analytics over periodically captured JSON snapshots, on Spark."""

from .medallion import Layout, run
from .session import build_session

__all__ = ["Layout", "build_session", "run"]
