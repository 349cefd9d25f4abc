"""Fold document change logs into flat current-state reports with Spark DataFrames."""

from foldlog.session import configure
from foldlog.staging import staged_tables

__all__ = ["configure", "staged_tables"]
