"""tidemill: analytics operators for tables and streams, written for Spark.

Every operator takes and returns DataFrames (or is a Structured Streaming job).
"""

from tidemill.session import build_session

__all__ = ["build_session"]
