"""Medallion-lake operators for PySpark: clean, conform, model, measure, check, stream.

Every public operator is a plain ``DataFrame -> DataFrame`` function; Catalyst, AQE and
Structured Streaming do the planning and the execution.
"""

from assaymill.session import build_session

__all__ = ["build_session"]
