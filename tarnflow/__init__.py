"""Hydrology observations as Spark DataFrame operations."""

from tarnflow.session import build_session

__all__ = ["build_session"]
