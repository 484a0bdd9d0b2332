"""Spark-native retail analytics: landing files to bronze, silver, gold, marts and the queries over them."""

from tillflow.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
