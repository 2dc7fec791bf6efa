"""Event ingestion and analytics on Spark: DataFrames in, DataFrames out."""

from eventmart.session import configure, scratch_path

__all__ = ["configure", "scratch_path"]
