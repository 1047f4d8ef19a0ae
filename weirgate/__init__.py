"""weirgate: metadata-driven data ingestion expressed as Spark DataFrame work."""

from weirgate.session import configure, scratch_path

__all__ = ["configure", "scratch_path"]
