"""Transportation safety and asset analytics as Spark jobs."""

from carriageway.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
