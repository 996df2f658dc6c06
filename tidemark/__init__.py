"""tidemark: change-captured commerce data as Spark DataFrame jobs."""

from tidemark.session import build_session, shared_dir, tune

__all__ = ["build_session", "shared_dir", "tune"]
