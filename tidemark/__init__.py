"""Dataset, access-policy and project analytics on Spark DataFrames."""

from tidemark.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
