"""Customer churn and retention analytics on Spark DataFrames."""

from holdfast.session import build_session, materialise, shared_root

__all__ = ["build_session", "materialise", "shared_root"]
