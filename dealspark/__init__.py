"""dealspark: saved product-deal searches expressed as Spark DataFrame plans."""

from dealspark.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
