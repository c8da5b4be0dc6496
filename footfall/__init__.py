"""footfall: user-behaviour analytics (area Top-N, ad-click streaming,
session statistics, wide-column export) expressed as Spark DataFrame jobs."""

from footfall.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
