"""Star-schema building and analysis operators for PySpark."""

from starloom.session import build_session, configure

__all__ = ["build_session", "configure"]
