"""Submission loading and delta engine on PySpark DataFrames."""

from tabload.session import build_session

__all__ = ["build_session"]
