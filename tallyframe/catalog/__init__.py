"""Every operator as a query over the driver tables, each beside its SQL twin."""

from . import clean_queries, era_queries, frame_queries, html_queries, ml_queries, profile_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
