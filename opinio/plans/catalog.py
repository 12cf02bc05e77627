"""Import every query module so that the registry is complete."""

from opinio.plans import q_analytics, q_feed, q_io, q_labels, q_replies, q_report, q_stream  # noqa: F401
from opinio.plans.registry import QUERIES

__all__ = ["QUERIES"]
