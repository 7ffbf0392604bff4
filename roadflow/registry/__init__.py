"""The registered queries, by name."""

from roadflow.registry import q_joins, q_marts, q_quality, q_records, q_reports, q_streams  # noqa: F401
from roadflow.registry.catalog import CHECKS, QUERIES  # noqa: F401
