"""Registered queries over the driver tables, each with the SQL it is checked against."""

from suite import inputs_sql  # noqa: F401, I001  (SQL fragments first: queries use them)
from suite import (  # noqa: F401
    q_sources, q_relational, q_rules, q_factors, q_incremental, q_streams, q_tests)
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
