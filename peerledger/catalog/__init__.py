"""Registered queries over the test tables and their SQL twins."""

from peerledger.catalog import feature_queries, model_queries  # noqa: F401
from peerledger.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
