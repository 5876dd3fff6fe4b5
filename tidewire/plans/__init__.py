"""Registered queries and the SQL that checks them."""

from tidewire.plans import checks, extensions, inventory, records, streams, throughput  # noqa: F401  (each registers its queries)
from tidewire.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
