"""All named queries; importing this package registers them."""

from tideline.workloads import windows, domains, behaviour, changes, synthetic, streams  # noqa: F401
from tideline.workloads.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
