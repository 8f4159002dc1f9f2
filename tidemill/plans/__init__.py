"""Registered queries: every operator applied to the shared tables, with its SQL twin."""

from tidemill.plans import (  # noqa: F401
    aggregates,
    analytics,
    joins,
    models,
    projections,
    scalars,
    sinks,
    streams,
    windows,
)
from tidemill.plans.registry import oracles, registered

__all__ = ["oracles", "registered"]
