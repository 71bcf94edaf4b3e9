"""All registered queries."""

from __future__ import annotations

from evalspark.plans import agents, converters, reports, responses, results, storage, validation  # noqa: F401
from evalspark.plans.registry import ORACLES, QUERIES

FLAGSHIP = "flagship_leaderboard"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
