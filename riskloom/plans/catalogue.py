"""All registered queries."""

from __future__ import annotations

from riskloom.plans import features, models, reports  # noqa: F401 - they register their queries
from riskloom.plans.registry import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    return dict(REGISTRY)
