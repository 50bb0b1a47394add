"""All registered queries, by name."""

from padronix.plans.catalog import (
    cleaning,
    clustering,
    distribution,
    evaluation,
    modelling,
    proofs,
    quality,
    registry,
    sampling,
    stats,
)
from padronix.plans.catalog.base import QUERIES, Query

__all__ = [
    "QUERIES",
    "Query",
    "cleaning",
    "clustering",
    "distribution",
    "evaluation",
    "modelling",
    "proofs",
    "quality",
    "registry",
    "sampling",
    "stats",
]
