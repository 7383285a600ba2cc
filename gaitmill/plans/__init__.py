"""Bindings of the operators to concrete tables."""

from gaitmill.plans import (
    balancing,
    checking,
    cleaning,
    discovering,
    distributions,
    landscape,
    measuring,
    posing,
    washing,
)
from gaitmill.plans.registry import REGISTRY

__all__ = [
    "REGISTRY",
    "balancing",
    "checking",
    "cleaning",
    "discovering",
    "distributions",
    "landscape",
    "measuring",
    "posing",
    "washing",
]
