"""Importing this package fills the plan registry."""

from bramble.plans import (aggregation, closedform, concepts, evaluation, features, patterns,  # noqa: F401
                           preparation, similarity, sources, training)
from bramble.plans.registry import PLANS, Plan, Tables  # noqa: F401
