"""Composed flows, the registered query catalogue and its SQL oracle."""

from farecast.plans.flows import (
    bronze_from_events,
    load_month,
    materialized_flow,
    score_flow,
    train_flow,
    training_split,
)

__all__ = ["bronze_from_events", "load_month", "materialized_flow", "score_flow", "train_flow", "training_split"]
