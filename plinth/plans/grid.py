"""Experiment lists on the driver: the full grid and the exploratory filter."""

from __future__ import annotations

from plinth.plans.cv import Experiment, iter_experiments
from plinth.spec import Spec

# Models the exploratory flow runs, and its two skip reasons.
EXPLORATORY_MODELS = ("ridge", "lasso", "elasticnet", "random_forest")
REASON_DISABLED = "disabled"
REASON_UNSUPPORTED = "skip here, too much noise for learning"


def grid(spec: Spec) -> list[Experiment]:
    """Every enabled model x each of its parameter sets."""
    return iter_experiments(spec)


def exploratory_models(spec: Spec) -> tuple[list[Experiment], list[tuple[str, str]]]:
    """First parameter set of each enabled supported model, and (model, reason) for the rest."""
    active, skipped = [], []
    for m in spec.models:
        if not m.enabled:
            skipped.append((m.name, REASON_DISABLED))
        elif m.name not in EXPLORATORY_MODELS:
            skipped.append((m.name, REASON_UNSUPPORTED))
        else:
            active.append(Experiment(m.name, tuple(m.grids[0]) if m.grids else ()))
    return active, skipped
