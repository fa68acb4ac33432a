"""All registered queries and twins in one place."""

from __future__ import annotations

from quireflow.plans import features, models, prepare, retraining, storage, tracking

MODULES = (prepare, features, models, tracking, retraining, storage)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracles() -> dict:
    return {name: sql for module in MODULES for name, sql in module.oracles().items()}
