"""Import every query module so the registry is complete."""

from flowframe.plans import registry
from flowframe.plans import (  # noqa: F401  (imported for registration)
    q_flagship,
    q_table,
    q_clean,
    q_time,
    q_text,
    q_features,
    q_models,
    q_user,
)

REGISTRY = registry.REGISTRY


def queries():
    return {n: q.build for n, q in REGISTRY.items()}


def oracle_sql():
    return {n: q.sql for n, q in REGISTRY.items() if q.sql}
