"""Every query of the engine's own operators by name, with its SQL."""

from __future__ import annotations

from kinelake.plans import q_catalog, q_rules, q_sources


def _all() -> dict:
    return q_rules.QUERIES | q_catalog.QUERIES | q_sources.QUERIES


def queries() -> dict:
    return {name: q[0] for name, q in _all().items()}


def oracles() -> dict:
    return {name: q[1] for name, q in _all().items() if q[1]}
