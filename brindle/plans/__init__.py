"""All registered queries by name, with the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

from brindle.plans.base import Catalog, Plan

_MODULES = ["grouped_plans", "ranking_plans", "payload_plans", "text_plans", "source_plans", "retrieval_plans", "generation_plans", "rubric_plans", "lineage_plans", "modelling_plans", "streaming_plans"]


def registered() -> Catalog:
    merged = Catalog()
    for name in _MODULES:
        part = import_module(f"brindle.plans.{name}").catalog
        for key, plan in part.plans.items():
            merged.add(key, part.oracles.get(key))(plan)
    return merged


__all__ = ["Catalog", "Plan", "registered"]
