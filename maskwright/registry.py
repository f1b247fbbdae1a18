"""All queries of the engine and their DuckDB counterparts."""

from __future__ import annotations

from importlib import import_module

MODULES = ["plans.ledger", "plans.export", "plans.release", "functions.geometry", "functions.text", "functions.masks", "functions.wide", "operators.suppress", "operators.audit", "operators.spans", "operators.canonical", "operators.taxonomy", "functions.jsonx", "operators.incremental", "operators.selection", "operators.records", "operators.providers", "operators.validate", "operators.publisher", "operators.campaign", "operators.captions", "operators.nouns", "plans.reports", "plans.runner", "streaming.logs"]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in import_module(f"maskwright.{m}").QUERIES.items()}


def oracles() -> dict:
    return {k: f for m in MODULES for k, f in import_module(f"maskwright.{m}").ORACLES.items()}
