"""Registered queries over the test tables."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("storage", "preparation", "profiling", "evaluation", "texts", "modeling")


def load():
    """Import all query modules and return the registry."""
    for m in _MODULES:
        import_module(f"reachmark.plans.{m}")
    return import_module("reachmark.plans.registry")
