"""Operators and plans bound to the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from importlib import import_module

MODULES = ["flagship", "resolution", "joining", "aggregation", "shaping", "cleaning", "output", "core_tables", "arp_tables", "submissions"]


def load():
    """Import every binding module; returns (queries, oracles)."""
    from tallyloom.bindings import registry

    for m in MODULES:
        import_module(f"tallyloom.bindings.{m}")
    return registry.QUERIES, registry.ORACLES
