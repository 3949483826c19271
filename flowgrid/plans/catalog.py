"""Imports every query module and exposes the registry."""

from __future__ import annotations

from flowgrid.plans import q_mobility  # noqa: F401
from flowgrid.plans.registry import REGISTRY


def _load_all():
    import importlib
    import pkgutil

    import flowgrid.plans as pkg

    for m in pkgutil.iter_modules(pkg.__path__):
        if m.name.startswith("q_"):
            importlib.import_module(f"flowgrid.plans.{m.name}")


_load_all()


def queries():
    return {k: e.fn for k, e in REGISTRY.items()}


def oracle_sql():
    return {k: e.sql for k, e in REGISTRY.items() if e.sql is not None}
