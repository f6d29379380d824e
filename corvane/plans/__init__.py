"""Registered queries over the given tables."""

from __future__ import annotations

import importlib
import pkgutil


def load():
    """Import every plan module and return (plans, SQL twins) by query name."""
    from corvane.plans import registry

    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return registry.PLANS, registry.TWINS
