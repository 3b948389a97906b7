"""Registered queries: each operator on the test tables, with the same result stated in plain SQL."""

import importlib
import pkgutil

from tidemark.catalog.base import REGISTRY, Query, Tables

__all__ = ["REGISTRY", "Query", "Tables", "load_all"]


def load_all() -> dict[str, Query]:
    """Import every catalogue module and return the filled registry."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return REGISTRY
