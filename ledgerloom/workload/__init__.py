"""Registered queries.  ``load`` imports every q_* module once and returns the registry."""

from __future__ import annotations

import importlib
import pkgutil
from types import ModuleType


def load() -> ModuleType:
    for m in sorted(pkgutil.iter_modules(__path__), key=lambda m: m.name):
        if m.name.startswith("q_"):
            importlib.import_module(f"{__name__}.{m.name}")
    return importlib.import_module(f"{__name__}.registry")
