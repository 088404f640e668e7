"""Every query by name: the Spark form and, where one exists, the SQL it must equal."""

from __future__ import annotations

import importlib

from clickweave.catalog.registry import REGISTRY, Query

MODULES = ("scans", "clicks", "windows", "times", "sampling", "features", "vectors", "tower")


def load() -> dict[str, Query]:
    for name in MODULES:
        importlib.import_module(f"clickweave.catalog.{name}")
    return dict(REGISTRY)
