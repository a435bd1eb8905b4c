"""Registry of the queries bound to the driver's testdata tables.

Every entry is ``name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
A ``None`` SQL marks an operator that SQL cannot express (model fits, sampling with
interpolation); the driver then checks rows only, and a test checks invariants.
"""

from __future__ import annotations

import importlib

_MODULES = ("columns", "relational", "aggregates", "selection", "composed", "models")


def registry() -> dict:
    out: dict = {}
    for m in _MODULES:
        try:
            mod = importlib.import_module(f"{__name__}.{m}")
        except ModuleNotFoundError as e:
            if e.name == f"{__name__}.{m}":
                continue
            raise
        out.update(mod.Q)
    return out
