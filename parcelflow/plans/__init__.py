"""All registered queries."""

import importlib

from parcelflow.plans.registry import ORACLES, RUNNERS

for _name in ("flagship", "sources", "filters", "texts", "numbers", "joins", "aggregates", "windows", "events", "forecasts", "models", "stages"):
    importlib.import_module(f"parcelflow.plans.{_name}")

__all__ = ["ORACLES", "RUNNERS"]
