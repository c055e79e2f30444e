"""The test tables in the shape of the raw logs, and every operator as a query over them."""

import importlib

from caselog.testbed.registry import ORACLES, QUERIES

for _module in ("columns", "operators", "landing", "models", "checks", "relations", "kept"):
    importlib.import_module(f"caselog.testbed.{_module}")

__all__ = ["ORACLES", "QUERIES"]
