"""All registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("features", "identity", "partner", "scrub", "cleaning", "lenders", "files", "stored")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        merged |= getattr(import_module(f"leadforge.catalog.{name}"), attribute)
    return merged


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _merged("QUERIES")


def oracles() -> dict[str, str]:
    return _merged("ORACLES")
