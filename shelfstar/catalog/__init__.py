"""The registered queries over commerce tables, each with its equivalent SQL."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("reports", "star", "changes", "checks", "stored")


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLE")


def _merged(name: str) -> dict:
    merged = {}
    for family in FAMILIES:
        merged.update(getattr(import_module(f"shelfstar.catalog.{family}"), name))
    return merged
