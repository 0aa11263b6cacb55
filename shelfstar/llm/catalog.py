"""The registered queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "pieces",
    "sharding",
    "chat",
    "substrings",
    "urls",
    "pii",
    "decontaminate",
    "quality",
    "suffixes",
    "simhash",
    "alignment",
    "sketches",
    "whitening",
)


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLE")


def _merged(name: str) -> dict:
    merged = {}
    for module in MODULES:
        merged.update(getattr(import_module(f"shelfstar.llm.{module}"), name))
    return merged
