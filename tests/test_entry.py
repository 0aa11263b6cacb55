"""The entry module without the training-data folder, or without a library that folder needs."""

from __future__ import annotations

import importlib
import sys

import pytest

import __spark_entry__ as entry
from shelfstar.catalog import all_oracles, all_queries


class Hidden:
    """Finds nothing under the given names."""

    def __init__(self, *names):
        self.names = names

    def find_spec(self, name, path=None, target=None):
        if any(name == n or name.startswith(f"{n}.") for n in self.names):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


@pytest.mark.parametrize("hidden", ["shelfstar.llm", "xxhash", "sentencepiece"])
def test_warehouse_queries_need_nothing_else(monkeypatch, hidden):
    for name in [n for n in sys.modules if n.startswith("shelfstar.llm") or n == "corpus_pipeline" or n == hidden]:
        monkeypatch.delitem(sys.modules, name)
    if "shelfstar.llm" in vars(importlib.import_module("shelfstar")):
        monkeypatch.delattr("shelfstar.llm")
    monkeypatch.setattr(sys, "meta_path", [Hidden(hidden), *sys.meta_path])
    assert set(all_queries()) <= set(entry.queries())
    assert set(all_oracles()) <= set(entry.oracle_sql())
    if hidden != "sentencepiece":
        assert set(entry.queries()) == set(all_queries())
