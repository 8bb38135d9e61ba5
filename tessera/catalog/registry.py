"""Collects the registered queries and oracle SQL of every catalog module."""

from __future__ import annotations

import importlib

MODULES = ["series", "tabular", "text", "evaluation", "learning"]


def _mods():
    return [importlib.import_module(f"tessera.catalog.{m}") for m in MODULES]


def all_queries() -> dict:
    out: dict = {}
    for m in _mods():
        out.update(m.QUERIES)
    return out


def all_oracle() -> dict:
    out: dict = {}
    for m in _mods():
        out.update(m.ORACLE)
    return out
