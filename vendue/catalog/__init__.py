"""Registered queries over the test tables and the same queries in SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ["ranks", "events", "search", "recommend", "basics", "state"]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"vendue.catalog.{name}"), attribute)
        clash = out.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(part)
    return out


def all_queries() -> dict:
    return _merged("QUERIES")


def all_sql() -> dict:
    return _merged("SQL")
