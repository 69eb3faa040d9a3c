"""Imports every catalog module so that all queries are registered."""

from __future__ import annotations

import importlib

from . import catalog

MODULES = ["q_profile", "q_prep", "q_assoc", "q_eval", "q_ml"]


def _load():
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")


def queries():
    _load()
    return dict(catalog.QUERIES)


def oracle_sql():
    _load()
    return dict(catalog.ORACLE)


def headline():
    _load()
    return list(catalog.HEADLINE)
