"""Named queries over the given tables, each with an independent SQL check."""

from __future__ import annotations

import importlib

from .base import ORACLES, QUERIES

for _part in ("etl", "modeling", "serving"):
    importlib.import_module(f"{__name__}.{_part}")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
