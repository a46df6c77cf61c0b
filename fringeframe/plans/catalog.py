"""All registered queries."""

from __future__ import annotations

import importlib

from . import registry

MODULES = ["select_queries", "flag_queries", "calibration_queries", "match_queries", "image_queries", "spectral_queries", "stream_queries"]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"{__package__}.{name}")


def queries():
    _load()
    return dict(registry.QUERIES)


def oracle_sql():
    _load()
    return dict(registry.ORACLES)
