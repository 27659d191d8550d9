"""Runnable queries over the test tables, one or more per operator."""

import importlib

from flexspark.examples.registry import QUERIES, SQL

_MODULES = ["projection", "rows", "choices", "storage", "flows"]


def load_all():
    for m in _MODULES:
        importlib.import_module(f"flexspark.examples.{m}")
    return QUERIES, SQL
