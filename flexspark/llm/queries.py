"""All queries of the subpackage."""

import importlib

from flexspark.llm.registry import QUERIES, SQL

_MODULES = ["queries_native", "queries_pairs", "queries_search", "queries_text", "queries_vectors"]


def load_all():
    for m in _MODULES:
        importlib.import_module(f"flexspark.llm.{m}")
    return QUERIES, SQL
