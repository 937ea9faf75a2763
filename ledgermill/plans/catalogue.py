"""All registered queries. Importing the query modules fills the register."""

from __future__ import annotations

import importlib

from ledgermill.plans.registry import ORACLES, QUERIES, Query

MODULES = ("queries_mart", "queries_docs", "queries_review", "queries_flow", "queries_prim", "queries_learn",
           "queries_trade", "queries_stream", "queries_html")

for _module in MODULES:
    importlib.import_module(f"ledgermill.plans.{_module}")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
