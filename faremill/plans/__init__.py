"""Registered queries, each next to the SQL that checks it."""

import importlib

MODULES = ("ingest", "places", "conditions", "reports", "assessment", "modelling", "feeds")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        importlib.import_module(f"faremill.plans.{name}")
