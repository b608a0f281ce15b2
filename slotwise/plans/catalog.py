"""Registered queries: one per operator of the inventory, each with its oracle.

Every query takes ``(spark, sf_dir)``, reads the fleet fixtures derived from
the tables in ``sf_dir`` and returns a DataFrame.  ``ORACLES`` holds the same
question in plain SQL for DuckDB (fixture CTEs are prefixed automatically);
queries without an oracle are checked against their batch twin in tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slotwise.sources.fixtures import Fleet, oracle_with

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
_ORACLE_BODIES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(fleet) -> DataFrame`` as query ``name``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Fleet(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            _ORACLE_BODIES[name] = oracle
        return fn
    return deco


def oracles() -> dict[str, str]:
    return {k: oracle_with(v) for k, v in _ORACLE_BODIES.items()}


def oracle_bodies() -> dict[str, str]:
    """Oracle SQL without the fixture CTEs (for engines that have the fixture
    tables registered already)."""
    return dict(_ORACLE_BODIES)


MODULES = ("q_topology", "q_integrity", "q_boot", "q_commands", "q_config", "q_lifecycle",
           "q_slots", "q_pipelines", "q_streams")


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for m in MODULES:
        importlib.import_module(f"slotwise.plans.{m}")
