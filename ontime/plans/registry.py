"""Query registry: key -> (Spark query over the supplied tables, DuckDB oracle SQL).

Every query reads the supplied Parquet tables through the test bed
(``ontime.sources.testbed``) and runs a library operator over the whole of them;
its oracle is an independent SQL formulation over the same tables (the test bed's
derivation text + hand-written SQL of the operator).  ``sql=None`` marks queries
that have no exact SQL form (model training, file ingest); those get a rows-only
check plus their own tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ontime.session import tuned

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    fn: QueryFn
    sql: str | None
    group: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, group: str) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query key {name}")
        REGISTRY[name] = Query(lambda spark, d: fn(tuned(spark), d), sql, group)
        return fn
    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from ontime.plans import queries_flights  # noqa: F401
    from ontime.plans import queries_geo  # noqa: F401
    from ontime.plans import queries_ml  # noqa: F401
    from ontime.plans import queries_io  # noqa: F401
    from ontime.plans import queries_tables  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: q.fn for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}
