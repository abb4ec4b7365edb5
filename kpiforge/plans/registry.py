"""KPI registry: ordered name -> builder (DataFrame function or SQL text)."""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kpiforge.operators import (categories, delay_satisfaction, freight_cost, lead_time, otd,
                                payments, perfect_order, volume_monthly)
from kpiforge.plans.sql_dialect import define_functions, to_spark
from kpiforge.session import apply_runtime_settings

# KPIs that come with the package as SQL text, as an example of such files
SQL_FOLDER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "sql")

Builder = Callable[[dict[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class KpiJob:
    name: str
    builder: Builder | None = None
    sql: str | None = None

    def build(self, spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
        if self.builder is not None:
            return self.builder(tables)
        return bind_sql(spark, self.sql, tables)


def bind_sql(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``sql``, written for PostgreSQL or Spark (``plans.sql_dialect`` says how its
    forms are read), with every ``raw.<table>`` outside of quotes and comments
    read from ``tables`` (a table that is not there raises KeyError)."""
    views: dict[str, str] = {}

    def view_of(name: str) -> str:
        if name not in views:
            views[name] = f"kpiforge_{uuid.uuid4().hex}"
            tables[name].createOrReplaceTempView(views[name])
        return views[name]

    apply_runtime_settings(spark)  # ANSI and exact decimals, which the reading of numeric relies on
    define_functions(spark)
    try:
        return spark.sql(to_spark(sql, view_of))
    finally:
        for v in views.values():  # the plan holds the tables, the names are not needed any more
            spark.catalog.dropTempView(v)


class Registry:
    """Adding a KPI is one ``register`` (a function of the raw tables) or one
    ``register_sql`` / ``register_sql_file`` / ``register_sql_folder`` (SQL for
    PostgreSQL or Spark reading ``raw.<table>``, which means the raw tables of
    the run, whatever their database is called)."""

    def __init__(self) -> None:
        self._jobs: OrderedDict[str, KpiJob] = OrderedDict()

    def register(self, name: str, builder: Builder) -> "Registry":
        self._jobs[name] = KpiJob(name, builder=builder)
        return self

    def register_sql(self, name: str, sql: str) -> "Registry":
        if "select" not in sql.lower():
            raise ValueError(f"{name}: SQL text has no SELECT")
        self._jobs[name] = KpiJob(name, sql=sql.strip().rstrip(";"))
        return self

    def register_sql_file(self, path: str, name: str | None = None) -> "Registry":
        """The SQL text of ``path`` (UTF-8); the KPI is named after the file."""
        with open(path, encoding="utf-8") as f:
            return self.register_sql(name or os.path.splitext(os.path.basename(path))[0], f.read())

    def register_sql_folder(self, path: str) -> "Registry":
        """Every ``*.sql`` file directly under ``path``, in the order of their names."""
        for name in sorted(n for n in os.listdir(path) if n.endswith(".sql")):
            self.register_sql_file(os.path.join(path, name))
        return self

    def names(self) -> list[str]:
        return list(self._jobs)

    def jobs(self) -> list[KpiJob]:
        return list(self._jobs.values())

    def __getitem__(self, name: str) -> KpiJob:
        return self._jobs[name]

    def __len__(self) -> int:
        return len(self._jobs)


# KPI table names, in run order.
DEFAULT_KPIS: tuple[tuple[str, Builder], ...] = (
    (otd.NAME, otd.build),
    (lead_time.NAME, lead_time.build),
    (perfect_order.NAME, perfect_order.build),
    (freight_cost.NAME, freight_cost.build),
    (delay_satisfaction.NAME, delay_satisfaction.build),
    (volume_monthly.NAME, volume_monthly.build),
    (categories.NAME, categories.build),
    (payments.NAME, payments.build),
)


def default_registry() -> Registry:
    reg = Registry()
    for name, builder in DEFAULT_KPIS:
        reg.register(name, builder)
    return reg
