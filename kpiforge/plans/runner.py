"""Batch runner: raw tables -> every registered KPI -> analytics tables."""

from __future__ import annotations

import logging
import math
import threading
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from kpiforge.operators import delay_satisfaction, freight_cost, lead_time, otd, perfect_order
from kpiforge.operators.facts import with_order_fact, with_review_fold
from kpiforge.plans.registry import Registry, default_registry
from kpiforge.session import apply_runtime_settings, cut_lineage, purge_scratch, size_for_tables
from kpiforge.sources.catalog import (ANALYTICS_DB, RAW_DB, ensure_databases, raw_tables,
                                      replace_table)
from kpiforge.sources.csv_ingest import ingest_directory

log = logging.getLogger(__name__)

# KPI builders that read the shared order fact when a run provides one
ORDER_FACT_READERS = (otd.build, lead_time.build, freight_cost.build)
# ... and those that read its join with the reviews per order
REVIEW_FOLD_READERS = (perfect_order.build, delay_satisfaction.build)

DEFAULT_PARALLELISM = 4
# after its time limit a KPI has this long to end once its jobs are cancelled
GRACE_SECONDS = 30.0


class MissingInput(KeyError):
    """A raw table that a KPI reads is not there."""


class Inputs(Mapping):
    """The raw tables of a run; asking for an absent one raises MissingInput,
    so that a KeyError inside a builder is not taken for a missing table."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._tables = tables

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise MissingInput(name)
        return self._tables[name]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


@dataclass
class RunReport:
    ingested: dict[str, int] = field(default_factory=dict)
    written: dict[str, int] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    # departures of the sources, by table (see ``csv_ingest.ingest_directory``)
    padded: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)
    kept_as_text: dict[str, list[str]] = field(default_factory=dict)
    kpi_seconds: dict[str, float] = field(default_factory=dict)
    seconds: float = 0.0

    @property
    def ok(self) -> bool:
        return not self.failed


def run_kpis(spark: SparkSession, registry: Registry | None = None,
             tables: dict[str, DataFrame] | None = None, out_db: str = ANALYTICS_DB,
             raw_db: str = RAW_DB, report: RunReport | None = None,
             parallelism: int = DEFAULT_PARALLELISM,
             share_order_fact: bool = True, purge: bool = True,
             size_shuffles: bool = True, kpi_seconds: float | None = None) -> RunReport:
    """Build and write every KPI of the registry (each table switches to its
    new content in one catalog operation, see ``catalog.replace_table``). A
    KPI that fails (while
    planning or while writing - plans are lazy, errors surface at the write) is
    recorded and the others still run.

    KPIs are independent, so up to ``parallelism`` of them are submitted at
    once from driver threads; Spark interleaves their stages on the executors
    (set ``spark.scheduler.mode=FAIR`` to share them evenly). Results do not
    depend on the order or concurrency of the runs.

    With ``share_order_fact`` the delivered-order fact (orders joined with the
    customers' states, derived flags and durations) is materialised once in
    the checkpoint folder and read by every state-level KPI, instead of each
    of them joining orders with customers again; so is the fold of the reviews
    per order that two KPIs read.

    With ``kpi_seconds`` a KPI that takes longer is stopped (its Spark jobs are
    cancelled by their tag, again for as long as it starts new ones) and recorded
    as failed. One that hangs outside of Spark's jobs is left behind after
    ``GRACE_SECONDS`` more, so that the run always ends.

    With ``size_shuffles`` the session's shuffles are sized from the raw tables
    (never below what is set). With ``purge`` the intermediates this
    application materialised in the checkpoint folder are deleted once every
    KPI table is written.
    """
    registry = registry or default_registry()
    report = report or RunReport()
    ensure_databases(spark, raw_db, out_db)
    apply_runtime_settings(spark)
    if tables is None:
        tables = raw_tables(spark, raw_db)
    if size_shuffles:
        size_for_tables(spark, tables.values())
    tables = Inputs(tables)
    builders = [j.builder for j in registry.jobs()]
    if share_order_fact:
        for readers, share in ((ORDER_FACT_READERS, with_order_fact), (REVIEW_FOLD_READERS, with_review_fold)):
            if sum(b in readers for b in builders) > 1:
                try:
                    tables = Inputs(share(tables, cut_lineage))
                except MissingInput as e:  # the KPIs report it
                    log.warning("shared input not built: missing %s", e)

    run_id = uuid.uuid4().hex[:8]
    started: dict[str, float] = {}
    stopped: set[str] = set()

    def tag(job):
        return f"kpiforge-{run_id}-{job.name}".replace(",", "_")

    def one(job):
        started[job.name] = t0 = time.perf_counter()
        # each KPI's jobs go to their own scheduler pool, so concurrent KPIs
        # share the executors instead of queueing behind the first one
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"kpi_{job.name}")
        spark.sparkContext.addJobTag(tag(job))
        try:
            rows, err = replace_table(job.build(spark, tables), out_db, job.name), None
        except MissingInput as e:
            log.error("KPI %s failed: missing input table %s", job.name, e)
            rows, err = None, f"missing input table {e.args[0]}"
        except Exception as e:  # isolate one KPI's failure
            rows, err = None, f"{type(e).__name__}: {e}".splitlines()[0][:500]
            if job.name in stopped:
                err = f"stopped after {kpi_seconds:g} s"
            log.error("KPI %s failed: %s", job.name, err)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
            spark.sparkContext.removeJobTag(tag(job))
        return job.name, rows, err, time.perf_counter() - t0

    jobs = registry.jobs()
    done: dict[str, tuple] = {}
    left: set[str] = set()
    slots = threading.Semaphore(max(1, parallelism))

    def worker(job):
        slots.acquire()
        try:
            done[job.name] = one(job)
        finally:
            if job.name not in left:  # else its slot is given on already
                slots.release()

    # daemon threads: one that hangs must not keep the process
    threads = {job.name: threading.Thread(target=worker, args=(job,), daemon=True) for job in jobs}
    for t in threads.values():
        t.start()
    while waiting := [j for j in jobs if threads[j.name].is_alive() and j.name not in left]:
        threads[waiting[0].name].join(0.2 if kpi_seconds else None)
        for j in waiting if kpi_seconds else ():
            over = time.perf_counter() - started.get(j.name, math.inf) - kpi_seconds
            if over > 0 and threads[j.name].is_alive():
                stopped.add(j.name)
                spark.sparkContext.cancelJobsWithTag(tag(j))
                if over > GRACE_SECONDS:
                    log.error("KPI %s hangs outside of Spark's jobs and is left behind", j.name)
                    left.add(j.name)
                    slots.release()
    if purge and not left:
        purge_scratch(spark)
    results = [(j.name, None, f"stopped after {kpi_seconds:g} s, still hanging", kpi_seconds + GRACE_SECONDS)
               if j.name in left else done[j.name] for j in jobs]
    for name, rows, err, sec in results:  # registry order
        report.kpi_seconds[name] = round(sec, 3)
        if err is None:
            report.written[name] = rows
        else:
            report.failed[name] = err
    return report


def run_all(spark: SparkSession, data_dir: str, registry: Registry | None = None,
            raw_db: str = RAW_DB, out_db: str = ANALYTICS_DB,
            parallelism: int = DEFAULT_PARALLELISM, purge: bool = True,
            size_shuffles: bool = True, mode: str = "padded",
            kpi_seconds: float | None = None) -> RunReport:
    """Ingest every CSV of ``data_dir`` into ``raw_db`` (``mode``: what rows and
    values that do not fit may do, see ``ingest_directory``), then compute all
    KPIs (see ``run_kpis``)."""
    t0 = time.perf_counter()
    loaded = ingest_directory(spark, data_dir, raw_db, mode, parallelism=parallelism)
    report = RunReport(ingested=dict(loaded), padded=loaded.padded, rejected=loaded.rejected,
                       kept_as_text=loaded.kept_as_text)
    run_kpis(spark, registry, out_db=out_db, raw_db=raw_db, report=report,
             parallelism=parallelism, purge=purge, size_shuffles=size_shuffles, kpi_seconds=kpi_seconds)
    report.seconds = time.perf_counter() - t0
    return report
