"""kpiforge: order-logistics KPIs as Spark DataFrame jobs.

Layers:
  sources/    raw inputs (CSV ingestion, catalog tables, driver-table adapters)
  functions/  Column-expression helpers (rounding, durations, bands, labels)
  operators/  the eight KPI builders, a distributed exact percentile and the
              second-level metrics computed over KPI tables
  plans/      KPI registry and the batch runner (ingest -> KPIs -> sinks)
  llm/        operators of a training-data pipeline (optional, on its own)
"""

__version__ = "0.1.0"
