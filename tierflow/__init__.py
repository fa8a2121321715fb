"""tierflow: a Spark-native medallion pipeline and data-quality engine.

Layers: bronze (verbatim strings + lineage), silver (typed, deduplicated,
conformed), quarantine (rows failing error rules, with reasons), gold (star
schema and KPI marts, and SQL model files); reconciliation checks across layers.

The main entry points are importable from the package (resolved lazily):

    from tierflow import get_spark, TableStore, run_daily, bank_config
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_EXPORTS = {
    "get_spark": "tierflow.session",
    "TableStore": "tierflow.sinks.store",
    "compile_rules": "tierflow.operators.rules",
    "report": "tierflow.operators.rules",
    "samples": "tierflow.operators.rules",
    "Spec": "tierflow.operators.rules",
    "split": "tierflow.operators.quarantine",
    "cascade": "tierflow.operators.quarantine",
    "latest_per_key": "tierflow.operators.dedupe",
    "convert": "tierflow.operators.fx",
    "verdict": "tierflow.operators.reconcile",
    "run_daily": "tierflow.plans.job",
    "bank_config": "tierflow.plans.job",
    "evaluate_table": "tierflow.plans.job",
    "quarantine_failures": "tierflow.plans.job",
    "ingest_file": "tierflow.plans.bronze",
    "ingest_source": "tierflow.plans.bronze",
    "stream_bronze": "tierflow.streaming.bronze_stream",
    "stream_upsert": "tierflow.streaming.bronze_stream",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'tierflow' has no attribute {name!r}")
