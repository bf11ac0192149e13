"""Ledgers: runs by day and name, and the files already taken in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

RUN_KEY = ["dt", "pipeline"]


def new_runs(runs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Runs not in the ledger yet, each once. Null keys are no keys and are dropped."""
    keyed = runs.select(*RUN_KEY).dropna().dropDuplicates(RUN_KEY)
    return keyed if ledger is None else keyed.join(ledger.select(*RUN_KEY), RUN_KEY, "left_anti")


def processed_entries(files: DataFrame, run_date: Column) -> DataFrame:
    return files.select("path").distinct().withColumn("run_date", run_date)
