"""Lineage stamps and the run manifest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Run:
    """What identifies a run. The caller supplies it, so a re-run can repeat it."""

    run_id: str
    ingested_at: str
    version: str = "1.0.0"
    environment: str = "dev"
    sources: Sequence[str] = field(default_factory=tuple)


def lineage_columns(run: Run, layer: str) -> dict[str, Column]:
    sources = [F.lit(s) for s in run.sources]
    return {
        "layer": F.lit(layer),
        "version": F.lit(run.version),
        "run_id": F.lit(run.run_id),
        "environment": F.lit(run.environment),
        "sources": F.array(*sources).cast("array<string>"),
        "ingested_at": F.lit(run.ingested_at).cast("timestamp"),
    }


def stamp_lineage(df: DataFrame, run: Run, layer: str) -> DataFrame:
    """Add the lineage columns; the data columns stay as they came."""
    return df.withColumns(lineage_columns(run, layer))


def run_manifest(audit: DataFrame, run: Run, layer: str, rejections: bool = False) -> DataFrame:
    """One row per snapshot: lineage and totals of the run, from its audit."""
    rejected = ("n_missing_key", "n_duplicate", "n_lookup_failed") if rejections else ()
    if rejections and "n_unreadable" in audit.columns:
        rejected = ("n_unreadable", *rejected)
    totals = audit.select(
        "snapshot_date",
        F.col("n_received").alias("n_offers_received"),
        *rejected,
        F.col("n_accepted").alias("n_items_processed"),
        F.col("n_accepted").alias("n_records"),
    )
    return stamp_lineage(totals, run, layer)
