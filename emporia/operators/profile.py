"""DataFrame profiling: column list, row count, NULL counts, preview.

``profile`` is a one-row frame from one aggregate pass (partial counts map-side).
``observed`` takes the same counts from rows on their way to a table, by an
``Observation``, so that profiling a job's output reads nothing twice.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

PREVIEW_ROWS = 5


def _counts(df: DataFrame) -> list[Column]:
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in df.columns]
    return [F.count(F.lit(1)).alias("row_count"), *nulls]


def profile(df: DataFrame) -> DataFrame:
    """One-row summary: ``row_count``, ``column_count`` and ``nulls_<col>`` per column."""
    return df.agg(*_counts(df)).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        *[F.col(f"`nulls_{c}`") for c in df.columns],
    )


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with an observation that holds its counts once an action has run over it."""
    seen = Observation()
    return df.observe(seen, *_counts(df)), seen


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` rows (a limit, so only as many rows as needed are read)."""
    return df.limit(n)


def log_observed(seen: Observation, written: DataFrame, logger: logging.Logger) -> None:
    """Log what was observed while ``written`` was written, and its first rows; failures only warn."""
    try:
        counts = dict(seen.get)
        rows = counts.pop("row_count")
        report = {
            f"columns ({len(written.columns)})": ", ".join(written.columns),
            "row count": f"{rows:,}",
            "null counts": {name.removeprefix("nulls_"): n for name, n in counts.items()},
        }
        report |= {f"row {i + 1}": row for i, row in enumerate(preview(written).collect())}
        for name, value in report.items():
            logger.debug("%s: %s", name, value)
    except Exception as exc:  # profiling must never fail a job
        logger.warning("profiling failed: %s", exc)
