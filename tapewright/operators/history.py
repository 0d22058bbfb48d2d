"""Questions about the job history, asked of a status table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def job_report(status: DataFrame, job_ids: Iterable[str]) -> DataFrame:
    """Status rows of the given jobs, oldest first."""
    return status.filter(F.col("job_id").isin(list(job_ids))).orderBy(
        "job_status_timestamp", "job_status_id"
    )


def recent_status(status: DataFrame, n: int = 100) -> DataFrame:
    """The latest ``n`` status rows, newest first."""
    return status.orderBy(F.desc("job_status_timestamp"), F.desc("job_status_id")).limit(n)


def first_status(status: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` status rows by id."""
    return status.orderBy("job_status_id").limit(n)
