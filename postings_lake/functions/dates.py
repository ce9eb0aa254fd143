"""Tolerant date parsing."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def posted_date(created: Column | str) -> Column:
    """Calendar date of an ISO-like timestamp string.

    Reads the date prefix before a ``T`` or a space and ignores the rest
    without shifting zones (``2026-06-01T23:30:00-05:00`` gives 2026-06-01);
    accepts ``yyyy``, ``yyyy-m`` and ``yyyy-m-d`` with surrounding spaces;
    anything unparseable becomes null instead of failing the job under ANSI.
    """
    c = F.col(created) if isinstance(created, str) else created
    return c.try_cast("date")

