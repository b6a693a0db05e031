"""Points in time as literals that depend on no machine's time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(at: datetime) -> Column:
    """Timestamp literal; a time without a zone is UTC, as everywhere in this package.

    A plain literal would be read in the local zone of the driver.
    """
    if at.tzinfo is None:
        at = at.replace(tzinfo=timezone.utc)
    return F.lit(at.isoformat()).cast("timestamp")


def naive_utc(at: datetime) -> datetime:
    return at if at.tzinfo is None else at.astimezone(timezone.utc).replace(tzinfo=None)
