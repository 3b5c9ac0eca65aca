"""Timestamps as ISO-8601 UTC text with second precision."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

# --- fixed values: text formats ---
ISO_FORMAT = "%Y-%m-%dT%H:%M:%SZ"
RUN_ID_FORMAT = "%Y%m%dT%H%M%SZ"
# --- end of fixed values ---

_FIRST_SECOND = -62135596800  # 0001-01-01T00:00:00Z
_LAST_SECOND = 253402300799  # 9999-12-31T23:59:59Z


def iso_utc(moment: datetime | None = None) -> str:
    return (moment or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime(ISO_FORMAT)


def run_id_for(moment: datetime | None = None) -> str:
    return (moment or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime(RUN_ID_FORMAT)


def epoch_to_iso(value: Column | str) -> Column:
    """Epoch seconds (number or numeric text) to ISO text; anything else is blank."""
    column = F.col(value) if isinstance(value, str) else value
    number = column.try_cast("double")
    seconds = F.floor(number)
    usable = number.isNotNull() & ~F.isnan(number) & number.between(float(_FIRST_SECOND), float(_LAST_SECOND))
    stamp = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(usable, stamp).otherwise(F.lit(""))
