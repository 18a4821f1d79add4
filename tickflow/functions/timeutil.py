"""Timestamp literals that do not depend on the Python process's time zone.

``F.lit(datetime)`` converts a naive Python datetime to an instant with the
*driver process's* local zone, so the same literal means different instants
on differently configured machines. Literals are passed to Spark as text
instead and cast in the session zone, like every other zone-less value here.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ts_text(value) -> str | None:
    """``YYYY-MM-DD HH:MM:SS[.ffffff]`` text of a datetime / date / string (aware -> UTC)."""
    if value is None:
        return None
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return value.isoformat(sep=" ")
    if isinstance(value, _dt.date):
        return value.isoformat()
    return str(value)


def ts_lit(value, data_type: T.DataType | str = "timestamp_ntz") -> Column:
    """A timestamp (or date) literal of ``data_type`` built from text."""
    return F.lit(ts_text(value)).cast(data_type)
