"""Epoch-millisecond <-> zone-less timestamp conversions.

Layer dates are epoch milliseconds with no zone. They become
``timestamp_ntz`` by adding milliseconds to the zone-less epoch, which does
not depend on the session time zone (``timestamp_millis`` would).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def ms_to_ntz(ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms, F.lit(_EPOCH).cast("timestamp_ntz"))


def ntz_to_ms(ts: Column) -> Column:
    """Milliseconds since the epoch, truncating sub-millisecond digits."""
    return F.timestamp_diff("MILLISECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts)
