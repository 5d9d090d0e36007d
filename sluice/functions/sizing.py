"""Size checks before a broadcast.

A broadcast side must have a proven bound. Configuration frames (contracts)
are bounded by construction and are broadcast directly. Per-run metadata
frames (upload ids, file lists, sums per label) grow with the number of
uploads or labels, so their bytes are added up first, in one small job over a
frame that is already written, and the join is hinted only under the limit;
above it it is left to the planner (sort-merge, or AQE's own runtime broadcast
decision).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of rows, written out as text, above which a side is not hinted for broadcast.
MAX_BROADCAST_BYTES = 128 << 20


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if its rows take at most ``max_bytes``, else ``df``."""
    row = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    size = df.agg(F.sum(row)).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
