"""Joins against small, bounded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest table (in rows) the library broadcasts on a known bound. The tables it
# is used for have narrow rows (a few ids and offsets), so this is tens of MB.
MAX_BROADCAST_ROWS = 1_000_000


def join_bounded(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    small_rows: int | None = None,
    limit: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join ``big`` with ``small``, broadcasting ``small`` only when its row
    count is known to be at most ``limit``.

    ``small_rows`` is an upper bound the caller has established (a measured
    count, or a count that follows from how ``small`` is built). Without one, or
    beyond the limit, the join is left to the planner: AQE still turns it into a
    broadcast at run time if the materialised side is small, and otherwise a
    shuffle join with skew splitting runs.
    """
    if small_rows is not None and small_rows <= limit:
        small = F.broadcast(small)
    return big.join(small, list(on), how)
