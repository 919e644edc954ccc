"""Keep-the-last reduction with an explicit order.

"Last of two values" depends on arrival order, which a shuffle does not keep;
the order is therefore a column (or columns) and the reduction is ``max_by``,
which aggregates partially on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_by(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], alias: str | None = None) -> DataFrame:
    """``(keys..., value)``: the value of the greatest ``order`` per key."""
    order_col = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return df.groupBy(*keys).agg(F.max_by(value, order_col).alias(alias or value))
