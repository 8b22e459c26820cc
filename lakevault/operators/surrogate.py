"""Dense surrogate keys in business-key order, without a one-partition window over many rows.

``row_number() OVER (ORDER BY key) + max_id`` is the textbook expression, but
an un-partitioned window moves every row into one task.  Up to
``ROWS_PER_RANGE`` rows that is what runs.  More rows are dealt into key ranges,
sorted and numbered there, and stored with their place, all in one shuffle; then

1. a grouped count per range gives every range its starting offset, and
2. a row's id is its place in its range plus that offset: no second shuffle.

Range and place are stored with the row (in the shared checkpoint folder), so
a task that is run again after an executor loss reads the same numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakevault.sources.tables import materialize

_RANGE, _PLACE = "__range", "__place"

# Rows that one task numbers, about; the number of ranges has no ceiling.
ROWS_PER_RANGE = 200_000


def assign_surrogate_keys(
    df: DataFrame,
    order_cols: Sequence[str],
    id_col: str,
    start_after: int = 0,
    rows_per_range: int = ROWS_PER_RANGE,
    total: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = ``start_after + 1 ..`` densely, ordered by ``order_cols``.

    Equal to ``row_number() OVER (ORDER BY order_cols) + start_after`` for
    unique keys (NULL keys come first).  There are ``rows / rows_per_range``
    ranges, one at least.  Pass ``total`` when the row count is already known
    to skip the counting job; it only sets the number of ranges.
    """
    if not order_cols:
        raise ValueError("assign_surrogate_keys needs at least one order column")
    if total is None:
        total = df.count()
    order = [F.col(c).asc() for c in order_cols]
    ranges = max(1, math.ceil(total / rows_per_range))
    if ranges == 1:
        place = F.row_number().over(Window.orderBy(*order)).cast("long")
        return df.withColumn(id_col, place + F.lit(start_after))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # the number of the partition and, in the lower 33 bits, the place of the row in it
    stored = materialize(dealt.withColumn(_PLACE, F.monotonically_increasing_id()), "ranges", rebalance=False)
    stored = stored.withColumn(_RANGE, F.shiftright(_PLACE, 33))

    # rows in all lower ranges: a running sum over one row per range
    counts = stored.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_RANGE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    local = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    numbered = stored.join(offsets, on=_RANGE)
    return numbered.withColumn(id_col, local + F.col("__offset") + F.lit(start_after)).drop(_RANGE, _PLACE, "__offset")
