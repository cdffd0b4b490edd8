"""The row before, per key, without sorting a whole key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.timeline import BLOCK, block_of


def with_previous(
    rows: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    block: int,
    pos: str = "pos",
    tie: str = "event_id",
    name: str = "prev",
) -> DataFrame:
    """Add ``name``: a struct of ``fields`` of the preceding row of the same keys in (pos, tie) order.

    Rows are ordered inside blocks of ``block`` microseconds, so a hot key spreads over as many tasks
    as it has blocks. Only the last row of each block travels on to the next non-empty block. Both uses
    read one exchange, so ``rows`` are computed once, when ``fields`` with the keys are all its columns and
    no key is nullable (else a null filter sets the two uses apart).
    """
    blocked = rows.withColumn(BLOCK, block_of(F.col(pos), block)).repartition(*keys, BLOCK)
    here = Window.partitionBy(*keys, BLOCK).orderBy(pos, tie)
    value = F.struct(*fields)
    marked = blocked.select(
        "*", F.lag(value).over(here).alias(name), F.lead(F.lit(1)).over(here).isNull().alias("_tail")
    )
    across = Window.partitionBy(*keys).orderBy(BLOCK)
    carried = marked.where("_tail").select(*keys, BLOCK, F.lag(value).over(across).alias("_carried"))
    return (
        marked.join(carried.where(F.col("_carried").isNotNull()), [*keys, BLOCK], "left")
        .withColumn(name, F.coalesce(F.col(name), F.col("_carried")))
        .drop("_carried", "_tail", BLOCK)
    )
