"""Consecutive numbering of rows in key order, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.session import cut_lineage, local_frame

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def with_consecutive_index(df: DataFrame, key: str, start: int = 0, index_col: str = "idx") -> DataFrame:
    """Number rows ``start, start + 1, ...`` in ascending order of ``key``.

    Rows are range-partitioned and sorted by key; a row's index is its number
    within the partition plus the sizes of the partitions before it.  The driver
    sees one count per partition, never the rows.
    """
    ordered = df.repartitionByRange(F.col(key)).sortWithinPartitions(key)
    marked = ordered.withColumn("_mark", F.monotonically_increasing_id())
    # range bounds are sampled, so the numbering has to be written down before it is used twice
    fixed = cut_lineage(marked)
    fixed = fixed.withColumn("_part", F.shiftright("_mark", _ROW_BITS))
    sizes = fixed.groupBy("_part").count().collect()
    offsets, total = [], start
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["count"]
    # one short row per partition: bounded by the number of shuffle partitions
    table = local_frame(df.sparkSession, offsets, "_part bigint, _first bigint")
    within = F.col("_mark").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        fixed.join(F.broadcast(table), "_part")
        .withColumn(index_col, within + F.col("_first"))
        .drop("_mark", "_part", "_first")
    )
