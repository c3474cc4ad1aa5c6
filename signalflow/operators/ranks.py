"""Row numbers over a whole table without one task that sorts it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalflow.session import written


def numbered(df: DataFrame, order: Sequence[Column | str], name: str, label: str = "numbered") -> DataFrame:
    """``df`` with the 0-based position ``name`` in the order of ``order``.

    Rows are range-partitioned, sorted and written once; a row's number is its index within its
    partition plus the sizes of the partitions before it, of which there are as many as partitions.
    """
    ranged = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), label)
    part = F.shiftright("__at", 33)
    sizes = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # one row per partition
    # partition numbers are dense, so a row finds its start in a literal array by index
    starts, total, counts = [], 0, {row.part: row.n for row in sizes}
    for number in range(max(counts, default=-1) + 1):
        starts.append(total)
        total += counts.get(number, 0)
    start = F.get(F.lit(starts).cast("array<bigint>"), part.cast("int")) if starts else F.lit(0).cast("long")
    return ranged.withColumn(name, start + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at")
