"""Distributed dense 1..N numbering in a total order.

``row_number()`` over an un-partitioned window moves every row into one
task. Here the frame is range-partitioned on the order, sorted inside each
partition and checkpointed to the shared folder (so partition contents are
fixed even if executors are lost); one small job counts rows per partition,
and each row's position is its partition's offset plus its index inside the
partition (``monotonically_increasing_id`` encodes both).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stray.session import reliable_checkpoint


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank",
                n_partitions: int | None = None) -> DataFrame:
    """Append `name` = 1..N following `order` (which must be a total order)."""
    # without an explicit count AQE may merge adjacent ranges (order is kept);
    # the checkpoint then fixes whatever partitioning was chosen
    if n_partitions is None:
        ordered = df.repartitionByRange(*order)
    else:
        ordered = df.repartitionByRange(n_partitions, *order)
    ordered = ordered.sortWithinPartitions(*order)
    ck = reliable_checkpoint(ordered)
    tagged = ck.select("*", F.spark_partition_id().alias("_pid"),
                       F.monotonically_increasing_id().alias("_mid"))
    counts = {r["_pid"]: r["n"] for r in
              tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_parts = max(counts) + 1 if counts else 1
    offsets, run = [], 0
    for p in range(n_parts):
        offsets.append(run)
        run += counts.get(p, 0)
    off = F.array(*[F.lit(o).cast("long") for o in offsets])
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.withColumn(name, (F.element_at(off, F.col("_pid") + 1) + pos + 1).cast("long"))
            .drop("_pid", "_mid"))
