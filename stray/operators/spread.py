"""Joins of a large table with one row per key, even where a key holds much of the table.

A key with more than a PART of a partition's fair share of the rows is a hub. There are at
most partitions / PART hubs, whatever the data, so their list is small and known to the
driver. A hub's rows are dealt to as many lots as it has such parts, and the other side's
row for it is repeated once a lot; all other keys have one lot. So no partition of the join
holds much more than its share, and nothing is broadcast by a row count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Of a partition's fair share; lots are hashed to partitions, so many small ones even out.
PART = 1 / 16


@dataclass(frozen=True)
class Hubs:
    """table: (key, lots), at most partitions / PART rows."""

    table: DataFrame
    count: int


def hubs_of(counts: DataFrame, total: int) -> Hubs:
    """Of counts (key, c) of a table with `total` rows."""
    spark = counts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, math.ceil(total * PART / parts))
    schema = T.StructType([T.StructField("_key", counts.schema["key"].dataType), T.StructField("_lots", T.IntegerType())])
    found = [(r["key"], math.ceil(r["c"] / share)) for r in counts.where(F.col("c") > share).collect()]
    return Hubs(spark.createDataFrame(found, schema), len(found))


def dealt(df: DataFrame, key: str, by: str, hubs: Hubs) -> DataFrame:
    """The large table with the lot of each row: rows of a hub by the hash of column `by`."""
    if not hubs.count:
        return df.withColumn("lot", F.lit(0))
    lot = F.coalesce(F.pmod(F.xxhash64(by), F.col("_lots").cast("long")).cast("int"), F.lit(0))
    joined = df.join(F.broadcast(hubs.table), F.col(key) == F.col("_key"), "left")  # at most partitions / PART rows
    return joined.withColumn("lot", lot).drop("_key", "_lots")


def repeated(df: DataFrame, key: str, hubs: Hubs) -> DataFrame:
    """The table with one row per key, a hub's row once for each of its lots."""
    if not hubs.count:
        return df.withColumn("lot", F.lit(0))
    joined = df.join(F.broadcast(hubs.table), F.col(key) == F.col("_key"), "left")
    return joined.withColumn("lot", F.explode(F.sequence(F.lit(0), F.coalesce("_lots", F.lit(1)) - 1))).drop("_key", "_lots")
