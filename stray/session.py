"""Session helpers: checkpoint folder, tables in it, bounded Arrow batches."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names (spark.checkpoint.dir)."""
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            spark.sparkContext.setCheckpointDir(d)
    if not d:
        raise RuntimeError(
            "no checkpoint folder: set spark.checkpoint.dir to a shared (cluster-wide) path")
    return d


def names_checkpoint_dir(spark: SparkSession) -> bool:
    return bool(spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None))


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Set `fallback` only where the session names no checkpoint folder (tests, local runs)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or fallback
    spark.sparkContext.setCheckpointDir(d)
    return d


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise `df` to the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_batches(spark: SparkSession, size: int) -> None:
    """Bound Arrow batches by bytes: rows that hold blocks or texts differ in size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


@dataclass(frozen=True)
class Written:
    """A table in the shared folder. It cuts the lineage, and the planner knows its true size."""

    df: DataFrame
    path: str
    name: str = ""      # in the catalog, of a bucketed table

    def drop(self) -> None:
        """Delete the files, once a later table has taken the place of this one."""
        spark = self.df.sparkSession
        if self.name:
            spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bucket_count(spark: SparkSession) -> int:
    """Buckets of a table that `written` buckets; what joins it without a shuffle of the table has as many partitions."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


#: Row groups of 1 MB, looked at after each row: a reader holds a row group of large rows at once.
LARGE_ROWS = {"parquet.block.size": str(1 << 20), "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}


def written(df: DataFrame, name: str, bucket: str | None = None, large_rows: bool = False) -> Written:
    """`df` as a table, bucketed by the column `bucket` where joins by it shall not shuffle the table."""
    spark = df.sparkSession
    key = uuid.uuid4().hex
    path = f"{checkpoint_dir(spark).rstrip('/')}/stray-{name}-{key}"
    if bucket is None:
        df.write.parquet(path)
        return Written(spark.read.schema(df.schema).parquet(path), path)
    table = f"stray_{name.replace('-', '_')}_{key}"
    write = df.write.options(**LARGE_ROWS) if large_rows else df.write
    write.format("parquet").bucketBy(bucket_count(spark), bucket).option("path", path).saveAsTable(table)
    return Written(spark.table(table), path, table)
