"""Raw activity logs of the cohort job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from stray.config import LOG_NAMES, USER_COLUMN
from stray.sources.loader import _exists, read_table, save_table


def read_logs(spark: SparkSession, folder: str, names: Sequence[str] = LOG_NAMES,
              fmt: str = "csv", schema: Mapping[str, str] | None = None, multi_line: bool = False) -> dict[str, DataFrame]:
    """`<folder>/<name>.<fmt>` for each log; absent logs are skipped. Without a schema
    (by log name) CSV values stay text, so that they are written again as they were read.
    Quoted values with line breaks need `multi_line` (see `read_table`)."""
    out: dict[str, DataFrame] = {}
    for name in names:
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        if _exists(spark, path):
            out[name] = read_table(spark, path, fmt, (schema or {}).get(name), as_text=True, multi_line=multi_line)
    return out


def log_users(log: DataFrame, column: str = USER_COLUMN) -> DataFrame:
    """The distinct users of one log (only the user column is scanned)."""
    return log.select(column).distinct()


def write_logs(logs: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> dict[str, str]:
    """One output per log; returns name -> path."""
    paths = {}
    for name, df in logs.items():
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        save_table(df, path, fmt)
        paths[name] = path
    return paths
