"""Mergeable co-moment matrices of many columns, missing values left out pair by pair.

Each task turns its Arrow batches into four d x d matrices: over the rows where both x and
y are there, their number, the mean of x, the co-moment of x and y, and the second moment
of x (those of y are the transposes). Two sets merge by the pairwise update of Chan, Golub
and LeVeque, which stays accurate when means are large. Tasks' sets are merged `FAN_IN` at
a time in rounds, each by a task, so that neither a task nor the driver ever holds more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stray.session import bounded_batches, reliable_checkpoint

#: Sets that one task (at last the driver) merges.
FAN_IN = 16
BATCH_BYTES = 8 << 20


@dataclass
class Moments:
    """Of every pair (x, y) of columns, over the rows that have both: n, mean of x, co-moment, second moment of x."""

    n: np.ndarray
    mean: np.ndarray
    co: np.ndarray
    var: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        """Of the rows of a matrix; NaN is missing."""
        there = ~np.isnan(x)
        first = there.argmax(axis=0)
        shift = np.where(there.any(axis=0), x[first, np.arange(x.shape[1])], 0.0)  # a constant column is exactly 0
        shifted = np.where(there, x - shift, 0.0)
        centre = shifted.sum(axis=0) / np.maximum(there.sum(axis=0), 1)
        y = np.where(there, shifted - centre, 0.0)
        m = there.astype(np.float64)
        n = m.T @ m
        some = np.maximum(n, 1.0)
        total = y.T @ m
        return Moments(n, (shift + centre)[:, None] + total / some, y.T @ y - total * total.T / some, (y * y).T @ m - total * total / some)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        some = np.maximum(n, 1.0)
        step = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        both = self.n * other.n / some
        mean = np.where(self.n > 0, self.mean + step * other.n / some, other.mean)
        return Moments(n, mean, self.co + other.co + step * step.T * both, self.var + other.var + step * step * both)

    def packed(self) -> bytes:
        return np.stack([self.n, self.mean, self.co, self.var]).tobytes()

    @staticmethod
    def unpacked(raw: bytes, d: int) -> Moments:
        return Moments(*np.frombuffer(raw, np.float64).reshape(4, d, d))

    def correlation(self) -> np.ndarray:
        """Pearson's r; NaN where a column of the pair is constant or missing."""
        scale = self.var * self.var.T
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where((self.var > 0) & (self.var.T > 0), self.co / np.sqrt(scale), np.nan)


def merged(parts: Sequence[bytes], d: int) -> Moments | None:
    out = None
    for raw in parts:
        own = Moments.unpacked(raw, d)
        out = own if out is None else out.merged(own)
    return out


def co_moments(df: DataFrame, cols: Sequence[str]) -> Moments | None:
    """Moments of all pairs of numeric columns; None for an empty table."""
    d = len(cols)
    bounded_batches(df.sparkSession, BATCH_BYTES)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            if batch.num_rows:
                own = Moments.of(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
                out = own if out is None else out.merged(own)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([out.packed()], pa.binary())], ["lot", "m"])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("lot")
        out = merged(table.column("m").to_pylist(), d)
        return pa.table({"lot": [table.column("lot")[0].as_py()], "m": pa.array([out.packed()], pa.binary())})

    numeric = df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    parts = reliable_checkpoint(numeric.mapInArrow(part, "lot long, m binary"))
    fan = FAN_IN
    while parts.count() > FAN_IN:
        parts = reliable_checkpoint(parts.groupBy(F.floor(F.col("lot") / fan).alias("g")).applyInArrow(
            lambda t: join(t.select(["lot", "m"])), "lot long, m binary"))
        fan *= FAN_IN
    return merged([r.m for r in parts.orderBy("lot").collect()], d)
