"""Rows in blocks by direction, and joins of blocks that bounds cannot rule out.

Unit vectors go to the nearest of at most `MAX_CENTRES` directions, found on a sample of
`SAMPLE` rows, and every centre's rows are dealt by id hash to lots of about `block_size`,
so a direction that a third of all rows share is many blocks, not one. A block is one
packed row (ids and a float64 matrix). With the greatest angle rho of a centre's rows to
their centre c, the triangle inequality of angles bounds every cosine between a row x and
a row y of the centre: angle(x, c) - rho <= angle(x, y) <= angle(x, c) + rho. So a task
that holds a block knows, from centres and radii alone (as many numbers as there are
centres), which of its rows can matter to which centre.

`meet` is the join: requests (some rows of one block, addressed to another) and the blocks
they are addressed to are dealt by block, each block before its requests, and a task
streams the requests past the one block it holds. Blocks that no request reaches are never
multiplied, a request carries only the rows that need it, and nothing is ever grouped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stray.session import bounded_batches, reliable_checkpoint

#: Rows on which the centres are chosen, and the most centres.
SAMPLE = 4096
MAX_CENTRES = 256
#: Rounding of arccos near 1 stays far below this.
ANGLE_SLACK = 1e-7
#: Products of unit vectors may leave [-1, 1] by a few ulp.
COS_SLACK = 1e-9
BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class Layout:
    """What every task may know: centres, their radii, and the centre and rows of each block.
    The last centre has the zero vectors, whose cosine to everything is 0."""

    centres: np.ndarray
    radius: np.ndarray
    centre_of: np.ndarray
    rows_of: np.ndarray

    def angles(self, x: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(x @ self.centres.T, -1.0, 1.0))

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest cosine of each row of `x` to any row of each centre."""
        a = self.angles(x)
        low = np.cos(np.minimum(np.pi, a + self.radius))
        high = np.cos(np.maximum(0.0, a - self.radius))
        none = ~x.any(axis=1)
        low[none] = high[none] = 0.0
        low[:, -1] = high[:, -1] = 0.0
        return low - COS_SLACK, high + COS_SLACK


@dataclass(frozen=True)
class Blocks:
    """table: (block, ids, m) with `ids` in order and `m` their unit vectors, packed."""

    table: DataFrame
    layout: Layout
    sample: np.ndarray
    n: int
    d: int
    id_type: T.DataType


def spread_centres(x: np.ndarray, k: int) -> np.ndarray:
    """k directions of the unit vectors `x`: farthest first, then a few steps to the means."""
    first = x.sum(axis=0)
    size = np.linalg.norm(first)
    chosen = [first / size if size > 0 else x[0]]
    near = x @ chosen[0]
    while len(chosen) < k:
        i = int(near.argmin())
        if near[i] >= 1.0 - 1e-12:
            break
        chosen.append(x[i])
        near = np.maximum(near, x @ x[i])
    centres = np.array(chosen)
    for _ in range(5):
        label = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, label, x)
        size = np.linalg.norm(sums, axis=1)
        ok = size > 0
        centres[ok] = sums[ok] / size[ok, None]
    return centres


def pack(table: pa.Table, cols: tuple[str, ...] = ("u",)) -> list[np.ndarray]:
    """The vector columns of an Arrow table as matrices."""
    out = []
    for c in cols:
        v = table.column(c).combine_chunks()
        flat = v.flatten().to_numpy(zero_copy_only=False)
        out.append(flat.reshape(table.num_rows, -1))
    return out


def unpacked(row: dict, d: int) -> np.ndarray:
    return np.frombuffer(row["m"], np.float64).reshape(-1, d)


def direction_blocks(units: DataFrame, id_col: str, n: int, block_size: int = 2048, centres: int | None = None) -> Blocks:
    """Blocks of `units` (id, u); `n` is their count. Centres: half the root of the rows, unless given."""
    spark = units.sparkSession
    bounded_batches(spark, BATCH_BYTES)
    own = units.select(F.col(id_col).alias("id"), "u")
    id_type = own.schema["id"].dataType
    rows = own.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("u").collect()
    sample = np.array([r.u for r in rows], np.float64)
    d = sample.shape[1]
    real = sample[sample.any(axis=1)]
    wanted = min(MAX_CENTRES, centres or max(4, math.ceil(math.sqrt(n) / 2)))
    c = spread_centres(real, wanted) if len(real) else np.zeros((0, d))
    c = np.vstack([c, np.zeros((1, d))])

    def nearest(x: np.ndarray) -> np.ndarray:
        label = (x @ c[:-1].T).argmax(axis=1) if len(c) > 1 else np.zeros(len(x), np.int64)
        return np.where(x.any(axis=1), label, len(c) - 1)

    # by the sample's shares, rounded up, so that lots are about a block or less
    share = np.bincount(nearest(sample), minlength=len(c))
    share = np.where(share > 0, share + 2 * np.sqrt(share), 3) / len(sample)
    lots = np.maximum(1, np.ceil(share * n / block_size)).astype(np.int64)
    begin = np.cumsum(lots) - lots

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                (x,) = pack(pa.Table.from_batches([batch]))
                centre = nearest(x)
                lot = batch.column("h").to_numpy() % lots[centre]
                yield batch.select(["id", "u"]).append_column("block", pa.array((begin[centre] + lot).astype(np.int32)))

    schema = T.StructType([*own.schema.fields, T.StructField("block", T.IntegerType())])
    placed = own.select("id", "u", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 40)).alias("h")).mapInArrow(dealt, schema)
    kind = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("rho", T.DoubleType()),
                         T.StructField("ids", T.ArrayType(id_type)), T.StructField("m", T.BinaryType())])

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        (x,) = pack(table)
        block = table.column("block")[0].as_py()
        centre = c[int(np.searchsorted(begin, block, "right")) - 1]
        rho = float(np.arccos(np.clip(x @ centre, -1.0, 1.0)).max()) if centre.any() else 0.0
        ids = table.column("id").combine_chunks()
        return pa.table({"block": pa.array([block], pa.int32()), "n": [len(x)], "rho": [rho],
                         "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                         "m": pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())})

    table = reliable_checkpoint(placed.groupBy("block").applyInArrow(packed, kind))
    # a few numbers a block (rows / block_size of them)
    facts = table.select("block", "n", "rho").collect()
    centre_of = np.repeat(np.arange(len(c)), lots)
    rows_of, radius = np.zeros(len(centre_of), np.int64), np.zeros(len(c))
    for r in facts:
        rows_of[r.block] = r.n
        radius[centre_of[r.block]] = max(radius[centre_of[r.block]], r.rho + ANGLE_SLACK)
    return Blocks(table.select("block", "ids", "m"), Layout(c, radius, centre_of, rows_of), sample, n, d, id_type)


REQUEST = ("slot", "turn", "sender", "ids", "rows", "m")


def request_schema(id_type: T.DataType) -> T.StructType:
    """`slot`: the block asked; `rows`: places in the sender's block (int32, packed)."""
    return T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("turn", T.IntegerType()),
                         T.StructField("sender", T.IntegerType()), T.StructField("ids", T.ArrayType(id_type)),
                         T.StructField("rows", T.BinaryType()), T.StructField("m", T.BinaryType())])


class Outbox:
    """Requests of a task, in batches of bounded size."""

    def __init__(self, id_list: pa.DataType) -> None:
        self.id_list, self.rows, self.size = id_list, [], 0

    def put(self, slot: int, sender: int, ids, rows: np.ndarray, x: np.ndarray, turn: int = 1) -> None:
        m = np.ascontiguousarray(x, np.float64).tobytes()
        self.rows.append((slot, turn, sender, ids, rows.astype(np.int32).tobytes(), m))
        self.size += len(m) + 16 * len(rows)

    def full(self) -> bool:
        return self.size >= BATCH_BYTES

    def take(self) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.int32(), self.id_list, pa.binary(), pa.binary())
        cols = list(zip(*self.rows)) if self.rows else [[]] * len(kinds)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], list(REQUEST))


def requests(state: DataFrame, id_type: T.DataType, ask: Callable[[dict, Outbox], None]) -> DataFrame:
    """`ask(row, outbox)` for every row of `state`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            box = Outbox(batch.schema.field("ids").type)
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() if c != "ids" else batch.column(c)[i].values for c in batch.schema.names}
                for _ in ask(row, box):
                    if box.full():
                        yield box.take()
            if box.rows:
                yield box.take()

    return state.mapInArrow(run, request_schema(id_type))


@dataclass
class Held:
    """A block or request as a task sees it."""

    block: int
    ids: np.ndarray
    rows: np.ndarray
    x: np.ndarray


Kernel = Callable[[Held | None, Held], Iterator[pa.RecordBatch]]


def meet(blocks: Blocks, asked: DataFrame, make: Callable[[], tuple[Kernel, Callable[[], Iterator[pa.RecordBatch]]]],
         schema: T.StructType | str) -> DataFrame:
    """`make()` gives each task a kernel(block, request), called for each request and the block it asks (None for
    slots below 0), and a function for what is left at its end."""
    d = blocks.d
    residents = blocks.table.select(F.col("block").alias("slot"), F.lit(0).alias("turn"), F.col("block").alias("sender"), "ids",
                                    F.lit(b"").alias("rows"), "m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        kernel, finish = make()
        for batch in batches:
            cols = [batch.column(c) for c in REQUEST]
            for i in range(batch.num_rows):
                slot, turn, sender, ids, rows, m = (col[i] for col in cols)
                ids = ids.values
                row = Held(sender.as_py(), ids.to_numpy(zero_copy_only=False) if ids is not None else np.zeros(0),
                           np.frombuffer(rows.as_py(), np.int32), np.frombuffer(m.as_py(), np.float64))
                if slot.as_py() >= 0:
                    row.x = row.x.reshape(-1, d)
                if turn.as_py() == 0:
                    held = row
                else:
                    yield from kernel(held if slot.as_py() >= 0 else None, row)
        yield from finish()

    parts = max(2 * blocks.table.sparkSession.sparkContext.defaultParallelism, len(blocks.layout.rows_of) // 4)
    return (residents.unionByName(asked).repartition(parts, "slot").sortWithinPartitions("slot", "turn", "sender")
            .mapInArrow(run, schema))


def sends(i: int, j: int) -> bool:
    """Of two different blocks, whether i asks j; every block asks about half of the others."""
    return (i < j) == ((i + j) % 2 == 0)
