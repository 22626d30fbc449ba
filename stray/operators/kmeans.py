"""K-Means with distance bounds: many runs at once, and rows that cannot change are not computed.

Rows lie in packed blocks. For every run (a number of clusters and a start) a block keeps,
in materialised columns, the cluster of each row, an upper bound of the distance to its
own centroid and a lower bound of that to any other, as of the last time they were written.
A centroid that has since moved by s may have come nearer or gone farther by s at most, so
a row whose widened upper bound is below its narrowed lower bound keeps its cluster, and a
step computes distances for the other rows only. A step emits what changed in the sums of
the clusters, at most one row per run and cluster from each task. Bounds are written anew
when too many rows fail them.

Starts are D^2-weighted (k-means++): each next centroid is drawn with probability
proportional to the squared distance to those chosen, by the exponential race -ln(u) / d^2,
whose least value wins. u comes from md5 of seed and id, so the same rows win on any
cluster, and all starts of all runs are drawn in one pass per centroid.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stray.operators import blocks as B
from stray.session import bounded_batches, reliable_checkpoint

#: Bounds are written anew when more than this share of rows fails them, or after so many steps.
REWRITE_SHARE, REWRITE_STEPS = 0.25, 8
#: Hex digits of md5 in each of the two hashes of a start, and the numbers they span.
HEX, SPAN = 12, 1 << 48
BLOCK_ROWS = 8192
#: Relative rounding of a distance; bounds are widened by it.
SLACK = 1e-12

Centroids = list[list[float]]


@dataclass(frozen=True)
class Work:
    """Distances computed, and those that plain Lloyd steps would compute."""

    computed: int
    plain: int


@dataclass(frozen=True)
class Rows:
    """table: (block, ids, m, h): packed vectors; h: two hashes for each seed."""

    table: DataFrame
    seeds: tuple[int, ...]
    n: int
    d: int


def packed_rows(vecs: DataFrame, seeds: Sequence[int] = (), id_col: str = "user_id", vec_col: str = "z") -> Rows:
    spark = vecs.sparkSession
    bounded_batches(spark, B.BATCH_BYTES)
    n = vecs.count()
    blocks = max(math.ceil(n / BLOCK_ROWS), min(spark.sparkContext.defaultParallelism, math.ceil(n / 256)), 1)
    key = lambda s: F.md5(F.concat(F.lit(f"{s}|"), F.col(id_col).cast("string")))
    part = lambda s, i: F.conv(F.substring(key(s), 1 + i * HEX, HEX), 16, 10).cast("long")
    hashes = [part(s, i) for s in seeds for i in (0, 1)]
    own = vecs.select(F.col(id_col).alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("u"),
                      F.array(*hashes).cast("array<bigint>").alias("h"),
                      F.pmod(F.xxhash64(F.col(id_col)), F.lit(blocks)).cast("int").alias("block"))
    kind = own.schema["id"].dataType
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("ids", T.ArrayType(kind)),
                           T.StructField("m", T.BinaryType()), T.StructField("h", T.BinaryType())])

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        (x,) = B.pack(table)
        h = table.column("h").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = table.column("id").combine_chunks()
        return pa.table({"block": table.column("block")[:1], "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                         "m": pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()), "h": pa.array([h.tobytes()], pa.binary())})

    table = reliable_checkpoint(own.groupBy("block").applyInArrow(packed, schema))
    first = vecs.select(F.size(vec_col).alias("d")).first()
    return Rows(table, tuple(seeds), n, first.d if first else 0)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of rows to centroids."""
    out = np.empty((len(x), len(c)))
    for j, y in enumerate(c):
        diff = x - y
        out[:, j] = np.einsum("ij,ij->i", diff, diff)
    return out


def uniform(h: np.ndarray, step: int) -> np.ndarray:
    """A number in (0, 1) for each row (its two hashes) and step."""
    return ((h[..., 0] + step * h[..., 1]) % SPAN + 1) / (SPAN + 1.0)


def d2_starts(rows: Rows, k: int) -> dict[int, np.ndarray]:
    """For each seed k centroids among the rows, D^2-weighted; one pass per centroid for all seeds.
    Where all rows are chosen already, the last centroid is repeated."""
    if rows.n < k:
        raise ValueError(f"too few users ({rows.n}) for {k} clusters")
    seeds, d = rows.seeds, rows.d
    kind = rows.table.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("seed", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("id", kind),
                           T.StructField("u", T.ArrayType(T.DoubleType()))])
    chosen: dict[int, list] = {s: [] for s in seeds}
    for step in range(k):
        now = [np.array(chosen[s]) for s in seeds]

        def race(batches: Iterator[pa.RecordBatch], now=now, step=step) -> Iterator[pa.RecordBatch]:
            out = []
            for batch in batches:
                for i in range(batch.num_rows):
                    x = B.unpacked({"m": batch.column("m")[i].as_py()}, d)
                    h = np.frombuffer(batch.column("h")[i].as_py(), np.int64).reshape(len(x), len(seeds), 2)
                    ids = batch.column("ids")[i].values
                    for j, s in enumerate(seeds):
                        weight = distances(x, now[j]).min(axis=1) if step else np.ones(len(x))
                        with np.errstate(divide="ignore"):
                            score = np.where(weight > 0, -np.log(uniform(h[:, j], step)) / weight, np.inf)
                        best = int(score.argmin())  # ids are in order within a block
                        out.append((s, score[best], ids[best], x[best].tolist()))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.float64()),
                                                  pa.array([i.as_py() for i in cols[2]], cols[2][0].type), pa.array(cols[3], pa.list_(pa.float64()))], schema.names)

        won = (rows.table.select("ids", "m", "h").mapInArrow(race, schema).groupBy("seed")
               .agg(F.min(F.struct("score", "id", "u")).alias("best")).collect())
        for r in won:
            chosen[r.seed].append(chosen[r.seed][-1] if math.isinf(r.best.score) and step else list(r.best.u))
    return {s: np.array(c) for s, c in chosen.items()}


def summed(frame: DataFrame, d: int) -> dict[tuple[int, int], np.ndarray]:
    """Sums of (run, cluster, v) by run and cluster; v has n and the d sums, or more."""
    return {(r["run"], r["cluster"]): np.array([r[f"v{i}"] for i in range(d)]) for r in frame.groupBy("run", "cluster").agg(
        *[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(d)]).collect()}


SUMS = "run int, cluster int, v array<double>"


def sums_batch(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    """The rows of each run's matrix (cluster x values) that are not all 0."""
    run, cluster, v = [], [], []
    for r, m in sums.items():
        for j in np.flatnonzero(m.any(axis=1)).tolist():
            run.append(r)
            cluster.append(j)
            v.append(m[j].tolist())
    return pa.RecordBatch.from_arrays([pa.array(run, pa.int32()), pa.array(cluster, pa.int32()), pa.array(v, pa.list_(pa.float64()))],
                                      ["run", "cluster", "v"])


class Bounded:
    """Lloyd runs on `rows` from given centroids, with bounds kept between steps."""

    def __init__(self, rows: Rows, starts: Sequence[np.ndarray]) -> None:
        self.rows, self.cents = rows, [np.array(c, np.float64) for c in starts]
        self.state = rows.table.select("block", "m")  # later with lab, up, low
        self.bounded = False
        self.computed = self.plain = 0
        self.write(range(len(self.cents)))

    def write(self, active: Sequence[int]) -> None:
        """Clusters and bounds of all rows at the present centroids, and the sums of the clusters."""
        d, cents, active, was = self.rows.d, [c.copy() for c in self.cents], list(active), self.bounded
        anchor = [c.copy() for c in self.anchor] if was else None
        schema = "block int, m binary, lab binary, up binary, low binary, sums binary"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    x = B.unpacked({"m": batch.column("m")[i].as_py()}, d)
                    lab, up, low = (np.zeros((len(active), len(x)), t) for t in (np.int32, float, float))
                    sums = []
                    for a, r in enumerate(active):
                        d2 = np.sqrt(distances(x, cents[r]))
                        lab[a] = d2.argmin(axis=1)
                        up[a] = d2[np.arange(len(x)), lab[a]]
                        d2[np.arange(len(x)), lab[a]] = np.inf
                        low[a] = d2.min(axis=1)
                        hot = np.zeros((len(cents[r]), len(x)))
                        hot[lab[a], np.arange(len(x))] = 1.0
                        sums.append(np.column_stack([hot.sum(axis=1), hot @ x]).ravel())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("block").slice(i, 1), batch.column("m").slice(i, 1), *[pa.array([v.tobytes()], pa.binary()) for v in (lab, up, low)],
                         pa.array([np.concatenate(sums).tobytes() if sums else b""], pa.binary())], ["block", "m", "lab", "up", "low", "sums"])

        self.state = reliable_checkpoint(self.rows.table.select("block", "m").mapInArrow(run, schema))
        self.order, self.anchor, self.bounded, self.steps = active, cents, True, 0
        shape = [(r, len(cents[r])) for r in active]

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = None
            for batch in batches:
                for raw in batch.column("sums").to_pylist():
                    v = np.frombuffer(raw, np.float64)
                    out = v if out is None else out + v
            if out is not None:
                at, sums = 0, {}
                for r, k in shape:
                    sums[r] = out[at:at + k * (d + 1)].reshape(k, d + 1)
                    at += k * (d + 1)
                yield sums_batch(sums)

        found = summed(self.state.select("sums").mapInArrow(total, SUMS), d + 1)
        self.base = {r: np.array([found.get((r, j), np.zeros(d + 1)) for j in range(k)]) for r, k in shape}
        work = self.rows.n * sum(k for _, k in shape)
        self.computed += work

    def sums(self, active: Sequence[int]) -> dict[int, np.ndarray]:
        """Number and sum of the rows of each cluster at the present centroids."""
        d, cents, order, anchor = self.rows.d, self.cents, self.order, self.anchor
        self.plain += self.rows.n * sum(len(cents[r]) for r in active)
        if all(np.array_equal(cents[r], anchor[r]) for r in active):
            return {r: self.base[r] for r in active}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            change = {r: np.zeros((len(cents[r]), d + 1)) for r in active}
            failed = work = 0
            for batch in batches:
                for i in range(batch.num_rows):
                    x = B.unpacked({"m": batch.column("m")[i].as_py()}, d)
                    lab, up, low = (np.frombuffer(batch.column(c)[i].as_py(), t).reshape(len(order), len(x))
                                    for c, t in (("lab", np.int32), ("up", float), ("low", float)))
                    for r in active:
                        a = order.index(r)
                        moved = np.sqrt(((cents[r] - anchor[r]) ** 2).sum(axis=1)) * (1 + SLACK)
                        far = np.sort(moved)[::-1]
                        most = np.where(moved[lab[a]] == far[0], far[1] if (moved == far[0]).sum() == 1 else far[0], far[0]) if len(moved) > 1 else 0.0
                        open_ = np.flatnonzero(~((up[a] + moved[lab[a]]) * (1 + SLACK) < (low[a] - most) * (1 - SLACK)))
                        failed += len(open_)
                        work += len(open_) * len(moved)
                        if not len(open_):
                            continue
                        y, old = x[open_], lab[a][open_]
                        new = distances(y, cents[r]).argmin(axis=1)
                        other = np.flatnonzero(new != old)
                        for j, sign in ((old[other], -1.0), (new[other], 1.0)):
                            np.add.at(change[r], j, sign * np.column_stack([np.ones(len(other)), y[other]]))
            out = {r: v for r, v in change.items()}
            out[-1] = np.zeros((1, d + 1))
            out[-1][0, :2] = failed, work
            yield sums_batch(out)

        found = summed(self.state.select("m", "lab", "up", "low").mapInArrow(run, SUMS), d + 1)
        failed, work = found.get((-1, 0), np.zeros(d + 1))[:2]
        self.computed += int(work)
        self.steps += 1
        out = {r: self.base[r] + np.array([found.get((r, j), np.zeros(d + 1)) for j in range(len(cents[r]))]) for r in active}
        self.loose = failed > REWRITE_SHARE * self.rows.n * len(active) or self.steps >= REWRITE_STEPS
        return out

    def run(self, max_iter: int, tol: float | None) -> list[np.ndarray]:
        """At most `max_iter` steps; a run whose centroids move by at most `tol` (squared) is done. An empty
        cluster keeps its centroid."""
        active, self.loose = list(range(len(self.cents))), False
        for step in range(max_iter):
            if not active:
                break
            if self.loose:
                self.write(active)
                self.loose = False
            got = self.sums(active)
            still = []
            for r in active:
                n, s = got[r][:, 0].round(), got[r][:, 1:]
                new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], self.cents[r])
                shift = ((new - self.cents[r]) ** 2).sum(axis=1).max()
                self.cents[r] = new
                if tol is None or shift > tol:
                    still.append(r)
            active = still
        return self.cents

    def inertia(self) -> list[float]:
        """Sum of squared distances to the nearest centroid, for each run."""
        d, cents = self.rows.d, self.cents

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cost = np.zeros((1, len(cents)))
            for batch in batches:
                for m in batch.column("m").to_pylist():
                    x = B.unpacked({"m": m}, d)
                    cost += [distances(x, c).min(axis=1).sum() for c in cents]
            yield sums_batch({0: cost + 0.0})

        found = summed(self.rows.table.select("m").mapInArrow(run, SUMS), len(cents))
        return [float(x) for x in found.get((0, 0), np.zeros(len(cents)))]

    def work(self) -> Work:
        return Work(self.computed, self.plain)
