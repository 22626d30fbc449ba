"""Cosine similarity and collaborative-filtering scores (F1-F8).

Per-user and global mean similarities never touch pairs:
sum_{j != i} u_i . u_j = u_i . S - u_i . u_i with S = sum_j u_j, so F2/F3
are one d-wide aggregate plus a projection. Only the statistics of the
pair distribution (F7), top-k lists (F5) and thresholded edges (G1) look at
pairs, in blocks by direction, and multiply only what bounds cannot decide.
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
from pyspark.sql.pandas.types import to_arrow_type

from stray.functions.stats import exact_percentiles, interpolate, rank_targets
from stray.functions.vectors import dot, lit_vector, norm, unit
from stray.operators import blocks as B
from stray.session import reliable_checkpoint, written

HIST_BINS = 4096         # bins of a bracket in one pass
BRACKET_ROWS = 1024      # sample rows whose pairs suggest the first brackets
SLICE = 512              # rows of a request multiplied at once
ROUND_WIDTHS = (4, 16, 64, 256)  # blocks that a block asks in the rounds of the top-k search
COS_SLACK = 1e-6         # cosines computed in floating point may leave [-1, 1] by an ulp


def unit_vectors(vecs: DataFrame, id_col: str = "user_id", vec_col: str = "z") -> DataFrame:
    """(id, u) with u = z / |z|; the zero vector stays zero (similarity 0 to all)."""
    return (vecs.select(F.col(id_col), F.col(vec_col), norm(vec_col).alias("_norm"))
            .select(F.col(id_col), unit(vec_col, "_norm").alias("u")))


@dataclass(frozen=True)
class PairWork:
    """Pairs there are (times passes), pairs multiplied, and passes or rounds."""

    pairs: int
    multiplied: int
    passes: int


def _dim(vecs: DataFrame, vec_col: str) -> int:
    row = vecs.select(F.size(vec_col).alias("d")).first()
    return 0 if row is None else int(row["d"])


@dataclass(frozen=True)
class UnitSum:
    n: int
    total: tuple[float, ...]     # S = sum of unit vectors
    sq_total: float              # sum of |u|^2 (= number of non-zero vectors)


def unit_sum(units: DataFrame, d: int) -> UnitSum:
    row = units.agg(F.count(F.lit(1)).alias("n"),
                    *[F.sum(F.col("u")[i]).alias(f"s{i}") for i in range(d)],
                    F.sum(dot("u", "u")).alias("uu")).first()
    n = int(row["n"])
    return UnitSum(n, tuple(float(row[f"s{i}"] or 0.0) for i in range(d)), float(row["uu"] or 0.0))


def avg_similarity(vecs: DataFrame, id_col: str = "user_id", vec_col: str = "z") -> DataFrame:
    """(user_id, avg_similarity) = mean cosine to every other user; null when n = 1."""
    units = unit_vectors(vecs, id_col, vec_col)
    d = _dim(vecs, vec_col)
    us = unit_sum(units, d)
    if us.n <= 1:
        val = F.lit(None).cast("double")
    else:
        val = (dot("u", lit_vector(us.total)) - dot("u", "u")) / F.lit(float(us.n - 1))
    return units.select(F.col(id_col).alias("user_id"), val.alias("avg_similarity"))


def global_similarity(vecs: DataFrame, id_col: str = "user_id", vec_col: str = "z") -> DataFrame:
    """mean off-diagonal similarity, (|S|^2 - sum |u|^2) / (n (n - 1))."""
    spark = vecs.sparkSession
    units = unit_vectors(vecs, id_col, vec_col)
    us = unit_sum(units, _dim(vecs, vec_col))
    val = None
    if us.n > 1:
        s2 = sum(x * x for x in us.total)
        val = (s2 - us.sq_total) / (us.n * (us.n - 1))
    return spark.createDataFrame([(val,)], "avg_similarity double")


def avg_similarity_one(vecs: DataFrame, user, id_col: str = "user_id", vec_col: str = "z"
                       ) -> DataFrame:
    """F3 for one user."""
    return avg_similarity(vecs, id_col, vec_col).where(F.col("user_id") == F.lit(user))


def similar_users(vecs: DataFrame, user, top_k: int = 5, id_col: str = "user_id",
                  vec_col: str = "z") -> DataFrame:
    """F5 for one user: its unit vector travels as a literal; top-k by
    (similarity desc, user_id asc), the user itself excluded."""
    units = unit_vectors(vecs, id_col, vec_col)
    me = units.where(F.col(id_col) == F.lit(user)).select("u").first()
    if me is None:
        raise ValueError(f"unknown user {user!r}")
    sim = dot("u", lit_vector(me["u"]))
    return (units.where(F.col(id_col) != F.lit(user))
            .select(F.col(id_col).alias("user_id"), sim.alias("similarity"))
            .orderBy(F.col("similarity").desc(), F.col("user_id").asc())
            .limit(top_k))


def _blocks(vecs: DataFrame, id_col: str, vec_col: str, block_size: int, centres: int | None = None) -> B.Blocks | None:
    """Blocks of the unit vectors, or None for an empty table. The vectors are written once: their count, the
    sample and the blocks read them."""
    units = written(unit_vectors(vecs, id_col, vec_col), "units")
    n = units.df.count()
    out = B.direction_blocks(units.df, id_col, n, block_size, centres) if n else None
    units.drop()
    return out


def _typed(ids: np.ndarray, kind: T.DataType) -> pa.Array:
    return pa.array(ids, to_arrow_type(kind))


def similar_users_all(vecs: DataFrame, top_k: int = 5, id_col: str = "user_id",
                      vec_col: str = "z", block_size: int = 2048, centres: int | None = None) -> DataFrame:
    """F5 for every user: (user_id, rank, other_id, similarity)."""
    return top_k_search(vecs, top_k, id_col, vec_col, block_size, centres)[0]


def top_k_search(vecs: DataFrame, top_k: int = 5, id_col: str = "user_id", vec_col: str = "z",
                 block_size: int = 2048, centres: int | None = None) -> tuple[DataFrame, PairWork]:
    """F5, best first, and what it cost.

    In every round a block asks the next blocks in the order of their upper bounds, a few at
    first, and sends only rows whose k-th best similarity so far does not exceed the bound.
    The k best of each row stay with its block between rounds; a row whose bounds are all
    below its k-th best is done. A round's results of a block are at most ROUND_WIDTHS x rows
    x k, whatever the table's size."""
    spark, kind = vecs.sparkSession, vecs.schema[id_col].dataType
    schema = T.StructType([T.StructField("user_id", kind), T.StructField("rank", T.IntegerType()),
                           T.StructField("other_id", kind), T.StructField("similarity", T.DoubleType())])
    b = _blocks(vecs, id_col, vec_col, block_size, centres)
    if b is None or top_k < 1:
        return spark.createDataFrame([], schema), PairWork(0, 0, 0)
    d, k, layout = b.d, top_k, b.layout
    id_list = pa.list_(to_arrow_type(kind))
    state_schema = T.StructType([*b.table.schema.fields, T.StructField("sims", T.BinaryType()), T.StructField("others", T.ArrayType(kind)),
                                 T.StructField("seen", T.BinaryType()), T.StructField("work", T.LongType()), T.StructField("open", T.BooleanType())])
    found_schema = T.StructType([T.StructField("sender", T.IntegerType()), T.StructField("rows", T.BinaryType()),
                                 T.StructField("sims", T.BinaryType()), T.StructField("others", T.ArrayType(kind)),
                                 T.StructField("work", T.LongType())])

    def wanted(x: np.ndarray, kth: np.ndarray, seen: set[int], width: int) -> list[tuple[int, np.ndarray]]:
        """The next blocks to ask, and the rows that need them."""
        high = layout.bounds(x)[1]
        need, best = high >= kth[:, None], high.max(axis=0)
        out = []
        for j in np.lexsort((np.arange(len(layout.centre_of)), -best[layout.centre_of])).tolist():
            c = layout.centre_of[j]
            if j not in seen and layout.rows_of[j] and need[:, c].any():
                out.append((j, np.flatnonzero(need[:, c])))
                if len(out) == width:
                    break
        return out

    def of(row: dict) -> tuple[np.ndarray, np.ndarray, set[int]]:
        x = B.unpacked(row, d)
        return x, np.frombuffer(row["sims"], np.float64).reshape(len(x), k), set(np.frombuffer(row["seen"], np.int32).tolist())

    def search() -> tuple[B.Kernel, Callable]:
        def kernel(held: B.Held, asked: B.Held) -> Iterator[pa.RecordBatch]:
            s = asked.x @ held.x.T
            if held.block == asked.block:
                s[np.arange(len(s)), asked.rows] = -np.inf
            kk = min(k, s.shape[1])
            kth = -np.partition(-s, kk - 1, axis=1)[:, kk - 1]
            rows, cols = np.nonzero((s >= kth[:, None]) & (s > -np.inf))  # all ties at the k-th
            order = np.lexsort((cols, -s[rows, cols], rows))  # ids are in order within a block
            rows, cols = rows[order], cols[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            rows, cols, place = rows[place < kk], cols[place < kk], place[place < kk]
            sims, at = np.full((len(s), k), -np.inf), np.full((len(s), k), -1)
            sims[rows, place], at[rows, place] = s[rows, cols], cols
            others = _typed(held.ids, kind).take(pa.array(at.ravel(), mask=at.ravel() < 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([asked.block], pa.int32()), pa.array([asked.rows.tobytes()], pa.binary()), pa.array([sims.tobytes()], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(others)], pa.int32()), others), pa.array([s.size], pa.int64())], found_schema.names)
        return kernel, lambda: iter(())

    def asking(width: int):
        def ask(row: dict, box: B.Outbox) -> Iterator[None]:
            x, sims, seen = of(row)
            for j, rows in wanted(x, sims[:, -1], seen, width):
                box.put(j, row["block"], None, rows, x[rows])
                yield
        return ask

    def merging(width: int, following: int):
        def merge(state: pa.Table, found: pa.Table) -> pa.Table:
            """One block with this round's results."""
            row = {c: state.column(c)[0].as_py() for c in ("block", "m", "sims", "seen", "work")}
            x, sims, seen = of(row)
            asked = [j for j, _ in wanted(x, sims[:, -1], seen, width)]
            rows, values, others = [np.repeat(np.arange(len(x)), k)], [sims.ravel()], [state.column("others")[0].values]
            for i in range(found.num_rows):
                r = np.frombuffer(found.column("rows")[i].as_py(), np.int32)
                rows.append(np.repeat(r, k))
                values.append(np.frombuffer(found.column("sims")[i].as_py(), np.float64))
                others.append(found.column("others")[i].values)
            rows, values, others = np.concatenate(rows), np.concatenate(values), pa.concat_arrays(others)
            ok = np.flatnonzero(values > -np.inf)
            rows, values, others = rows[ok], values[ok], others.take(pa.array(ok))
            rank = np.unique(others.to_numpy(zero_copy_only=False), return_inverse=True)[1]
            order = np.lexsort((rank, -values, rows))
            rows = rows[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            kept = place < k
            rows, place, order = rows[kept], place[kept], order[kept]
            sims, at = np.full((len(x), k), -np.inf), np.full((len(x), k), -1)
            sims[rows, place], at[rows, place] = values[order], order
            best = others.take(pa.array(at.ravel(), mask=at.ravel() < 0))
            seen |= set(asked)
            more = bool(wanted(x, sims[:, -1], seen, 1)) if following else False
            done = sum(found.column("work").to_pylist()) + row["work"]
            return state.select(["block", "ids", "m"]).append_column("sims", pa.array([sims.tobytes()], pa.binary())).append_column(
                "others", pa.ListArray.from_arrays(pa.array([0, len(best)], pa.int32()), best)).append_column(
                "seen", pa.array([np.array(sorted(seen), np.int32).tobytes()], pa.binary())).append_column(
                "work", pa.array([done], pa.int64())).append_column("open", pa.array([more]))
        return merge

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                size = len(one.column("ids")[0].values) * k
                none = pa.nulls(size, id_list.value_type)
                yield pa.RecordBatch.from_arrays(
                    [*one.columns, pa.array([np.full(size, -np.inf).tobytes()], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), none), pa.array([b""], pa.binary()),
                     pa.array([0], pa.int64()), pa.array([True])], state_schema.names)

    state, rounds = b.table.mapInArrow(begun, state_schema), 0
    while True:
        width = ROUND_WIDTHS[min(rounds, len(ROUND_WIDTHS) - 1)]
        found = B.meet(b, B.requests(state, kind, asking(width)), search, found_schema)
        state = reliable_checkpoint(state.groupBy("block").cogroup(found.groupBy("sender")).applyInArrow(merging(width, 1), state_schema))
        rounds += 1
        if not state.where("open").limit(1).count():
            break

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, others = batch.column("ids")[i].values, batch.column("others")[i].values
                sims = np.frombuffer(batch.column("sims")[i].as_py(), np.float64)
                at = np.flatnonzero(sims > -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at // k)), pa.array((at % k + 1).astype(np.int32)), others.take(pa.array(at)), pa.array(sims[at])], schema.names)

    work = state.agg(F.sum("work")).first()[0]
    return (state.select("ids", "sims", "others").mapInArrow(listed, schema), PairWork(b.n * (b.n - 1), int(work), rounds))


def pairwise_similarity(vecs: DataFrame, threshold: float | None = None, top_k: int | None = None, id_col: str = "user_id",
                        vec_col: str = "z", block_size: int = 2048) -> DataFrame:
    """unordered pairs (src < dst) with their cosine, of at least `threshold`, or among the `top_k` of one of the two.
    The output of all pairs is quadratic; who wants it gives a threshold below -1."""
    if top_k is not None:
        near = similar_users_all(vecs, top_k, id_col, vec_col, block_size)
        if threshold is not None:
            near = near.where(F.col("similarity") >= threshold)
        a, o = F.col("user_id"), F.col("other_id")
        return (near.groupBy(F.least(a, o).alias("src"), F.greatest(a, o).alias("dst")).agg(F.max("similarity").alias("weight")))
    if threshold is None:
        raise ValueError("pairwise_similarity needs a threshold or top_k")
    return similarity_edges(vecs, threshold, id_col, vec_col, block_size)


def _edge_requests(b: B.Blocks, threshold: float) -> DataFrame:
    """For each block, the rows that may reach the threshold in each block it asks; for its own, all at once."""
    d, layout = b.d, b.layout

    def ask(row: dict, box: B.Outbox) -> Iterator[None]:
        i, x = row["block"], B.unpacked(row, d)
        reach = layout.bounds(x)[1] >= threshold
        box.put(i, i, None, np.zeros(0), np.zeros((0, d)))
        for c in np.flatnonzero(reach.any(axis=0)).tolist():
            rows = np.flatnonzero(reach[:, c])
            others = [j for j in np.flatnonzero(layout.centre_of == c).tolist() if j != i and layout.rows_of[j] and B.sends(i, j)]
            if others:
                ids, part = row["ids"].take(pa.array(rows)), x[rows]
                for j in others:
                    box.put(j, i, ids, rows, part)
                    yield

    return B.requests(b.table, b.id_type, ask)


def edge_work(vecs: DataFrame, threshold: float, id_col: str = "user_id", vec_col: str = "z", block_size: int = 2048,
              centres: int | None = None) -> PairWork:
    """How many of all pairs `similarity_edges` multiplies; the others are ruled out by their bounds."""
    b = _blocks(vecs, id_col, vec_col, block_size, centres)
    if b is None:
        return PairWork(0, 0, 0)
    size = b.layout.rows_of
    asked = _edge_requests(b, threshold).groupBy("slot", "sender").agg(F.sum(F.octet_length("rows") / 4).alias("rows"))
    of = b.table.sparkSession.createDataFrame([(j, int(s)) for j, s in enumerate(size)], "slot int, size long")
    own = F.col("slot") == F.col("sender")
    work = asked.join(of, "slot").agg(F.sum(F.when(own, F.col("size") * (F.col("size") - 1) / 2).otherwise(F.col("rows") * F.col("size")))).first()[0]
    return PairWork(b.n * (b.n - 1) // 2, int(work), 1)


def near_masks(held: B.Held, asked: B.Held, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """(ids, x, at, keep): which rows of `x` from `at` on, of the request or for its own rows the block, and rows of the
    block are pairs with a cosine of at least `threshold`; some rows of the request at a time."""
    own = held.block == asked.block
    x, ids = (held.x, held.ids) if own else (asked.x, asked.ids)
    for at in range(0, len(x), SLICE):
        s = x[at:at + SLICE] @ held.x.T
        keep = s >= threshold
        if own:  # ids are in order within a block
            keep &= np.arange(at, at + len(s))[:, None] < np.arange(s.shape[1])[None, :]
        if keep.any():
            yield ids, x, at, keep


def pair_cosines(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of the rows `x[i]` and `y[j]`, summed feature by feature: unlike those of a matrix product, whose last bits go by
    its shape, the cosine of two users is the same number in whatever block or cell they meet."""
    out = np.zeros(len(i))
    for a, b in zip(x.T, y.T):
        out += a.take(i) * b.take(j)
    return out


def near_pairs(held: B.Held, asked: B.Held, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, i, j, cosines): pairs of `ids[i]` and `held.ids[j]` with a cosine of at least `threshold`."""
    for ids, x, at, keep in near_masks(held, asked, threshold):
        i, j = np.nonzero(keep)
        yield ids, at + i, j, pair_cosines(x, held.x, at + i, j)


def similarity_edges(vecs: DataFrame, threshold: float = 0.7, id_col: str = "user_id",
                     vec_col: str = "z", block_size: int = 2048, centres: int | None = None) -> DataFrame:
    """G1: (src, dst, weight), src < dst, cosine >= threshold. Rows whose upper bound to a block lies
    below the threshold are never sent to it; only surviving pairs leave the task."""
    kind = vecs.schema[id_col].dataType
    schema = T.StructType([T.StructField("src", kind), T.StructField("dst", kind), T.StructField("weight", T.DoubleType())])
    b = _blocks(vecs, id_col, vec_col, block_size, centres)
    if b is None:
        return vecs.sparkSession.createDataFrame([], schema)

    def make() -> tuple[B.Kernel, Callable]:
        def kernel(held: B.Held, asked: B.Held) -> Iterator[pa.RecordBatch]:
            for ids, i, j, w in near_pairs(held, asked, threshold):
                left, right = ids[i], held.ids[j]
                first = left < right
                yield pa.RecordBatch.from_arrays([_typed(np.where(first, left, right), kind), _typed(np.where(first, right, left), kind),
                                                  pa.array(w)], schema.names)
        return kernel, lambda: iter(())

    return B.meet(b, _edge_requests(b, threshold), make, schema)


def cf_anomalies(vecs: DataFrame, threshold_percentile: float = 25.0, id_col: str = "user_id",
                 vec_col: str = "z") -> DataFrame:
    """(user_id, avg_similarity, cf_anomaly_score = 1 - avg, is_anomaly = avg < P)."""
    avg = avg_similarity(vecs, id_col, vec_col)
    (thr,) = exact_percentiles(avg, "avg_similarity", [threshold_percentile])
    flag = (F.col("avg_similarity") < F.lit(thr)) if thr is not None else F.lit(False)
    return avg.select("user_id", "avg_similarity",
                      (F.lit(1.0) - F.col("avg_similarity")).alias("cf_anomaly_score"),
                      F.coalesce(flag, F.lit(False)).alias("is_anomaly"))


def _locate(bins: list, r: int, below: int) -> tuple[float, float, int]:
    """The bracket (least, greatest, values below) of rank r among sorted bins (bin, n, least, greatest)."""
    for _, n, least, greatest in bins:
        if r < below + n:
            return least, greatest, below
        below += n
    raise RuntimeError("rank outside its bracket")


def _counting_pass(b: B.Blocks, brackets: list[tuple[float, float]], extremes: tuple[float, float] | None
                   ) -> tuple[list[int], list[list], tuple[float, float], int]:
    """One pass over the unique pairs: how many lie below each bracket, the bins (bin, n, least, greatest) inside it,
    least and greatest of all where `extremes` (bounds of both from above and below) are given, and pairs multiplied.

    Rows whose cosines to a block all lie on one side of every bracket are counted, not multiplied."""
    d, layout, nq = b.d, b.layout, len(brackets)
    lo, hi = np.array([x for x, _ in brackets]), np.array([x for _, x in brackets])

    def ask(row: dict, box: B.Outbox) -> Iterator[None]:
        i, x = row["block"], B.unpacked(row, d)
        low, high = layout.bounds(x)
        need = np.zeros(low.shape, bool)
        for p, q in zip(lo, hi):
            need |= (high >= p) & (low <= q)
        if extremes:
            need |= (low <= extremes[0]) | (high >= extremes[1])
        under = np.array([(~need & (high < p)).sum(axis=0) for p in lo])  # rows below the bracket, by centre
        counts = np.zeros(nq)
        box.put(i, i, None, np.zeros(0), np.zeros((0, d)))
        for c in range(len(layout.centres)):
            others = [j for j in np.flatnonzero(layout.centre_of == c).tolist() if j != i and layout.rows_of[j] and B.sends(i, j)]
            counts += under[:, c] * float(sum(layout.rows_of[j] for j in others))
            rows = np.flatnonzero(need[:, c])
            if len(rows):
                part = x[rows]
                for j in others:
                    box.put(j, i, None, rows, part)
                    yield
        box.put(-1 - i, i, None, np.zeros(0), counts)
        yield

    schema = "q int, bin int, n long, least double, greatest double"

    def make() -> tuple[B.Kernel, Callable]:
        below, work, ends = np.zeros(nq), [0], [np.inf, -np.inf]
        n, least, greatest = np.zeros((nq, HIST_BINS), np.int64), np.full((nq, HIST_BINS), np.inf), np.full((nq, HIST_BINS), -np.inf)

        def kernel(held: B.Held | None, asked: B.Held) -> Iterator[pa.RecordBatch]:
            nonlocal below
            if held is None:
                below = below + asked.x
                return
            own = held.block == asked.block
            x = held.x if own else asked.x
            for at in range(0, len(x), SLICE):
                s = x[at:at + SLICE] @ held.x.T
                v = s[np.arange(at, at + len(s))[:, None] < np.arange(s.shape[1])[None, :]] if own else s.ravel()
                if not v.size:
                    continue
                work[0] += v.size
                ends[0], ends[1] = min(ends[0], v.min()), max(ends[1], v.max())
                for q in range(nq):
                    below[q] += np.count_nonzero(v < lo[q])
                    inside = np.sort(v[(v >= lo[q]) & (v <= hi[q])])
                    if inside.size:
                        wide = hi[q] - lo[q]
                        at_bin = np.minimum(HIST_BINS - 1, ((inside - lo[q]) / wide * HIST_BINS).astype(np.int64)) if wide > 0 else np.zeros(inside.size, np.int64)
                        first = np.flatnonzero(np.r_[True, at_bin[1:] != at_bin[:-1]])
                        last, bins = np.r_[first[1:], inside.size] - 1, at_bin[first]
                        n[q, bins] += last - first + 1
                        least[q, bins] = np.minimum(least[q, bins], inside[first])
                        greatest[q, bins] = np.maximum(greatest[q, bins], inside[last])
            return
            yield

        def finish() -> Iterator[pa.RecordBatch]:
            q, bins = np.nonzero(n)
            rows = [np.r_[q, np.arange(nq), -1], np.r_[bins, np.full(nq + 1, -1)], np.r_[n[q, bins], below.astype(np.int64), work[0]],
                    np.r_[least[q, bins], np.full(nq, np.nan), ends[0]], np.r_[greatest[q, bins], np.full(nq, np.nan), ends[1]]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], ["q", "bin", "n", "least", "greatest"])

        return kernel, finish

    found = (B.meet(b, B.requests(b.table, b.id_type, ask), make, schema).groupBy("q", "bin")
             .agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest")).collect())
    under, inside, ends, work = [0] * nq, [[] for _ in brackets], (np.inf, -np.inf), 0
    for r in found:  # bins of the brackets only
        if r.q < 0:
            ends, work = (r.least, r.greatest), r.n
        elif r.bin < 0:
            under[r.q] = r.n
        else:
            inside[r.q].append((r.bin, r.n, r.least, r.greatest))
    return under, [sorted(x) for x in inside], ends, work


def _first_brackets(b: B.Blocks, shares: list[float]) -> tuple[list[tuple[float, float]], tuple[float, float]]:
    """For each share of the pairs a bracket that very likely holds it, and a least and greatest cosine, from the sample."""
    x = b.sample[:BRACKET_ROWS]
    v = np.sort((x @ x.T)[np.triu_indices(len(x), 1)])
    if not v.size:
        return [(-1.0 - COS_SLACK, 1.0 + COS_SLACK)] * len(shares), (2.0, -2.0)
    wide = 0.0 if len(x) == b.n else 2.0 / math.sqrt(len(x))
    at = lambda p: v[min(v.size - 1, max(0, int(p * v.size)))]
    return [(float(at(p - wide)) - COS_SLACK, float(at(p + wide)) + COS_SLACK) for p in shares], (float(v[0]), float(v[-1]))


def _pair_ranks(b: B.Blocks, ranks: list[int], n: int) -> tuple[dict[int, float], tuple[float, float], PairWork]:
    """Exact values at 0-based positions of the sorted unique-pair cosines, and their least and greatest.

    A rank's bracket becomes the bin that holds it, until least and greatest of the bin are equal."""
    first, extremes = _first_brackets(b, [r / n for r in ranks])
    state: dict[int, tuple[float, float, int | None]] = {r: (*iv, None) for r, iv in zip(ranks, first)}
    done: dict[int, float] = {}
    ends, work, passes = None, 0, 0
    while state or ends is None:
        brackets = sorted({(p, q) for p, q, _ in state.values()})
        under, inside, seen, multiplied = _counting_pass(b, brackets, extremes if ends is None else None)
        ends, work, passes = ends or seen, work + multiplied, passes + 1
        for r, (p, q, _) in list(state.items()):
            k = brackets.index((p, q))
            total = sum(x[1] for x in inside[k])
            if r < under[k]:  # the sample misled: look on the side where the rank is
                state[r] = (-1.0 - COS_SLACK, p, None)
            elif r >= under[k] + total:
                state[r] = (q, 1.0 + COS_SLACK, None)
            else:
                least, greatest, below = _locate(inside[k], r, under[k])
                if (least, greatest) == (p, q) and least < greatest:
                    raise RuntimeError(f"rank {r}: no progress between {p} and {q}")
                state[r] = (least, greatest, below)
                if least == greatest:
                    done[r] = least
                    del state[r]
    return done, ends, PairWork(n * passes, work, passes)


def similarity_statistics(vecs: DataFrame, id_col: str = "user_id", vec_col: str = "z",
                          block_size: int = 2048, centres: int | None = None) -> DataFrame:
    """mean, median, std (population), min, max, q25, q75 over the off-diagonal similarities,
    each unordered pair counted twice as in the full matrix."""
    return statistics_search(vecs, id_col, vec_col, block_size, centres)[0]


def statistics_search(vecs: DataFrame, id_col: str = "user_id", vec_col: str = "z", block_size: int = 2048,
                      centres: int | None = None) -> tuple[DataFrame, PairWork]:
    """F7 and what it cost. Moments are closed forms of the blocks: the sum of cosines is |S|^2 - sum |u|^2
    with S = sum u, that of their squares |G|^2 - sum |u|^4 with G = sum u u'. Quantiles are ranks, counted
    between bounds (see `_counting_pass`), in brackets that a sample suggests."""
    spark = vecs.sparkSession
    metrics = ["mean", "median", "std", "min", "max", "q25", "q75"]
    b = _blocks(vecs, id_col, vec_col, block_size, centres)
    if b is None or b.n < 2:
        return spark.createDataFrame([(m, None) for m in metrics], "metric string, value double"), PairWork(0, 0, 0)
    d = b.d

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d + d * d + 2)
        for batch in batches:
            for m in batch.column("m").to_pylist():
                x = np.frombuffer(m, np.float64).reshape(-1, d)
                sq = (x * x).sum(axis=1)
                total += np.concatenate([x.sum(axis=0), (x.T @ x).ravel(), [sq.sum(), (sq * sq).sum()]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "x"])

    sums = b.table.select("m").mapInArrow(summed, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    t = np.zeros(len(sums))  # d (d + 1) + 2 numbers
    for r in sums:
        t[r.i] = r.x
    n = b.n * (b.n - 1) // 2
    mean = ((t[:d] ** 2).sum() - t[-2]) / (2 * n)
    std = math.sqrt(max(0.0, ((t[d:-2] ** 2).sum() - t[-1]) / (2 * n) - mean * mean))
    targets = rank_targets(2 * n, [50, 25, 75])     # ordered off-diagonal entries
    vals, ends, work = _pair_ranks(b, sorted({x // 2 for lo, hi, _ in targets for x in (lo, hi)}), n)
    q = [interpolate(vals[lo // 2], vals[hi // 2], f) for lo, hi, f in targets]
    rows = [("mean", mean), ("median", q[0]), ("std", std), ("min", ends[0]), ("max", ends[1]), ("q25", q[1]), ("q75", q[2])]
    return spark.createDataFrame([(m, float(x)) for m, x in rows], "metric string, value double"), work


def detect_anomalies_cf(vecs: DataFrame, threshold_percentile: float = 25.0,
                        with_statistics: bool = False, show_top: int = 0,
                        id_col: str = "user_id", vec_col: str = "z"):
    """F8: CF anomalies, optional statistics and top list (score desc, id asc)."""
    res = cf_anomalies(vecs, threshold_percentile, id_col, vec_col)
    stats = similarity_statistics(vecs, id_col, vec_col) if with_statistics else None
    top = None
    if show_top > 0:
        top = res.orderBy(F.col("cf_anomaly_score").desc(), F.col("user_id").asc()).limit(show_top)
    return res, stats, top
