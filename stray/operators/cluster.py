"""K-Means user modelling (K1-K8).

Centroids are k x d numbers: they travel to executors as a literal
array-of-arrays inside the projection, so assignment is a narrow stage
(no join, no broadcast exchange). Centroid updates are a groupBy(cluster)
with partial aggregation, so a cluster holding a third of the users still
costs one row per map partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stray.functions.vectors import lit_vector, sq_dist
from stray.operators import blocks as B
from stray.operators import kmeans as M
from stray.session import bounded_batches, reliable_checkpoint

Centroids = list[list[float]]
#: Digits of the inertia by which starts are compared: starts that end in one clustering differ in rounding only.
COST_DIGITS = 6


def centroids_literal(centroids: Centroids):
    return F.array(*[lit_vector(c) for c in centroids])


def _argmin_cluster(vec_col: str, centroids: Centroids):
    """Squared distances to each centroid, as one array column."""
    return F.transform(centroids_literal(centroids), lambda c: sq_dist(vec_col, c))


def assign_clusters(vecs: DataFrame, centroids: Centroids, vec_col: str = "z",
                    keep_vector: bool = True) -> DataFrame:
    """K2/K3: nearest centroid (ties -> lowest index), squared and plain distance."""
    if not centroids:
        raise ValueError("Call fit() first")
    tmp = vecs.withColumn("_d2s", _argmin_cluster(vec_col, centroids))
    out = (tmp.withColumn("cluster", (F.array_position("_d2s", F.array_min("_d2s")) - 1).cast("int"))
           .withColumn("d2", F.array_min("_d2s"))
           .withColumn("cluster_distance", F.sqrt("d2"))
           .drop("_d2s"))
    return out if keep_vector else out.drop(vec_col)


def lowest_id_centroids(vecs: DataFrame, k: int, id_col: str = "user_id", vec_col: str = "z"
                        ) -> Centroids:
    """The k rows with the lowest ids (top-k: bounded by k)."""
    rows = vecs.orderBy(F.col(id_col).asc()).limit(k).select(vec_col).collect()
    if len(rows) < k:
        raise ValueError(f"too few users for {k} clusters")
    return [list(map(float, r[vec_col])) for r in rows]


def lloyd(vecs: DataFrame, init: Centroids, iterations: int, tol: float | None = None,
          vec_col: str = "z") -> tuple[Centroids, int]:
    """K1 (deterministic form): Lloyd steps from given centroids.
    An empty cluster keeps its centroid. Returns (centroids, steps run)."""
    cents = [list(c) for c in init]
    d = len(cents[0])
    steps = 0
    for _ in range(iterations):
        a = assign_clusters(vecs, cents, vec_col)
        rows = (a.groupBy("cluster")
                .agg(*[F.avg(F.col(vec_col)[i]).alias(f"c{i}") for i in range(d)]).collect())
        new = [list(c) for c in cents]
        for r in rows:
            new[r["cluster"]] = [float(r[f"c{i}"]) for i in range(d)]
        shift = max(sum((x - y) ** 2 for x, y in zip(o, n)) for o, n in zip(cents, new))
        cents = new
        steps += 1
        if tol is not None and shift <= tol:
            break
    return cents, steps


def lloyd_many(vecs: DataFrame, inits: Sequence[Centroids], iterations: int,
               tol: float | None = None, vec_col: str = "z", id_col: str = "user_id") -> list[Centroids]:
    """Several independent Lloyd runs (e.g. one per k) sharing each pass over the data, with distance
    bounds (see `kmeans`). A run that has converged (shift <= tol) is frozen."""
    rows = M.packed_rows(vecs, (), id_col, vec_col)
    return [c.tolist() for c in M.Bounded(rows, [np.array(i) for i in inits]).run(iterations, tol)]


#: MLlib fits that run at once.
MLLIB_FITS = 5


@dataclass(frozen=True)
class KMeansFit:
    k: int
    centroids: Centroids
    cost: float


def mllib_kmeans(vecs: DataFrame, k: int, seed: int = 42, n_starts: int = 10,
                 max_iter: int = 300, tol: float | None = 1e-4, vec_col: str = "z") -> KMeansFit:
    """K1: best (lowest training cost) of `n_starts` MLlib fits, seeds seed..seed+n-1."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    n = vecs.count()
    if n < k:
        raise ValueError(f"too few users ({n}) for {k} clusters")
    data = vecs.select(array_to_vector(vec_col).alias("features")).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        def fit(start: int) -> KMeansFit:
            km = KMeans(k=k, seed=start, maxIter=max_iter, featuresCol="features")
            if tol is not None:
                km = km.setTol(tol)
            model = km.fit(data)
            return KMeansFit(k, [list(map(float, c)) for c in model.clusterCenters()], float(model.summary.trainingCost))

        # Steps of a fit follow each other and wait for the scheduler more than they compute, so several fits run at once.
        with ThreadPoolExecutor(MLLIB_FITS) as pool:
            fits = list(pool.map(inheritable_thread_target(vecs.sparkSession)(fit), range(seed, seed + n_starts)))
        best = min(fits, key=lambda f: f.cost)  # of equals the first
        return best
    finally:
        data.unpersist()


def best_of_starts(vecs: DataFrame, ks: Sequence[int], n_starts: int = 10, seed: int = 42,
                   max_iter: int = 300, tol: float | None = 1e-4, id_col: str = "user_id",
                   vec_col: str = "z", starts: str = "d2") -> dict[int, KMeansFit]:
    """K1 for several k at once: n_starts seeded starts per k, every (k, start) run advancing in
    the same pass over the data; per k the run with the lowest inertia (to COST_DIGITS) wins, of
    equals the first. A run stops moving once its shift <= tol. Starts are D^2-weighted draws, or
    ("sampled") the k rows with the lowest md5('<seed>|<id>')."""
    seeds = list(range(seed, seed + n_starts))
    rows = M.packed_rows(vecs, seeds if starts == "d2" else (), id_col, vec_col)
    if rows.n < max(ks):
        raise ValueError(f"too few users ({rows.n}) for {max(ks)} clusters")
    if starts == "d2":
        first = M.d2_starts(rows, max(ks))
    elif starts == "sampled":
        first = {}
        for sd in seeds:
            key = F.md5(F.concat(F.lit(f"{sd}|"), F.col(id_col).cast("string")))
            got = vecs.orderBy(key, F.col(id_col)).limit(max(ks)).select(vec_col).collect()
            first[sd] = np.array([r[vec_col] for r in got], np.float64)
    else:
        raise ValueError(f"unknown starts {starts!r}")
    runs = [(k, sd) for k in ks for sd in seeds]
    fit = M.Bounded(rows, [first[sd][:k] for k, sd in runs])
    cents = fit.run(max_iter, tol)
    cost = fit.inertia()
    best: dict[int, KMeansFit] = {}
    for j, (k, _) in enumerate(runs):
        if k not in best or round(cost[j], COST_DIGITS) < round(best[k].cost, COST_DIGITS):
            best[k] = KMeansFit(k, cents[j].tolist(), cost[j])
    return best


def fit_centroids(vecs: DataFrame, k: int, init: str = "d2", seed: int = 42,
                  n_starts: int = 10, max_iter: int = 300, tol: float | None = 1e-4,
                  id_col: str = "user_id", vec_col: str = "z") -> Centroids:
    if init == "mllib":
        return mllib_kmeans(vecs, k, seed, n_starts, max_iter, tol, vec_col).centroids
    if init == "lowest_ids":
        cents, _ = lloyd(vecs, lowest_id_centroids(vecs, k, id_col, vec_col), max_iter, tol, vec_col)
        return cents
    if init in ("d2", "sampled"):
        return best_of_starts(vecs, [k], n_starts, seed, max_iter, tol, id_col, vec_col, init)[k].centroids
    raise ValueError(f"unknown init {init!r}")


def cluster_statistics(assigned: DataFrame) -> DataFrame:
    """K4: per cluster size, mean / sample std / max distance, rounded to 3."""
    return (assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).cast("bigint").alias("size"),
        F.round(F.avg("cluster_distance"), 3).alias("avg_distance"),
        F.round(F.stddev_samp("cluster_distance"), 3).alias("std_distance"),
        F.round(F.max("cluster_distance"), 3).alias("max_distance")))


def inertia(assigned: DataFrame) -> float:
    """K6: sum of squared distances to the own centroid."""
    return float(assigned.agg(F.sum("d2")).first()[0] or 0.0)


#: Rows that a task holds while all others stream past it, and cells of its sums.
PANEL_ROWS, PANEL_CELLS = 8192, 1 << 22
STREAM_ROWS = 256


def silhouette_values(vecs: DataFrame, labels_col: str, n_sets: int, id_col: str = "user_id",
                      vec_col: str = "z", block_size: int = 2048) -> DataFrame:
    """K5: (user_id, silhouettes): the exact Euclidean silhouette of every row for each of `n_sets`
    label sets held in array<int> `labels_col`.

    A task holds a panel of rows and their distance sums to every label, all other rows
    stream past it in packed blocks, and it emits one row for each of its users. A panel
    has at most PANEL_ROWS rows and PANEL_CELLS sums. The driver gets one count for each label."""
    spark = vecs.sparkSession
    bounded_batches(spark, B.BATCH_BYTES)
    base = vecs.select(F.col(id_col).alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("u"), F.col(labels_col).alias("labs"))
    counts: list[dict[int, int]] = [{} for _ in range(n_sets)]
    for r in base.select(F.posexplode("labs").alias("s", "label")).groupBy("s", "label").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.s][r.label] = r.n
    n = sum(counts[0].values())
    for c in counts:
        if not 2 <= len(c) <= n - 1:
            raise ValueError(f"silhouette needs 2 <= n_labels <= n_samples - 1, got {len(c)} labels for {n} samples")
    names = [np.array(sorted(c)) for c in counts]
    sizes = np.concatenate([[c[x] for x in sorted(c)] for c in counts]).astype(np.float64)
    begin = np.cumsum([0, *map(len, names)])
    cells = int(begin[-1])
    slots = spark.sparkContext.defaultParallelism
    rows = max(1, min(PANEL_ROWS, PANEL_CELLS // cells))
    panels = max(math.ceil(n / rows), min(slots, math.ceil(n / STREAM_ROWS)))
    blocks = panels * max(1, math.ceil(n / panels / block_size))
    kind = base.schema["id"].dataType

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        x, labels = B.pack(table, ("u", "labs"))
        code = np.stack([np.searchsorted(names[s], labels[:, s]) + begin[s] for s in range(n_sets)], axis=1)
        ids = table.column("id").combine_chunks()
        return pa.table({"block": table.column("block")[:1], "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                         "m": pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()),
                         "code": pa.array([code.astype(np.int32).tobytes()], pa.binary())})

    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("ids", T.ArrayType(kind)),
                           T.StructField("m", T.BinaryType()), T.StructField("code", T.BinaryType())])
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    table = reliable_checkpoint(base.select("*", block).groupBy("block").applyInArrow(packed, schema))
    out = T.StructType([T.StructField("user_id", kind), T.StructField("silhouettes", T.ArrayType(T.DoubleType()))])

    class Panel:
        def __init__(self) -> None:
            self.at, self.ids, self.parts, self.codes, self.end = {}, [], [], [], 0
            self.x = None

        def hold(self, block: int, ids: pa.Array, x: np.ndarray, code: np.ndarray) -> None:
            self.at[block] = self.end
            self.end += len(x)
            self.ids.append(ids)
            self.parts.append(x)
            self.codes.append(code)

        def meet(self, block: int, x: np.ndarray, code: np.ndarray) -> None:
            if not self.parts:  # a panel without rows of its own has nothing to sum
                return
            if self.x is None:
                self.x, self.code = np.concatenate(self.parts), np.concatenate(self.codes)
                self.sq, self.sums = (self.x * self.x).sum(axis=1), np.zeros((len(self.x), cells))
            for i in range(0, len(x), STREAM_ROWS):
                y, c = x[i:i + STREAM_ROWS], code[i:i + STREAM_ROWS]
                d = np.sqrt(np.maximum(self.sq[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (self.x @ y.T), 0.0))
                if block in self.at:
                    k = np.arange(len(y))
                    d[self.at[block] + i + k, k] = 0.0
                used, place = np.unique(c, return_inverse=True)
                hot = np.zeros((len(y), len(used)))
                hot[np.arange(len(y))[:, None], place.reshape(c.shape)] = 1.0
                self.sums[:, used] += d @ hot

        def values(self) -> pa.RecordBatch:
            i, sil = np.arange(len(self.x)), np.zeros((len(self.x), n_sets))
            for s in range(n_sets):
                own, size = self.code[:, s], sizes[begin[s]:begin[s + 1]]
                sums = self.sums[:, begin[s]:begin[s + 1]]
                mean = sums / size
                a = sums[i, own - begin[s]] / np.maximum(sizes[own] - 1, 1)
                mean[i, own - begin[s]] = np.inf
                b = mean.min(axis=1)
                most = np.maximum(a, b)
                sil[:, s] = np.where((sizes[own] > 1) & (most > 0), (b - a) / np.where(most > 0, most, 1.0), 0.0)
            flat = pa.array(sil.ravel())
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(self.ids), pa.ListArray.from_arrays(pa.array(np.arange(len(sil) + 1) * n_sets, pa.int32()), flat)], out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, panel = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                at, turn, block = (batch.column(c)[i].as_py() for c in ("slot", "turn", "block"))
                if at != slot:
                    if panel is not None and panel.parts:
                        yield panel.values()
                    slot, panel = at, Panel()
                ids = batch.column("ids")[i].values
                code = np.frombuffer(batch.column("code")[i].as_py(), np.int32).reshape(-1, n_sets)
                x = np.frombuffer(batch.column("m")[i].as_py(), np.float64).reshape(len(code), -1)
                panel.hold(block, ids, x, code) if turn == 0 else panel.meet(block, x, code)
        if panel is not None and panel.parts:
            yield panel.values()

    held = table.select((F.col("block") % panels).alias("slot"), F.lit(0).alias("turn"), "block", "ids", "m", "code")
    passing = table.select(F.explode(F.sequence(F.lit(0), F.lit(panels - 1))).alias("slot"), F.lit(1).alias("turn"), "block",
                           F.lit(None).cast(schema["ids"].dataType).alias("ids"), "m", "code")
    return (held.unionByName(passing).repartition(panels, "slot")
            .sortWithinPartitions("slot", "turn", "block").mapInArrow(run, out))


def silhouette_scores(vecs: DataFrame, labels_col: str, n_sets: int, id_col: str = "user_id",
                      vec_col: str = "z", block_size: int = 2048) -> list[float]:
    """K5: exact mean Euclidean silhouette for each of `n_sets` label sets held
    in array<int> `labels_col`, all sets in one pass."""
    each = silhouette_values(vecs, labels_col, n_sets, id_col, vec_col, block_size)
    row = each.agg(*[F.avg(F.col("silhouettes")[s]).alias(f"s{s}") for s in range(n_sets)]).first()
    return [float(row[f"s{s}"]) for s in range(n_sets)]


def silhouette(vecs: DataFrame, label_col: str, id_col: str = "user_id", vec_col: str = "z",
               block_size: int = 2048) -> float:
    tagged = vecs.withColumn("_labs", F.array(F.col(label_col).cast("int")))
    return silhouette_scores(tagged, "_labs", 1, id_col, vec_col, block_size)[0]


def fit_many(vecs: DataFrame, ks: Sequence[int], init: str = "d2", seed: int = 42, n_starts: int = 10,
             max_iter: int = 300, tol: float | None = 1e-4, id_col: str = "user_id", vec_col: str = "z") -> list[Centroids]:
    """Centroids for each k; all runs share their passes, but for MLlib, which fits one after another."""
    if init == "lowest_ids":
        first = lowest_id_centroids(vecs, max(ks), id_col, vec_col)
        return lloyd_many(vecs, [first[:k] for k in ks], max_iter, tol, vec_col, id_col)
    if init in ("d2", "sampled"):
        got = best_of_starts(vecs, ks, n_starts, seed, max_iter, tol, id_col, vec_col, init)
        return [got[k].centroids for k in ks]
    return [fit_centroids(vecs, k, init, seed, n_starts, max_iter, tol, id_col, vec_col) for k in ks]


def score_fits(vecs: DataFrame, ks: Sequence[int], fits: Sequence[Centroids], id_col: str = "user_id",
               vec_col: str = "z", block_size: int = 2048) -> tuple[int, DataFrame]:
    """(best k, frame of (k, inertia, silhouette)): one pass scores all label sets. Best = highest silhouette, first k on ties."""
    labs, d2 = [], []
    for cents in fits:
        d2s = _argmin_cluster(vec_col, cents)
        labs.append((F.array_position(d2s, F.array_min(d2s)) - 1).cast("int"))
        d2.append(F.array_min(d2s))
    tagged = vecs.select(F.col(id_col), F.col(vec_col), F.array(*labs).alias("_labs"),
                         F.array(*d2).alias("_d2"))
    tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        inert = tagged.agg(*[F.sum(F.col("_d2")[i]).alias(f"i{i}") for i in range(len(ks))]).first()
        sils = silhouette_scores(tagged, "_labs", len(ks), id_col, vec_col, block_size)
    finally:
        tagged.unpersist()
    rows = [(k, float(inert[f"i{i}"]), sils[i]) for i, k in enumerate(ks)]
    best = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return best, vecs.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def find_optimal_k(vecs: DataFrame, k_range: Sequence[int] = tuple(range(2, 11)),
                   init: str = "d2", seed: int = 42, n_starts: int = 10,
                   max_iter: int = 300, tol: float | None = 1e-4, id_col: str = "user_id",
                   vec_col: str = "z", block_size: int = 2048) -> tuple[int, DataFrame]:
    """K7: fit each k and score all fits; returns (best k, frame of (k, inertia, silhouette))."""
    ks = list(k_range)
    return score_fits(vecs, ks, fit_many(vecs, ks, init, seed, n_starts, max_iter, tol, id_col, vec_col), id_col, vec_col, block_size)


@dataclass(frozen=True)
class ClusterResult:
    k: int
    centroids: Centroids
    assigned: DataFrame            # id, z, cluster, d2, cluster_distance
    k_table: DataFrame | None      # (k, inertia, silhouette) when searched
    statistics: DataFrame          # K4 of `assigned`


def cluster_users(vecs: DataFrame, n_clusters: int | None = None, find_optimal: bool = False,
                  init: str = "d2", seed: int = 42, n_starts: int = 10, max_iter: int = 300,
                  tol: float | None = 1e-4, k_range: Sequence[int] = tuple(range(2, 11)),
                  id_col: str = "user_id", vec_col: str = "z", block_size: int = 2048
                  ) -> ClusterResult:
    """K8: optimal k when asked (it wins over n_clusters), else n_clusters, else 5. The search's own fit is used."""
    ks = list(k_range) if find_optimal else [n_clusters if n_clusters is not None else 5]
    fits = dict(zip(ks, fit_many(vecs, ks, init, seed, n_starts, max_iter, tol, id_col, vec_col)))
    k, table = ks[0], None
    if find_optimal:
        k, table = score_fits(vecs, ks, [fits[x] for x in ks], id_col, vec_col, block_size)
    assigned = assign_clusters(vecs, fits[k], vec_col)
    return ClusterResult(k, fits[k], assigned, table, cluster_statistics(assigned))
