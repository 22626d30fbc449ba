import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rand_vectors, vec_frame
from stray.operators import cluster as K


def _np_silhouette(x, labels):
    x = np.asarray(x, float)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) if c != labels[i])
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_silhouette_and_inertia_fixture(spark):
    v = vec_frame(spark, [[1.0], [2.0], [3.0], [4.0], [10.0]])
    lab = v.withColumn("label", F.when(F.col("user_id") < 4, 0).otherwise(1))
    assert K.silhouette(lab, "label") == pytest.approx(0.617460, abs=1e-6)
    a = K.assign_clusters(v, [[2.5], [10.0]])
    assert K.inertia(a) == pytest.approx(5.0)
    st = {r["cluster"]: r for r in K.cluster_statistics(a).collect()}
    assert st[1]["std_distance"] is None and st[1]["size"] == 1


@pytest.mark.parametrize("block", [6, 1000])
def test_silhouette_blocked_equals_brute_force(spark, block):
    x = rand_vectors(45, 3, seed=9)
    labels = np.array([i % 4 for i in range(45)])
    labels[0] = 9                                  # a singleton cluster
    v = vec_frame(spark, x).withColumn("label", F.lit(0))
    lab = spark.createDataFrame([(i, int(l)) for i, l in enumerate(labels)], "user_id long, label int")
    v = vec_frame(spark, x).join(lab, "user_id")
    assert K.silhouette(v, "label", block_size=block) == pytest.approx(_np_silhouette(x, labels), abs=1e-9)


def test_lloyd_matches_numpy(spark):
    x = rand_vectors(50, 2, seed=12)
    v = vec_frame(spark, x)
    init = [list(r) for r in x[:3]]
    cents, _ = K.lloyd(v, init, 4)
    c = np.array(init)
    for _ in range(4):
        lab = np.argmin(((x[:, None, :] - c[None]) ** 2).sum(-1), axis=1)
        c = np.array([x[lab == k].mean(0) if (lab == k).any() else c[k] for k in range(3)])
    assert np.allclose(np.array(cents), c, atol=1e-12)


def test_too_few_users(spark):
    v = vec_frame(spark, [[1.0], [2.0]])
    with pytest.raises(ValueError):
        K.lowest_id_centroids(v, 3)
    with pytest.raises(ValueError):
        K.mllib_kmeans(v, 3, n_starts=1)


def test_mllib_best_of_n_and_optimal_k(spark):
    x = np.vstack([rand_vectors(20, 2, seed=1) + 8, rand_vectors(20, 2, seed=2) - 8])
    v = vec_frame(spark, x)
    fit = K.mllib_kmeans(v, 2, n_starts=3, max_iter=20)
    one = K.mllib_kmeans(v, 2, n_starts=1, max_iter=20, seed=43)
    assert fit.cost <= one.cost + 1e-9
    best, table = K.find_optimal_k(v, [2, 3, 4], init="lowest_ids", max_iter=10)
    rows = {r["k"]: r for r in table.collect()}
    assert best == max(rows, key=lambda k: (rows[k]["silhouette"], -k))
    assert best == 2


def test_sampled_best_of_starts(spark):
    x = np.vstack([rand_vectors(25, 2, seed=3) + 6, rand_vectors(25, 2, seed=4) - 6])
    v = vec_frame(spark, x)
    fits = K.best_of_starts(v, [2, 3], n_starts=4, max_iter=20)
    assert set(fits) == {2, 3} and fits[3].cost <= fits[2].cost + 1e-9
    c = np.array(fits[2].centroids)
    lab = np.argmin(((x[:, None, :] - c[None]) ** 2).sum(-1), axis=1)
    assert fits[2].cost == pytest.approx(((x - c[lab]) ** 2).sum())
    best, table = K.find_optimal_k(v, [2, 3, 4], init="sampled", n_starts=3, max_iter=20)
    assert best == 2 and table.count() == 3


def _blobs(n=400, d=3, k=6, seed=21):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(k, d))[rng.integers(0, k, n)] * 5 + rng.normal(size=(n, d))


def _np_lloyd(x, c, steps):
    c = np.array(c, float)
    for _ in range(steps):
        lab = ((x[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
        c = np.array([x[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(len(c))])
    return c


@pytest.mark.parametrize("rewrite", [1, 3, 100])
def test_bounded_runs_equal_plain_lloyd(spark, monkeypatch, rewrite):
    from stray.operators import kmeans as M
    monkeypatch.setattr(M, "REWRITE_STEPS", rewrite)
    monkeypatch.setattr(M, "BLOCK_ROWS", 90)
    x = _blobs()
    x[7] = x[8]                       # ties
    starts = [x[:4], x[10:17], np.vstack([x[:2], x[:1] * 0 + 1e6])]  # the last keeps an empty cluster
    rows = M.packed_rows(vec_frame(spark, x))
    fit = M.Bounded(rows, starts)
    got = fit.run(12, None)
    for c, s in zip(got, starts):
        assert np.allclose(c, _np_lloyd(x, s, 12), atol=1e-9)
    assert fit.inertia() == pytest.approx([((x[:, None, :] - c[None]) ** 2).sum(-1).min(1).sum() for c in got])
    if rewrite == 3:
        assert fit.work().computed < 0.7 * fit.work().plain


def test_d2_starts_spread_and_repeat(spark):
    from stray.operators import kmeans as M
    x = np.vstack([rand_vectors(40, 2, seed=s) * 0.1 + c for s, c in enumerate(([0, 0], [50, 0], [0, 50], [50, 50]))])
    v = vec_frame(spark, x)
    starts = M.d2_starts(M.packed_rows(v, range(6)), 4)
    again = M.d2_starts(M.packed_rows(v.repartition(5), range(6)), 4)
    for s in range(6):
        assert np.array_equal(starts[s], again[s])
        assert len({tuple((c // 25).clip(0).astype(int)) for c in starts[s]}) == 4  # one in each blob
    with pytest.raises(ValueError):
        M.d2_starts(M.packed_rows(vec_frame(spark, [[1.0]]), [1]), 2)
    same = M.d2_starts(M.packed_rows(vec_frame(spark, [[1.0]] * 3), [1]), 2)
    assert same[1].tolist() == [[1.0], [1.0]]


def test_best_of_d2_starts_finds_the_blobs(spark):
    x = _blobs(300, 2, 5, seed=3)
    fit = K.best_of_starts(vec_frame(spark, x), [5], n_starts=10, max_iter=30)[5]
    costs = [((x[:, None, :] - _np_lloyd(x, x[np.random.default_rng(s).choice(300, 5, False)], 30)[None]) ** 2).sum(-1).min(1).sum() for s in range(30)]
    assert fit.cost <= min(costs) * 1.01


def test_silhouette_of_many_panels_and_label_sets(spark, monkeypatch):
    monkeypatch.setattr(K, "PANEL_ROWS", 37)
    monkeypatch.setattr(K, "STREAM_ROWS", 11)
    x = rand_vectors(130, 3, seed=4)
    x[5] = x[6]
    labels = np.stack([np.arange(130) % 3, np.arange(130) % 40, (np.arange(130) > 0).astype(int)], axis=1)
    v = spark.createDataFrame([(i, x[i].tolist(), labels[i].tolist()) for i in range(130)], "user_id long, z array<double>, labs array<int>")
    got = K.silhouette_values(v, "labs", 3, block_size=16)
    assert got.count() == 130
    assert K.silhouette_scores(v, "labs", 3, block_size=16) == pytest.approx([_np_silhouette(x, labels[:, s]) for s in range(3)], abs=1e-9)
    with pytest.raises(ValueError):
        K.silhouette_scores(v.selectExpr("user_id", "z", "array(1) as labs"), "labs", 1)
