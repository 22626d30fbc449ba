import numpy as np
import pytest

from helpers import collect_map, cosine_matrix, rand_vectors, vec_frame
from stray.operators import similarity as S



def test_zero_vector_and_identical_users(spark):
    x = [[1.0, 2.0], [1.0, 2.0], [0.0, 0.0], [-3.0, 1.0]]
    v = vec_frame(spark, x)
    edges = S.pairwise_similarity(v, -2.0).collect()
    sim = {(r["src"], r["dst"]): r["weight"] for r in edges}
    assert sim[(0, 1)] == pytest.approx(1.0)
    assert sim[(0, 2)] == 0.0 and sim[(2, 3)] == 0.0
    cf = {r["user_id"]: r for r in S.cf_anomalies(v).collect()}
    assert cf[2]["avg_similarity"] == 0.0 and cf[2]["cf_anomaly_score"] == 1.0


def test_one_user_gives_null(spark):
    v = vec_frame(spark, [[1.0, 2.0]])
    assert S.avg_similarity(v).collect()[0]["avg_similarity"] is None
    assert S.global_similarity(v).collect()[0]["avg_similarity"] is None


def test_closed_form_equals_pairs(spark):
    x = rand_vectors(60, 5, seed=1)
    x[7] = 0.0
    v = vec_frame(spark, x)
    s = cosine_matrix(x)
    np.fill_diagonal(s, 0.0)
    want = s.sum(1) / (len(x) - 1)
    got = collect_map(S.avg_similarity(v), "user_id", "avg_similarity")
    assert [got[i] for i in range(len(x))] == pytest.approx(list(want), abs=1e-12)
    g = S.global_similarity(v).collect()[0][0]
    assert g == pytest.approx(s.sum() / (len(x) * (len(x) - 1)), abs=1e-12)


@pytest.mark.parametrize("block", [7, 16, 1000])
def test_blocked_edges_equal_brute_force(spark, block):
    x = rand_vectors(80, 4, seed=2)
    v = vec_frame(spark, x, ids=[i * 3 + 1 for i in range(80)])
    s = cosine_matrix(x)
    want = {(i * 3 + 1, j * 3 + 1) for i in range(80) for j in range(i + 1, 80) if s[i, j] >= 0.5}
    got = {(r["src"], r["dst"]) for r in S.similarity_edges(v, 0.5, block_size=block).collect()}
    assert got == want
    allp = S.pairwise_similarity(v, -2.0, block_size=block).count()
    assert allp == 80 * 79 // 2


@pytest.mark.parametrize("block", [9, 1000])
def test_top_k_all_users(spark, block):
    x = rand_vectors(40, 3, seed=4)
    v = vec_frame(spark, x)
    s = cosine_matrix(x)
    got = S.similar_users_all(v, 3, block_size=block).collect()
    by = {}
    for r in got:
        by.setdefault(r["user_id"], []).append((r["rank"], r["other_id"]))
    for i in range(40):
        order = sorted([j for j in range(40) if j != i], key=lambda j: (-s[i, j], j))[:3]
        assert [o for _, o in sorted(by[i])] == order
    one = S.similar_users(v, 5, 3).collect()
    order = sorted([j for j in range(40) if j != 5], key=lambda j: (-s[5, j], j))[:3]
    assert [r["user_id"] for r in one] == order


def test_similarity_statistics_with_narrowing(spark, monkeypatch):
    x = rand_vectors(70, 3, seed=5)
    v = vec_frame(spark, x)
    s = cosine_matrix(x)
    off = s[~np.eye(len(x), dtype=bool)]
    monkeypatch.setattr(S, "HIST_BINS", 8)
    st = collect_map(S.similarity_statistics(v, block_size=16), "metric", "value")
    assert st["mean"] == pytest.approx(off.mean(), abs=1e-12)
    assert st["std"] == pytest.approx(off.std(), abs=1e-12)
    assert st["median"] == pytest.approx(np.median(off), abs=1e-12)
    assert st["q25"] == pytest.approx(np.percentile(off, 25), abs=1e-12)
    assert st["q75"] == pytest.approx(np.percentile(off, 75), abs=1e-12)
    assert st["min"] == pytest.approx(off.min()) and st["max"] == pytest.approx(off.max())


def test_top_k_ties_break_by_id(spark):
    x = [[1.0, 0.0]] * 6 + [[0.0, 1.0]] * 3      # many exact ties
    v = vec_frame(spark, x)
    s = cosine_matrix(x)
    for block in (2, 100):
        got = S.similar_users_all(v, 4, block_size=block).collect()
        by = {}
        for r in got:
            by.setdefault(r["user_id"], []).append((r["rank"], r["other_id"]))
        for i in range(len(x)):
            order = sorted([j for j in range(len(x)) if j != i], key=lambda j: (-s[i, j], j))[:4]
            assert [o for _, o in sorted(by[i])] == order


def test_pairs_need_a_threshold_or_k(spark):
    x = rand_vectors(30, 3, seed=6)
    v = vec_frame(spark, x)
    with pytest.raises(ValueError):
        S.pairwise_similarity(v)
    s = cosine_matrix(x)
    near = {tuple(sorted((i, j))) for i in range(30) for j in sorted((j for j in range(30) if j != i), key=lambda j: (-s[i, j], j))[:2]}
    got = {(r["src"], r["dst"]): r["weight"] for r in S.pairwise_similarity(v, top_k=2).collect()}
    assert set(got) == near and all(got[p] == pytest.approx(s[p]) for p in near)
    both = S.pairwise_similarity(v, 0.9, 2).collect()
    assert {(r["src"], r["dst"]) for r in both} == {p for p in near if s[p] >= 0.9}


def directed(n=900, d=5, seed=11):
    """Rows around a few directions, a hot direction, opposite and zero vectors."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(12, d))[rng.integers(0, 12, n)] + rng.normal(scale=0.15, size=(n, d))
    x[:n // 3] = x[0]
    x[-40:-20] = -x[:20]
    x[-20:] = 0.0
    return x[rng.permutation(n)]


@pytest.mark.parametrize("threshold", [-0.5, 0.0, 0.7, 0.99])
def test_pruned_edges_equal_all_pairs(spark, threshold):
    x = directed()
    v, s = vec_frame(spark, x), cosine_matrix(x)
    i, j = np.triu_indices(len(x), 1)
    close = np.abs(s[i, j] - threshold) < 1e-9  # decided by rounding
    want = {(a, b) for a, b in zip(i[(s[i, j] >= threshold) & ~close].tolist(), j[(s[i, j] >= threshold) & ~close].tolist())}
    edges = S.similarity_edges(v, threshold, block_size=64).collect()
    got = {(r["src"], r["dst"]) for r in edges}
    assert len(got) == len(edges) and not want - got
    assert all(abs(s[p] - threshold) < 1e-9 for p in got - want)
    work = S.edge_work(v, threshold, block_size=64)
    assert work.pairs == len(i) and len(got) <= work.multiplied <= work.pairs
    if threshold >= 0.7:
        assert work.multiplied < 0.5 * work.pairs


@pytest.mark.parametrize("k", [1, 7])
def test_best_first_search_equals_all_pairs(spark, k):
    x = directed(600)
    v, s = vec_frame(spark, x), cosine_matrix(x)
    got, work = S.top_k_search(v, k, block_size=32, centres=20)
    by = {}
    for r in got.collect():
        by.setdefault(r["user_id"], {})[r["rank"]] = (r["other_id"], r["similarity"])
    for i in range(len(x)):
        best = np.sort(np.delete(s[i], i))[::-1][:k]
        assert sorted(by[i]) == list(range(1, k + 1))
        assert [by[i][r][1] for r in range(1, k + 1)] == pytest.approx(list(best), abs=1e-12)
        assert len({o for o, _ in by[i].values()} - {i}) == k
        assert all(s[i, o] == pytest.approx(w, abs=1e-12) for o, w in by[i].values())
    assert work.pairs == 600 * 599 and 0 < work.multiplied <= work.pairs + 600


def test_search_multiplies_few_pairs_of_separate_directions(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(30, 6))[np.arange(1500) % 30] + rng.normal(scale=0.05, size=(1500, 6))
    v = vec_frame(spark, x)
    _, work = S.top_k_search(v, 5, block_size=256, centres=30)
    assert work.multiplied < 0.25 * work.pairs
    stats, counted = S.statistics_search(v, block_size=256, centres=30)
    s = cosine_matrix(x)[np.triu_indices(1500, 1)]
    got = collect_map(stats, "metric", "value")
    want = {"mean": s.mean(), "std": s.std(), "min": s.min(), "max": s.max(), "median": np.median(s),
            "q25": np.percentile(np.r_[s, s], 25), "q75": np.percentile(np.r_[s, s], 75)}
    assert got == pytest.approx(want, abs=1e-12)
    assert counted.multiplied < counted.pairs and counted.passes <= 4


def test_statistics_of_hot_directions_and_small_tables(spark):
    x = directed(500)
    s = cosine_matrix(x)[np.triu_indices(500, 1)]
    got = collect_map(S.similarity_statistics(vec_frame(spark, x), block_size=64), "metric", "value")
    assert [got[m] for m in ("mean", "std", "min", "max", "median")] == pytest.approx(
        [s.mean(), s.std(), s.min(), s.max(), np.median(s)], abs=1e-9)
    two = collect_map(S.similarity_statistics(vec_frame(spark, [[1.0, 0.0], [1.0, 1.0]])), "metric", "value")
    assert two["median"] == two["min"] == pytest.approx(0.5 ** 0.5) and two["std"] == pytest.approx(0.0, abs=1e-7)
    assert S.similarity_statistics(vec_frame(spark, [[1.0, 0.0]])).where("value is null").count() == 7


def test_edges_are_not_written_before_they_are_read(spark, tmp_path):
    """Edges grow with the square of the users; the query leaves no table of them in the shared folder."""
    from pathlib import Path

    from stray.plans.catalog import q_similarity_edges
    from stray.session import checkpoint_dir
    rng = np.random.default_rng(3)
    kinds = ("signup", "purchase", "error", "view", "click")
    rows = []
    for user in range(600):
        for _ in range(4 + 4 * (user % 2)):
            rows.append((len(rows), user, kinds[user % 2 + int(rng.integers(0, 2))], float(rng.uniform(1, 2) + 90 * (user % 2))))
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double")
    events.selectExpr("event_id", "timestamp_seconds(event_id) AS ts", "user_id", "event_type", "value", "'' AS props").write.parquet(
        str(tmp_path / "events.parquet"))
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = {f for f in folder.rglob("*") if f.is_file()}
    n = len(q_similarity_edges(spark, str(tmp_path)).collect())
    kept = sum(f.stat().st_size for f in folder.rglob("*") if f.is_file() and f not in before)
    assert n > 50_000 and kept < 4 * n


def test_a_cosine_has_the_same_bits_in_every_block(spark):
    v = vec_frame(spark, rand_vectors(120, 7, seed=2))
    many, few = ({(r["src"], r["dst"]): r["weight"] for r in S.similarity_edges(v, 0.3, block_size=size).collect()} for size in (8, 2048))
    assert many == few and len(many) > 500
