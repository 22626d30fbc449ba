import numpy as np
import pytest

from helpers import collect_map
from stray.operators import graph as G


def _graph(spark, n, edges):
    nodes = spark.createDataFrame([(i,) for i in range(n)], "id long")
    e = spark.createDataFrame([(int(a), int(b), float(w)) for a, b, w in edges],
                              "src long, dst long, weight double")
    return nodes, e


def _np_pagerank(n, edges, alpha=0.85, iters=None, tol=1e-6):
    w = np.zeros((n, n))
    for a, b, x in edges:
        w[a, b] += x
        w[b, a] += x
    s = w.sum(1)
    a_mat = np.divide(w, s[:, None], out=np.zeros_like(w), where=s[:, None] > 0)
    x = np.full(n, 1.0 / n)
    dang = s == 0
    for _ in range(iters or 100):
        last = x
        x = alpha * (x @ a_mat + x[dang].sum() / n) + (1 - alpha) / n
        if iters is None and np.abs(x - last).sum() < n * tol:
            break
    return x


def test_no_edges(spark):
    nodes, e = _graph(spark, 4, [])
    res = G.detect_anomalies_graph(nodes, e)
    pr = collect_map(res.pagerank, "id", "pagerank")
    assert all(v == pytest.approx(0.25) for v in pr.values())
    deg = collect_map(res.degrees, "id", "degree_centrality")
    assert all(v == 0.0 for v in deg.values())
    sc = collect_map(res.scores, "user_id", "graph_anomaly_score")
    assert all(v == pytest.approx(1.0) for v in sc.values())


def test_single_node_degree_one(spark):
    nodes, e = _graph(spark, 1, [])
    assert G.degree_centrality(nodes, e).collect()[0]["degree_centrality"] == 1.0


@pytest.mark.parametrize("iters", [None, 20])
def test_pagerank_matches_power_iteration(spark, iters):
    rng = np.random.default_rng(7)
    n = 30
    edges = [(a, b, float(rng.uniform(0.7, 1))) for a in range(n) for b in range(a + 1, n)
             if rng.uniform() < 0.1]
    nodes, e = _graph(spark, n, edges)
    got = collect_map(G.pagerank(nodes, e, max_iter=iters or 100, tol=None if iters else 1e-6),
                      "id", "pagerank")
    want = _np_pagerank(n, edges, iters=iters)
    assert [got[i] for i in range(n)] == pytest.approx(list(want), abs=1e-12)
    assert sum(got.values()) == pytest.approx(1.0)


def test_pagerank_not_converged(spark):
    nodes, e = _graph(spark, 3, [(0, 1, 1.0), (1, 2, 0.8)])
    with pytest.raises(G.PageRankNotConverged):
        G.pagerank(nodes, e, max_iter=1, tol=1e-12)


def test_components_match_union_find(spark):
    rng = np.random.default_rng(11)
    n = 60
    edges = [(a, b, 1.0) for a in range(n) for b in range(a + 1, n) if rng.uniform() < 0.025]
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for a, b, _ in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for i in range(n):
        comp.setdefault(find(i), []).append(i)
    want = {i: min(m) for m in comp.values() for i in m}
    nodes, e = _graph(spark, n, edges)
    got = collect_map(G.connected_components(nodes, e), "id", "component")
    assert got == want
    st = G.graph_statistics(nodes, e, G.connected_components(nodes, e)).collect()[0]
    assert st["n_components"] == len(comp) and st["n_edges"] == len(edges)
    assert st["density"] == pytest.approx(2 * len(edges) / (n * (n - 1)))


def test_isolated_nodes_order(spark):
    nodes, e = _graph(spark, 5, [(0, 1, 1.0), (1, 2, 1.0)])
    got = [r["user_id"] for r in G.isolated_nodes(G.degree_centrality(nodes, e), 3).collect()]
    assert got == [3, 4, 0]


def _random_graph(n, p, seed):
    rng = np.random.default_rng(seed)
    return [(a, b, float(rng.uniform(0.7, 1))) for a in range(n) for b in range(a + 1, n) if rng.uniform() < p]


def _components(n, edges):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for a, b, _ in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in range(n)}


def test_hub_graph(spark):
    """One node with all others beside it, and a second component of pairs."""
    n = 3000
    edges = [(0, i, 0.7 + i % 3 / 10) for i in range(1, 2000)] + _random_graph(60, 0.1, 4) + [(i, i + 1, 0.8) for i in range(2000, n - 1, 2)]
    nodes, e = _graph(spark, n, edges)
    e = e.repartition(11)
    got = collect_map(G.pagerank(nodes, e, max_iter=12, tol=None), "id", "pagerank")
    assert [got[i] for i in range(n)] == pytest.approx(list(_np_pagerank(n, edges, iters=12)), abs=1e-12)
    assert collect_map(G.connected_components(nodes, e), "id", "component") == _components(n, edges)


def test_no_task_gets_a_hub(spark):
    """Rows of a hub are dealt to lots: the largest partition of a join has about its fair share."""
    from pyspark.sql import functions as F
    from stray.operators.spread import dealt, hubs_of, repeated
    rows = spark.range(0, 80_000, 1, 8).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("u"), F.col("id").alias("v"))
    counts = rows.groupBy(F.col("u").alias("key")).agg(F.count(F.lit(1)).alias("c"))
    hubs = hubs_of(counts, 80_000)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 1 <= hubs.count <= 16 * parts
    per_task = [r["n"] for r in dealt(rows, "u", "v", hubs).repartition(parts, "u", "lot").groupBy(F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    assert max(per_task) < 2 * 80_000 / parts
    own = counts.select(F.col("key").alias("u"), "c")
    joined = dealt(rows, "u", "v", hubs).join(repeated(own, "u", hubs), ["u", "lot"])
    assert joined.count() == 80_000 and joined.where("u = 7 and c <> 40001").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_chains_and_random_graphs(spark, seed):
    rng = np.random.default_rng(seed)
    n = 700
    perm = rng.permutation(n)
    edges = [(int(min(a, b)), int(max(a, b)), 1.0) for a, b in zip(perm[:300], perm[1:300])] + _random_graph(n, 0.0006, seed)
    nodes, e = _graph(spark, n, edges)
    assert collect_map(G.connected_components(nodes, e.repartition(9)), "id", "component") == _components(n, edges)


def test_forest_keeps_components():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 500, 400), rng.integers(0, 500, 400)
    want = _components(500, [(x, y, 1) for x, y in zip(a.tolist(), b.tolist())])
    u, v = G.forest(a, b)
    assert len(u) == len(set(u.tolist())) and all(want[x] == y for x, y in zip(u.tolist(), v.tolist()))
    assert set(u.tolist()) == {i for i in set(a.tolist()) | set(b.tolist()) if want[i] != i}
    assert len(G.forest(a[:0], b[:0])[0]) == 0


def test_graph_analysis_in_one_call(spark):
    from helpers import rand_vectors, vec_frame
    v = vec_frame(spark, rand_vectors(40, 3, seed=2))
    res = G.detect_anomalies(v, 0.6, show_top=4)
    assert res.top.count() == 4 and res.edges.count() == res.statistics.first()["n_edges"]
    scores = sorted(((-r["graph_anomaly_score"], r["user_id"]) for r in res.scores.collect()))
    assert [r["user_id"] for r in res.top.collect()] == [u for _, u in scores[:4]]


def test_pagerank_joins_nodes_of_cells_not_edges(spark, monkeypatch):
    """Dense blocks, a hub and lone nodes over many cells; repeated and unknown nodes count as before."""
    monkeypatch.setattr(G, "CELL_EDGES", 500)
    n = 400
    edges = [(a, b, 0.7 + (a * b % 10) / 40) for blk in range(0, 200, 50) for a in range(blk, blk + 50) for b in range(a + 1, blk + 50)]
    edges += [(0, i, 0.9) for i in range(200, 390)]
    nodes, e = _graph(spark, n, edges)
    got = collect_map(G.pagerank(nodes, e.coalesce(1), max_iter=8, tol=None), "id", "pagerank")
    assert [got[i] for i in range(n)] == pytest.approx(list(_np_pagerank(n, edges, iters=8)), abs=1e-12)
    cells = G.packed_cells(e.coalesce(1)).df
    assert cells.count() >= len(edges) // 500
    # numbers that a step sends: far below two for each edge
    assert cells.selectExpr("sum(size(ids))").first()[0] < len(edges) / 4
    assert G.packed_cells(e.limit(0)).df.count() == 0
    odd = spark.createDataFrame([(None, 1, 0.8), (1, 2, 0.9), (2, 99, 0.7)], "src long, dst long, weight double")
    few = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    # shares of 1: 0.8 of 1.7 go to no node and 0.9 to 2; of each row 2: 0.9 of 1.6 to 1; the null row is dangling
    r = sorted((x["id"] or 0, x["pagerank"]) for x in G.pagerank(few, odd, max_iter=1, tol=None).collect())
    lone = 0.85 * 0.25 / 4 + 0.15 / 4
    assert [i for i, _ in r] == [0, 1, 2, 2]
    assert [v for _, v in r] == pytest.approx([lone, lone + 0.85 * 2 * 0.25 * 0.9 / 1.6, *[lone + 0.85 * 0.25 * 0.9 / 1.7] * 2])


def test_similarity_graph_is_packed_by_the_pair_kernel(spark, monkeypatch):
    """Cells hold the edges of `similarity_edges`, every operator gives the same from them, and no step shuffles a cell."""
    from helpers import rand_vectors, vec_frame
    from stray.operators import similarity as S
    monkeypatch.setattr(G, "CELL_EDGES", 300)
    v = vec_frame(spark, [*rand_vectors(150, 3, seed=5), [0.0, 0.0, 0.0]], ids=[*range(1000, 1150), 7])
    nodes = v.selectExpr("user_id AS id")
    rows = S.similarity_edges(v, 0.6, block_size=16)
    packed = G.similarity_cells(v, 0.6, block_size=16)
    want = {(r.src, r.dst): r.weight for r in rows.collect()}
    got = {(r.src, r.dst): r.weight for r in packed.rows().collect()}
    assert got == want and len(want) == packed.count() == packed.rows().count() > 900
    per_cell = packed.cells.df.selectExpr("size(ids) = size(array_distinct(ids)) AS once", "n").collect()
    assert len(per_cell) > 3 and all(r.once and r.n < 2 * 300 for r in per_cell)
    for f in (lambda e: G.pagerank(nodes, e, max_iter=5, tol=None), lambda e: G.degree_centrality(nodes, e),
              lambda e: G.connected_components(nodes, e)):
        a, b = (sorted(f(e).collect()) for e in (rows, packed))
        assert len(a) == 151 and [tuple(r) for r in a] == [pytest.approx(tuple(r), abs=1e-12) for r in b]
    none = G.similarity_cells(v.limit(0), 0.6)
    assert none.count() == 0 and none.rows().count() == 0
    # what a step sends is dealt as the cells' buckets are
    plans, sums = [], G.cell_sums

    def seen(cells):
        if "sent" in cells.columns:
            plans.append(cells._jdf.queryExecution().executedPlan().toString())
        return sums(cells)

    monkeypatch.setattr(G, "cell_sums", seen)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        G.pagerank(nodes, rows, max_iter=1, tol=None)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert [p.count("Exchange hashpartitioning(cell") for p in plans] == [1]


def test_dense_cells_hold_a_bit_for_each_pair(spark):
    """Weights of dense requests are not written; sparse ones stay lists; every operator reads both alike."""
    from helpers import rand_vectors, vec_frame
    from stray.operators import similarity as S
    v = vec_frame(spark, rand_vectors(400, 3, seed=8))
    nodes = v.selectExpr("user_id AS id")
    kinds = set()
    for threshold in (0.5, 0.97):
        rows, packed = S.similarity_edges(v, threshold, block_size=128, centres=4), G.similarity_cells(v, threshold, block_size=128, centres=4)
        want = {(r.src, r.dst): r.weight for r in rows.collect()}
        assert {(r.src, r.dst): r.weight for r in packed.rows().collect()} == pytest.approx(want, abs=1e-12)
        cells = packed.cells.df
        kinds |= {r.dense for r in cells.selectExpr("w IS NULL AS dense").distinct().collect()}
        size = cells.selectExpr(*[f"coalesce(sum(octet_length({c})), 0) AS {c}" for c in cells.columns if c in ("i", "j", "w", "far", "m")]).first()
        assert len(want) == packed.count() and (threshold > 0.5 or sum(size) < 12 * len(want) / 2)
        of = [lambda e: G.pagerank(nodes, e, max_iter=2, tol=None), lambda e: G.degree_centrality(nodes, e)]
        for f in of + [lambda e: G.connected_components(nodes, e)] * (threshold == 0.5):
            a, b = (sorted(f(e).collect()) for e in (rows, packed))
            assert [tuple(r) for r in a] == [pytest.approx(tuple(r), abs=1e-12) for r in b]
    assert kinds == {True, False}
