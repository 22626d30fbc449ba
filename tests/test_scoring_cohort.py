import pytest
from pyspark.sql import functions as F

from stray.config import PipelineConfig
from stray.operators import cohort as C
from stray.operators import scoring as A
from stray.plans.pipeline import run_pipeline
from stray.sources import fixtures as X


def test_minmax_equal_scores_and_weights(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.5)], "user_id long, s double")
    assert [r["s_norm"] for r in A.minmax_scores(df, ["s"]).collect()] == [0.0, 0.0]
    with pytest.raises(ValueError):
        A.normalize_weights(0, 0, 0)
    assert A.normalize_weights(1, 1, 2) == (0.25, 0.25, 0.5)


def _pipeline_frame(spark, sf, parts, reverse):
    ev = X.table(spark, sf, "events")
    feats = X.user_features_from_events(ev)
    feats = feats.orderBy(F.col("user_id").desc() if reverse else F.col("user_id")).repartition(parts)
    cfg = PipelineConfig(n_clusters=3, kmeans_init="lowest_ids", kmeans_max_iter=5, kmeans_tol=None,
                         pagerank_max_iter=10, pagerank_tol=None, show_summary=False, block_size=8)
    res = run_pipeline(feats, list(X.EVENT_FEATURES), cfg)
    return {r["user_id"]: (round(r["final_anomaly_score"], 9), r["rank"], r["cluster"])
            for r in res.results.collect()}


def test_pipeline_invariant_to_row_order_and_partitions(spark):
    sf = "/root/testdata/sf0.001"
    a = _pipeline_frame(spark, sf, 1, False)
    b = _pipeline_frame(spark, sf, 5, True)
    assert a == b
    assert sorted(v[1] for v in a.values()) == list(range(1, len(a) + 1))
    assert all(0.0 <= v[0] <= 1.0 for v in a.values())


def test_cohort_missing_log_and_no_common_users(spark):
    logs = {
        "logon": spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "user string, v int"),
        "device": spark.createDataFrame([("b", 1), ("c", 1)], "user string, v int"),
        "http": spark.createDataFrame([("c", 9), ("z", 1)], "user string, v int"),
    }
    res = C.cohort_reduce(logs, None, n_users=5, seed=42)
    assert sorted(r["user"] for r in res.sample.collect()) == ["b", "c"]
    rep = {r["log"]: (r["rows_before"], r["rows_after"]) for r in res.report.collect()}
    assert rep == {"logon": (3, 2), "device": (2, 2), "http": (2, 1)}
    logs["device"] = spark.createDataFrame([("q", 1)], "user string, v int")
    res = C.cohort_reduce(logs, None, n_users=5)
    assert res.n_sampled == 0
    assert all(r["rows_after"] == 0 for r in res.report.collect())


def test_sample_is_deterministic_and_bounded(spark):
    users = spark.createDataFrame([(i,) for i in range(100)], "user long")
    a = [r["user"] for r in C.sample_users(users, 10, 42).collect()]
    b = [r["user"] for r in C.sample_users(users.repartition(7), 10, 42).collect()]
    assert a == b and len(a) == 10
    assert C.sample_users(users, 500, 42).count() == 100


def test_sample_is_the_lowest_hashes_in_order(spark):
    import hashlib
    users = spark.createDataFrame([(i,) for i in range(300)], "user long")
    want = sorted(range(300), key=lambda i: hashlib.md5(f"7|{i}".encode()).hexdigest())[:40]
    assert [r["user"] for r in C.sample_users(users.repartition(5), 40, 7).collect()] == want


def test_each_log_is_read_twice_and_sizes_are_reported(spark, tmp_path):
    import os
    logs = {name: spark.createDataFrame([(f"u{i % m}", i) for i in range(400)], "user string, v int")
            for name, m in (("logon", 30), ("device", 20), ("file", 25), ("email", 40), ("http", 22))}
    reads = {}

    def counted(df, acc):
        def fn(batches):
            for b in batches:
                acc.add(b.num_rows)
                yield b
        return df.mapInArrow(fn, df.schema)

    for name, df in list(logs.items()):
        reads[name] = spark.sparkContext.accumulator(0)
        logs[name] = counted(df, reads[name])
    out = str(tmp_path / "out")
    res = C.cohort_reduce(logs, None, n_users=7, out_dir=out)
    rep = {r["log"]: r for r in res.report.collect()}
    assert all(a.value <= 2 * 400 for a in reads.values())
    users = {r["user"] for r in res.sample.collect()}
    assert len(users) == 7 and users <= {f"u{i}" for i in range(20)}
    for name, m in (("logon", 30), ("device", 20)):
        kept = sum(f"u{i % m}" in users for i in range(400))
        assert (rep[name]["rows_before"], rep[name]["rows_after"]) == (400, kept)
        size = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{out}/{name}.csv") for f in fs if not f.endswith(".crc"))
        assert rep[name]["mb_out"] == pytest.approx(size / 2 ** 20) and rep[name]["mb_in"] is None
    assert res.total_mb == pytest.approx(sum(r["mb_out"] for r in rep.values()))
