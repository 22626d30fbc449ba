import os
import tempfile


from stray.config import PipelineConfig
from stray.operators import cohort as C
from stray.plans.pipeline import run_pipeline, write_outputs
from stray.sources import fixtures as X
from stray.sources.loader import extended_path, load_user_features, read_results, save_table
from stray.sources.logs import read_logs


def test_csv_round_trip_and_outputs(spark):
    d = tempfile.mkdtemp(prefix="stray-io-")
    feats = X.user_features_from_events(X.table(spark, "/root/testdata/sf0.001", "events"))
    src = os.path.join(d, "user_features.csv")
    save_table(feats.coalesce(1), src)
    df, cols = load_user_features(spark, src)
    assert sorted(cols) == sorted(X.EVENT_FEATURES)
    cfg = PipelineConfig(n_clusters=3, kmeans_init="lowest_ids", kmeans_max_iter=3, kmeans_tol=None,
                         pagerank_max_iter=5, pagerank_tol=None, show_summary=True)
    res = run_pipeline(df, cols, cfg)
    out = os.path.join(d, "anomalies.csv")
    write_outputs(res, out)
    back = read_results(spark, out)
    assert back.count() == feats.count()
    assert "cluster" not in back.columns
    ext = read_results(spark, extended_path(out))
    assert set(X.EVENT_FEATURES) <= set(ext.columns)
    assert res.summary.collect()[0]["n_users"] == feats.count()


def test_cohort_job_writes_and_reports_bytes(spark):
    d = tempfile.mkdtemp(prefix="stray-cohort-")
    ev = X.table(spark, "/root/testdata/sf0.001", "events")
    raw = os.path.join(d, "raw")
    for name, log in X.logs_from_events(ev).items():
        if name != "file":                       # a log missing from the set is skipped
            save_table(log.select("event_id", "user", "value"), os.path.join(raw, f"{name}.csv"))
    logs = read_logs(spark, raw)
    assert sorted(logs) == ["device", "email", "http", "logon"]
    psy = X.psychometric_from_customer(X.table(spark, "/root/testdata/sf0.001", "customer"))
    res = C.cohort_reduce(logs, psy, n_users=5, seed=42, out_dir=os.path.join(d, "out"),
                          target_size_mb=500)
    rep = {r["log"]: r for r in res.report.collect()}
    assert set(rep) == {"device", "email", "http", "logon", "psychometric"}
    assert all(r["mb_out"] is not None and r["mb_out"] > 0 for r in rep.values())
    assert res.within_target is True and res.n_sampled == 5
    kept = res.filtered["logon"].select("user").distinct().count()
    assert kept == 5
