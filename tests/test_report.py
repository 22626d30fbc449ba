import numpy as np
import pytest

from stray.plans import report as R


def _results(spark, scores):
    rows = [(i, float(s), r + 1) for r, (i, s) in
            enumerate(sorted(enumerate(scores), key=lambda t: (-t[1], t[0])))]
    return spark.createDataFrame(rows, "user_id long, final_anomaly_score double, rank long")


def test_overview_and_threshold(spark):
    res = _results(spark, [1, 2, 3, 4, 10])
    ov = R.report_overview(res).collect()[0]
    assert ov["n_users"] == 5 and ov["max_score"] == 10.0 and ov["n_anomalies"] == 1
    th = {r["position"]: r for r in R.report_threshold(res).collect()}
    assert th[0]["is_anomaly"] and not th[1]["is_anomaly"]
    assert th[0]["threshold"] == pytest.approx(7.6)


def test_histogram_keeps_empty_bins(spark):
    res = _results(spark, [0.0, 0.1, 1.0])
    h = sorted(R.report_histogram(res, bins=10).collect(), key=lambda r: r["bin"])
    assert len(h) == 10 and sum(r["count"] for r in h) == 3
    assert h[0]["count"] == 1 and h[1]["count"] == 1 and h[9]["count"] == 1
    assert h[0]["bin_lo"] == 0.0 and h[9]["bin_hi"] == pytest.approx(1.0)
    flat = R.report_histogram(_results(spark, [2.0, 2.0]), bins=5).collect()
    assert sum(r["count"] for r in flat) == 2


def test_top_bars_drawing_order_and_detail(spark):
    res = _results(spark, [5, 9, 7, 1]).withColumn("cluster", __import__("pyspark.sql.functions",
                                                                          fromlist=["lit"]).lit(0))
    bars = sorted(R.report_top_bars(res, 3).collect(), key=lambda r: r["position"])
    assert [r["user_id"] for r in bars] == ["0", "2", "1"]           # lowest of the top 3 first
    det = R.report_detail(res, 2).collect()
    assert [r["user_id"] for r in det] == [1, 2] and "cluster" in det[0].asDict()


def test_correlation_guards_constant_column(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=50)
    rows = [(float(a), float(2 * a + 1), 3.0) for a in x]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    corr = {(r["x"], r["y"]): r["corr"] for r in R.report_correlation(df).collect()}
    assert corr[("a", "b")] == pytest.approx(1.0)
    assert corr[("a", "c")] is None and corr[("c", "c")] is None
    assert len(corr) == 9


def test_correlation_of_many_columns_with_gaps_and_large_means(spark, monkeypatch):
    import pandas as pd
    from stray.functions import moments
    monkeypatch.setattr(moments, "FAN_IN", 3)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 7)) @ rng.normal(size=(7, 7)) + 1e6
    x[rng.uniform(size=x.shape) < 0.2] = np.nan
    x[:, 5] = 0.1                                   # constant
    x[:880, 6] = np.nan
    names = ["a", "b.c", "d`e", "f", "g", "h", "i"]
    pdf = pd.DataFrame(x, columns=names)
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"`{n.replace('`', '``')}` double" for n in names)).repartition(13)
    m = moments.co_moments(df.toDF(*[f"c{i}" for i in range(7)]), [f"c{i}" for i in range(7)])
    want = pdf.corr().to_numpy()
    got = m.correlation()
    ok = ~np.isnan(want) & (np.arange(7) != 5)[:, None] & (np.arange(7) != 5)[None, :]
    assert np.allclose(got[ok], want[ok], atol=1e-9) and np.isnan(got[5]).all() and np.isnan(got[:, 5]).all()
    assert m.n[0, 1] == (~np.isnan(x[:, 0]) & ~np.isnan(x[:, 1])).sum()
    one = {(r["x"], r["y"]): r["corr"] for r in R.report_correlation(df, ["a", "b.c"]).collect()}
    assert one[("a", "b.c")] == pytest.approx(want[0, 1], abs=1e-9)
    assert all(r["corr"] is None for r in R.report_correlation(df.limit(0), ["a", "f"]).collect())


def test_correlation_of_300_columns(spark):
    import time
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 300))
    x[:, 1] = x[:, 0] * 2
    df = spark.createDataFrame([r.tolist() for r in x], ", ".join(f"c{i} double" for i in range(300)))
    df = df.repartition(4)
    begun = time.time()
    got = R.report_correlation(df)
    assert got.count() == 90_000 and time.time() - begun < 30
    by = {(r["x"], r["y"]): r["corr"] for r in got.where("x = 'c0'").collect()}
    assert by[("c0", "c1")] == pytest.approx(1.0) and by[("c0", "c7")] == pytest.approx(np.corrcoef(x[:, 0], x[:, 7])[0, 1])
