import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stray.operators.normalize import fit_zscore, resolve_feature_columns, zscore
from stray.sources.loader import (dataset_summary, feature_columns, load_user_features,
                                  read_results)


def test_population_std_and_constant_feature(spark):
    df = spark.createDataFrame([(i, float(v), 7.0) for i, v in enumerate([1, 2, 3, 4, 10])],
                               "user_id long, x double, c double")
    out, model = zscore(df, ["x", "c"])
    assert model.scales[0] == pytest.approx(3.16228, abs=1e-5)   # population std
    assert model.scales[1] == 1.0                                 # constant -> scale 1
    z = {r["user_id"]: (r["x"], r["c"]) for r in out.collect()}
    assert all(c == 0.0 for _, c in z.values())
    assert z[4][0] == pytest.approx((10 - 4) / math.sqrt(10.0))


def test_nulls_error_by_default_and_mean_opt_in(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "user_id long, x double")
    with pytest.raises(ValueError):
        fit_zscore(df, ["x"])
    out, _ = zscore(df, ["x"], nulls="mean")
    assert {r["user_id"]: r["x"] for r in out.collect()}[2] == 0.0


def test_feature_detection_excludes_metadata(spark):
    df = spark.createDataFrame([(1, 0.5, 1, 2, True, "a")],
                               "user_id long, f1 double, insider int, b_unit int, flag boolean, role string")
    assert feature_columns(df) == ["f1", "flag"]
    assert feature_columns(df, exclude=["flag"]) == ["f1"]
    with pytest.raises(ValueError):
        resolve_feature_columns(df, ["nope"])


def test_load_checks(spark):
    d = tempfile.mkdtemp(prefix="stray-t-")
    with pytest.raises(FileNotFoundError):
        load_user_features(spark, os.path.join(d, "absent.csv"))
    p = os.path.join(d, "nouid.csv")
    open(p, "w").write("a,b\n1,2\n")
    with pytest.raises(ValueError):
        load_user_features(spark, p)
    p = os.path.join(d, "nonum.csv")
    open(p, "w").write("user_id,name\n1,x\n")
    with pytest.raises(ValueError):
        load_user_features(spark, p)
    p = os.path.join(d, "dup.csv")
    open(p, "w").write("user_id,x\n1,2\n1,3\n")
    with pytest.raises(ValueError):
        load_user_features(spark, p)
    p = os.path.join(d, "ok.csv")
    open(p, "w").write("user_id,x,insider\n1,NA,0\n2,3.5,1\n")
    df, feats = load_user_features(spark, p)
    assert feats == ["x"]
    assert df.where(F.col("x").isNull()).count() == 1
    with pytest.raises(ValueError):
        read_results(spark, p)


def test_dataset_summary_matches_pandas(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 10.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "user_id long, x double")
    s = {(r["column"], r["metric"]): r["value"] for r in dataset_summary(df, ["x"]).collect()}
    assert s[("x", "25%")] == 2.0 and s[("x", "50%")] == 3.0 and s[("x", "75%")] == 4.0
    assert s[("x", "std")] == pytest.approx(3.53553, abs=1e-5)   # sample std, as describe()
    assert s[("*", "n_users")] == 5 and s[("user_id", "missing")] == 0
