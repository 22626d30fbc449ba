"""CSV as written by other tools: quotes within quotes, line breaks, digits with leading zeros."""
import csv

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stray.functions.stats import exact_percentiles_by_column
from stray.operators import similarity as S
from stray.sources.loader import load_user_features, read_table
from stray.sources.logs import read_logs, write_logs

ROWS = [["id", "user", "date", "content"], ["007", "a", "2010-01-02 07:03:00", 'say "hi", ok'],
        ["008", "b", "2010-01-02", "two\nlines"], ["9", " c ", "1e5", "plain"]]


def test_logs_survive_a_round_trip(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    with open(src / "http.csv", "w", newline="") as f:
        csv.writer(f).writerows(ROWS)
    with pytest.raises(ValueError, match="multi_line"):
        read_logs(spark, str(src), ["http"])
    logs = read_logs(spark, str(src), ["http", "absent"], multi_line=True)
    want = pd.read_csv(src / "http.csv", dtype=str)
    assert sorted(map(tuple, logs["http"].collect())) == sorted(map(tuple, want.to_numpy()))
    write_logs(logs, str(tmp_path / "out"))
    again = read_logs(spark, str(tmp_path / "out"), ["http"], multi_line=True)["http"]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, want.to_numpy()))


def test_types_are_inferred_for_features(spark, tmp_path):
    (tmp_path / "f.csv").write_text('user_id,x\n"a",1.5\n"b",NA\n')
    assert [tuple(r) for r in read_table(spark, str(tmp_path / "f.csv")).orderBy("user_id").collect()] == [("a", 1.5), ("b", None)]


def test_percentiles_of_wide_ranges_and_ties(spark):
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(size=3000), [1e300, -1e300, 1e-300], np.full(2000, 0.25)]
    y = np.r_[rng.integers(0, 5, 5000).astype(float), np.full(3, np.nan)]
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).repartition(5)
    got = exact_percentiles_by_column(df, ["x", "y"], [0, 1, 25, 50, 75, 99.9, 100])
    assert np.allclose(got["x"], np.percentile(x, [0, 1, 25, 50, 75, 99.9, 100]), rtol=1e-12)
    assert np.allclose(got["y"], np.nanpercentile(y, [0, 1, 25, 50, 75, 99.9, 100]))


def test_decimal_and_text_ids(spark):
    vecs = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "i long, z array<double>").selectExpr(
        "cast(i as decimal(20,0)) as user_id", "z")
    pairs = S.pairwise_similarity(vecs, -2.0)
    assert pairs.schema["src"].dataType.simpleString() == "decimal(20,0)"
    assert {(int(r.src), int(r.dst)) for r in pairs.collect()} == {(i, j) for i in range(5) for j in range(i + 1, 5)}
    text = vecs.selectExpr("concat('u', user_id) as user_id", "z")
    assert {(r.src, r.dst) for r in S.similarity_edges(text, -2.0).collect()} == {(f"u{i}", f"u{j}") for i in range(5) for j in range(i + 1, 5)}
    assert S.similar_users_all(text, 2).count() == 10


def test_missing_words_and_types_as_pandas_reads_them(spark, tmp_path):
    rows = [["user_id", "a", "b", "c", "d", "e", "f g", "h"],
            ["u1", "1", "1.5", "True", "N/A", "2010-01-02", "007", "null"], ["u2", "nan", "-inf", "False", "x", "1", "8", "None"],
            ["u3", "-3", "", "", "NULL", "2", "9", "#N/A"], ["u4", "4", "1e3", "true", "y", "3", " 10", "<NA>"]]
    with open(tmp_path / "f.csv", "w", newline="") as f:
        csv.writer(f).writerows(rows)
    df, feats = load_user_features(spark, str(tmp_path / "f.csv"))
    want = pd.read_csv(tmp_path / "f.csv")
    assert feats == ["a", "b", "c", "f g"]  # a column with gaps stays a feature
    got = df.orderBy("user_id").toPandas()
    for c in ("a", "b", "f g"):
        assert np.array_equal(got[c].astype(float), want[c].astype(float), equal_nan=True)
    assert got["d"].isna().tolist() == want["d"].isna().tolist() and got["h"].isna().all()
    assert got["e"].tolist() == ["2010-01-02", "1", "2", "3"]


def test_a_large_file_is_split(spark, tmp_path):
    line = "u{0},{0},plain text of the row {0}\n"
    path = tmp_path / "http.csv"
    path.write_text("user,n,content\n" + "".join(line.format(i) for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
        log = read_logs(spark, str(tmp_path), ["http"])["http"]
        tasks = log.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 3 and log.count() == 60_000 and log.select("content").distinct().count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_odd_quotes_fail_clearly(spark, tmp_path):
    (tmp_path / "f.csv").write_text('user_id,x\na,"1\nb,2\n')
    with pytest.raises(ValueError, match="unbalanced quotes"):
        read_table(spark, str(tmp_path / "f.csv"))
