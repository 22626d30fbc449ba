"""Report datasets: the data behind each dashboard chart (V1-V8).

Rendering is out of scope; each function returns the small frame a chart
draws. All work is aggregates, top-k or projections on the ranked table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stray.functions.moments import co_moments
from stray.functions.stats import exact_percentiles
from stray.operators.scoring import SCORE, top_anomalies

# Columns of the detail table that may be absent.
DETAIL_OPTIONAL = ("cluster", "cluster_distance", "cf_anomaly_score", "pagerank_score")


def report_overview(results: DataFrame, percentile: float = 90.0, score: str = SCORE) -> DataFrame:
    """V1: users, mean and max score, users at or above the P-th percentile."""
    (thr,) = exact_percentiles(results, score, [percentile])
    above = F.count_if(F.col(score) >= F.lit(thr)) if thr is not None else F.lit(0)
    return results.agg(F.count(F.lit(1)).cast("bigint").alias("n_users"),
                       F.avg(score).alias("mean_score"), F.max(score).alias("max_score"),
                       above.cast("bigint").alias("n_anomalies"))


def report_top_bars(results: DataFrame, top_k: int = 20, score: str = SCORE) -> DataFrame:
    """V2: the top k as (position in drawing order, user_id as text, score);
    drawing order is reversed, so position 0 is the lowest of the k."""
    top = top_anomalies(results, top_k, score)
    w = Window.orderBy(F.col(score).asc(), F.col("user_id").desc())   # <= k rows
    return top.select((F.row_number().over(w) - 1).cast("int").alias("position"),
                      F.col("user_id").cast("string").alias("user_id"), F.col(score))


def report_histogram(results: DataFrame, bins: int = 50, score: str = SCORE) -> DataFrame:
    """V3: `bins` equal-width bins over [min, max] with counts; empty bins kept."""
    spark = results.sparkSession
    lo, hi = results.agg(F.min(score), F.max(score)).first()
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, count long")
    width = hi - lo
    if width > 0:
        b = F.least(F.floor((F.col(score) - F.lit(lo)) / F.lit(width) * F.lit(float(bins))),
                    F.lit(bins - 1))
    else:
        b = F.lit(0)
    counts = results.select(b.cast("int").alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("count"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edge = lambda i: F.lit(lo) + F.lit(width) * i.cast("double") / F.lit(float(bins))
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin", edge(F.col("bin")).alias("bin_lo"), edge(F.col("bin") + 1).alias("bin_hi"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def report_cluster_sizes(df: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """V4: users per cluster label, ascending label."""
    return (df.groupBy(F.col(cluster_col).alias("cluster"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("count")).orderBy("cluster"))


def report_correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """V5: Pearson correlation of every column pair as (x, y, corr), from mergeable co-moment matrices.
    Pairwise deletion of nulls and NaN; a constant column gives null (no division by 0)."""
    spark = df.sparkSession
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, T.NumericType)]
    cols = list(columns)
    found = co_moments(df, cols) if cols else None
    r = found.correlation() if found is not None else np.full((len(cols), len(cols)), np.nan)
    out = [(x, y, None if np.isnan(r[i, j]) else float(r[i, j])) for i, x in enumerate(cols) for j, y in enumerate(cols)]
    return spark.createDataFrame(out, "x string, y string, corr double")


def report_scatter(df: DataFrame, x: str, y: str, cluster_col: str = "cluster") -> DataFrame:
    """V6: (user_id, x, y, cluster) for every user (no sampling)."""
    return df.select("user_id", F.col(x).alias("x"), F.col(y).alias("y"),
                     F.col(cluster_col).alias("cluster"))


def report_threshold(results: DataFrame, percentile: float = 90.0, score: str = SCORE,
                     position_col: str = "rank") -> DataFrame:
    """V7: (position, score, is_anomaly = score >= P, threshold) per user."""
    (thr,) = exact_percentiles(results, score, [percentile])
    return results.select((F.col(position_col) - 1).cast("bigint").alias("position"),
                          F.col(score), (F.col(score) >= F.lit(thr)).alias("is_anomaly"),
                          F.lit(thr).cast("double").alias("threshold"))


def report_detail(results: DataFrame, top_k: int = 20, score: str = SCORE,
                  digits: int = 4) -> DataFrame:
    """V8: the k largest scores; optional columns only when present; floats to 4 places."""
    cols = ["user_id", score, "rank"] + [c for c in DETAIL_OPTIONAL if c in results.columns]
    top = top_anomalies(results, top_k, score).select(*cols)
    return top.select(*[F.round(F.col(f.name), digits).alias(f.name)
                        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                        for f in top.schema.fields])
