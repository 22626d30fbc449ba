"""Score combination, ranking and selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stray.config import MINMAX_MIN_RANGE
from stray.functions.ranking import global_rank
from stray.functions.stats import exact_percentiles, minmax_bounds, minmax_cutoff
from stray.session import reliable_checkpoint
from stray.sources.loader import save_table

SCORE = "final_anomaly_score"


def normalize_weights(weight_cluster: float = 0.3, weight_cf: float = 0.4,
                      weight_graph: float = 0.3) -> tuple[float, float, float]:
    """A1: each weight over their sum."""
    total = weight_cluster + weight_cf + weight_graph
    if total == 0:
        raise ValueError("weights sum to 0")
    return weight_cluster / total, weight_cf / total, weight_graph / total


def minmax_scores(df: DataFrame, cols: Sequence[str], suffix: str = "_norm") -> DataFrame:
    """A2: min-max each column to [0, 1]; a range < 1e-10 gives 0 for all.
    The bounds are one aggregate; they return as literals (no join)."""
    b = minmax_bounds(df, cols)
    return df.select("*", *[minmax_cutoff(F.col(c), *b[c], MINMAX_MIN_RANGE).alias(c + suffix)
                            for c in cols])


def combine_columns(df: DataFrame, weights: tuple[float, float, float],
                    cluster_col: str = "cluster_distance", cf_col: str = "cf_anomaly_score",
                    graph_col: str = "graph_anomaly_score", keep: Sequence[str] = ()) -> DataFrame:
    """A3 on one frame that already holds the three raw scores per user."""
    wc, wf, wg = weights
    normed = minmax_scores(df, [cluster_col, cf_col, graph_col])
    return normed.select(
        "user_id", *keep,
        F.col(cluster_col + "_norm").alias("cluster_distance_norm"),
        F.col(cf_col + "_norm").alias("cf_score_norm"),
        F.col(graph_col + "_norm").alias("graph_score_norm"),
        (F.lit(wc) * F.col(cluster_col + "_norm") + F.lit(wf) * F.col(cf_col + "_norm")
         + F.lit(wg) * F.col(graph_col + "_norm")).alias(SCORE))


def combine_scores(cluster: DataFrame, cf: DataFrame, graph: DataFrame,
                   weight_cluster: float = 0.3, weight_cf: float = 0.4,
                   weight_graph: float = 0.3) -> DataFrame:
    """A3: join the three score frames by user_id (never by position), then mix. The joined scores are written
    once: bounds, the range sample of a rank and the ranks read them."""
    j = reliable_checkpoint(cluster.select("user_id", "cluster_distance")
                            .join(cf.select("user_id", "cf_anomaly_score"), "user_id")
                            .join(graph.select("user_id", "graph_anomaly_score"), "user_id"))
    return combine_columns(j, normalize_weights(weight_cluster, weight_cf, weight_graph))


def rank_scores(df: DataFrame, score: str = SCORE) -> DataFrame:
    """A4: rank 1..N by score desc, user_id asc, without one global task."""
    return global_rank(df, [F.col(score).desc(), F.col("user_id").asc()], "rank")


def top_anomalies(df: DataFrame, top_k: int = 20, score: str = SCORE) -> DataFrame:
    """A5: k largest scores (ties by user_id); a per-partition top-k, then a merge."""
    return df.orderBy(F.col(score).desc(), F.col("user_id").asc()).limit(top_k)


def threshold_anomalies(df: DataFrame, percentile: float = 90.0, score: str = SCORE) -> DataFrame:
    """Users whose score >= the exact P-th percentile."""
    (thr,) = exact_percentiles(df, score, [percentile])
    if thr is None:
        return df.limit(0)
    return df.where(F.col(score) >= F.lit(thr))


def score_summary(df: DataFrame, weights: tuple[float, float, float], score: str = SCORE
                  ) -> DataFrame:
    """Count, normalised weights, mean, median, sample std of the final score."""
    spark = df.sparkSession
    r = df.agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean"),
               F.stddev_samp(score).alias("std")).first()
    (med,) = exact_percentiles(df, score, [50])
    wc, wf, wg = weights
    return spark.createDataFrame(
        [(int(r["n"]), wc, wf, wg, r["mean"], med, r["std"])],
        "n_users long, weight_cluster double, weight_cf double, weight_graph double, "
        "mean double, median double, std double")


def export_results(df: DataFrame, path: str, top_k: int | None = None, fmt: str = "csv",
                   score: str = SCORE) -> DataFrame:
    """All rows, or the first k in rank order, written as one distributed write."""
    out = df if top_k is None else top_anomalies(df, top_k, score)
    save_table(out, path, fmt)
    return out


def combine_anomaly_scores(cluster: DataFrame, cf: DataFrame, graph: DataFrame,
                           weight_cluster: float = 0.3, weight_cf: float = 0.4,
                           weight_graph: float = 0.3, output_path: str | None = None,
                           show_summary: bool = True, fmt: str = "csv"
                           ) -> tuple[DataFrame, DataFrame | None]:
    """Combine + rank, optionally export (S7) and summarise."""
    ranked = rank_scores(combine_scores(cluster, cf, graph, weight_cluster, weight_cf, weight_graph))
    if output_path:
        export_results(ranked, output_path, fmt=fmt)
    summary = None
    if show_summary:
        summary = score_summary(ranked, normalize_weights(weight_cluster, weight_cf, weight_graph))
    return ranked, summary
