"""The scoring pipeline.

Plan shape: one stats aggregate (z-score fit) -> a cached (user_id, z)
frame -> K-Means jobs and the closed-form CF score as projections of that
frame -> blocked pair job for graph edges -> PageRank / degree jobs ->
one join with the graph scores -> distributed rank.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stray.config import PipelineConfig
from stray.functions.stats import exact_percentiles
from stray.functions.vectors import dot, lit_vector, norm, unit
from stray.operators import cluster as K
from stray.operators import graph as G
from stray.operators import similarity as S
from stray.operators.normalize import ZScoreModel, as_vectors, zscore
from stray.operators.scoring import combine_columns, rank_scores, score_summary
from stray.session import reliable_checkpoint
from stray.sources.loader import check_unique_ids, save_table, extended_path


@dataclass
class PipelineResult:
    results: DataFrame          # user_id, *_norm, final_anomaly_score, rank, cluster
    extended: DataFrame         # user_id, z-features, cluster, cluster_distance, score, rank
    normalized: DataFrame
    model: ZScoreModel
    k: int
    centroids: list
    k_table: DataFrame | None
    cf: DataFrame
    graph: G.GraphResult
    summary: DataFrame | None
    top: DataFrame              # the config.top_k highest ranks of results


def run_pipeline(features_df: DataFrame, features: Sequence[str],
                 config: PipelineConfig = PipelineConfig(), id_col: str = "user_id",
                 validate: bool = True) -> PipelineResult:
    """Load -> z-score -> cluster -> CF -> graph -> combine -> rank."""
    # uniqueness, fit and transform each read the features: write them once
    df = reliable_checkpoint(
        features_df if id_col == "user_id" else features_df.withColumnRenamed(id_col, "user_id"))
    if validate:
        check_unique_ids(df, "user_id")
    normalized, model = zscore(df, features, "user_id", config.nulls)
    # every later stage re-reads these vectors: materialise them once in the
    # shared folder (AQE sizes the partitions; survives executor loss)
    vecs = reliable_checkpoint(as_vectors(normalized, model.features))
    n = vecs.count()
    if n == 0:
        raise ValueError("no users")

    cl = K.cluster_users(vecs, config.n_clusters, config.find_optimal_k, config.kmeans_init,
                         config.seed, config.kmeans_starts, config.kmeans_max_iter,
                         config.kmeans_tol, config.k_range, block_size=config.block_size)

    # CF score as a projection of the same frame (closed form, no pairs)
    units = S.unit_vectors(vecs)
    us = S.unit_sum(units, len(model.features))
    if us.n > 1:
        avg = (dot("u", lit_vector(us.total)) - dot("u", "u")) / F.lit(float(us.n - 1))
    else:
        avg = F.lit(None).cast("double")
    cf = units.select("user_id", avg.alias("avg_similarity"))
    (thr,) = exact_percentiles(cf, "avg_similarity", [config.cf_percentile])
    cf = cf.select("user_id", "avg_similarity",
                   (F.lit(1.0) - F.col("avg_similarity")).alias("cf_anomaly_score"),
                   F.coalesce(F.col("avg_similarity") < F.lit(thr), F.lit(False)).alias("is_anomaly"))

    edges = G.similarity_cells(vecs, config.similarity_threshold, block_size=config.block_size)
    nodes = vecs.select(F.col("user_id").alias("id"))
    graph = G.detect_anomalies_graph(nodes, edges, config.pagerank_alpha, config.pagerank_max_iter,
                                     config.pagerank_tol)

    # per-user columns of one frame: cluster + CF are projections of `vecs`
    assigned = K.assign_clusters(vecs, cl.centroids).withColumn("_norm", norm("z"))
    assigned = assigned.withColumn("u", unit("z", "_norm"))
    own = assigned.select("user_id", "z", "cluster", "cluster_distance",
                          (F.lit(1.0) - avg).alias("cf_anomaly_score"))
    # bounds, range sample and ranks each read the joined scores
    joined = reliable_checkpoint(own.join(graph.scores.select("user_id", "graph_anomaly_score"), "user_id"))
    combined = combine_columns(joined, config.normalized_weights(),
                               keep=["z", "cluster", "cluster_distance"])
    ranked = rank_scores(combined)
    results = ranked.select("user_id", "cluster_distance_norm", "cf_score_norm", "graph_score_norm",
                            "final_anomaly_score", "rank", "cluster")
    extended = ranked.select("user_id",
                             *[F.col("z")[i].alias(c) for i, c in enumerate(model.features)],
                             "cluster", "cluster_distance", "final_anomaly_score", "rank")
    summary = score_summary(results, config.normalized_weights()) if config.show_summary else None
    return PipelineResult(results, extended, normalized, model, cl.k, cl.centroids, cl.k_table,
                          cf, graph, summary, results.where(F.col("rank") <= config.top_k))


def write_outputs(res: PipelineResult, output_path: str, fmt: str = "csv") -> None:
    """S7 + S8: the score table (without cluster, as exported before the merge)
    and the extended table next to it."""
    save_table(res.results.drop("cluster"), output_path, fmt)
    save_table(res.extended, extended_path(output_path), fmt)
