"""Registered queries: one callable (spark, sf_dir) -> DataFrame per SURVEY key.

Every query reads the driver's tables (events, orders, customer,
embeddings) through the fixture adapters, so its work grows with them.
Floating-point outputs are rounded to 6 places at the very end.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stray.config import PipelineConfig
from stray.functions.stats import round_doubles
from stray.operators import cluster as K
from stray.operators import graph as G
from stray.operators import scoring as A
from stray.operators import similarity as S
from stray.operators.normalize import as_vectors, fit_zscore, zscore
from stray.sources import fixtures as X
from stray.functions.vectors import vector
from stray.session import checkpoint_dir, reliable_checkpoint
from stray.sources.loader import dataset_summary, feature_columns, prepare_user_features, read_results

Query = Callable[[SparkSession, str], DataFrame]

THRESHOLD = 0.7
ALL_PAIRS = -2.0         # a threshold below every cosine: this query wants all pairs
PR_ITER = 20
KM_K = 5
KM_ITER = 5
KM_STARTS = 10
TOP_K = 5
SAMPLE_N = 50
SEED = 42
DET = PipelineConfig(n_clusters=KM_K, kmeans_init="lowest_ids", kmeans_max_iter=KM_ITER,
                     kmeans_tol=None, pagerank_max_iter=PR_ITER, pagerank_tol=None)


# ---------------------------------------------------------------- helpers


def features(spark, sf) -> tuple[DataFrame, list[str]]:
    return prepare_user_features(X.events_features(spark, sf), validate=False)


def vectors(spark, sf) -> DataFrame:
    """(user_id, z): materialised once, every consumer re-reads it."""
    df, feats = features(spark, sf)
    norm, model = zscore(df, feats)
    return reliable_checkpoint(as_vectors(norm, model.features))


def _graph_inputs(spark, sf, vecs: DataFrame | None = None):
    vecs = vectors(spark, sf) if vecs is None else vecs
    edges = G.similarity_cells(vecs, THRESHOLD)
    nodes = vecs.select(F.col("user_id").alias("id"))
    return vecs, nodes, edges


def _lloyd_assigned(vecs: DataFrame, k: int = KM_K) -> DataFrame:
    cents, _ = K.lloyd(vecs, K.lowest_id_centroids(vecs, k), KM_ITER)
    return K.assign_clusters(vecs, cents)


def _graph_scores(spark, sf, vecs: DataFrame | None = None) -> DataFrame:
    _, nodes, edges = _graph_inputs(spark, sf, vecs)
    res = G.detect_anomalies_graph(nodes, edges, max_iter=PR_ITER, tol=None)
    return res.scores


def _combined(spark, sf) -> DataFrame:
    vecs = vectors(spark, sf)
    assigned = _lloyd_assigned(vecs)
    cf = S.cf_anomalies(vecs)
    return A.combine_scores(assigned, cf, _graph_scores(spark, sf, vecs))


def _ranked(spark, sf) -> DataFrame:
    return A.rank_scores(_combined(spark, sf))


# ---------------------------------------------------------------- S, N


def q_feature_columns(spark, sf):
    """The detected features with their values that are there, from one aggregate over the table."""
    df = X.events_features(spark, sf)
    feats = feature_columns(df)
    counts = df.agg(*[F.count(c).alias(c) for c in feats])
    return counts.select(F.posexplode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_values")) for c in feats]))
                         .alias("position", "f")).select("position", "f.feature", "f.n_values")


def q_dataset_summary(spark, sf):
    df, feats = features(spark, sf)
    return round_doubles(dataset_summary(df, feats))


def q_zscore_features(spark, sf):
    df, feats = features(spark, sf)
    return round_doubles(zscore(df, feats)[0])


def _per_type(spark, sf) -> DataFrame:
    ev = X.table(spark, sf, "events")
    return (ev.groupBy("user_id", "event_type").agg(
        *[F.count_if(F.col("event_type") == t).cast("bigint").alias(f"n_{t}") for t in X.EVENT_TYPES],
        F.sum("value").alias("value_sum"), F.avg("value").alias("value_avg"),
        F.max("value").alias("value_max"), F.stddev_pop("value").alias("value_std")))


def q_zscore_apply(spark, sf):
    """Fit on the per-user table, apply to per-(user, event type) rows of the same
    features (the 'new data' of the same schema)."""
    df, feats = features(spark, sf)
    model = fit_zscore(df, feats)
    return round_doubles(model.transform(_per_type(spark, sf), keep=["event_type"]))


def q_scaling_params(spark, sf):
    df, feats = features(spark, sf)
    return round_doubles(fit_zscore(df, feats).params(spark))


# ---------------------------------------------------------------- F


def q_pairwise_similarity(spark, sf):
    return round_doubles(S.pairwise_similarity(vectors(spark, sf), ALL_PAIRS).withColumnRenamed("weight", "similarity"))


def q_global_similarity(spark, sf):
    return round_doubles(S.global_similarity(vectors(spark, sf)))


def q_avg_similarity(spark, sf):
    return round_doubles(S.avg_similarity(vectors(spark, sf)))


def _first_user(vecs):
    return vecs.agg(F.min("user_id")).first()[0]


def q_avg_similarity_one(spark, sf):
    vecs = vectors(spark, sf)
    return round_doubles(S.avg_similarity_one(vecs, _first_user(vecs)))


def q_similar_users(spark, sf):
    vecs = vectors(spark, sf)
    return round_doubles(S.similar_users(vecs, _first_user(vecs), TOP_K))


def q_similar_users_all(spark, sf):
    return round_doubles(S.similar_users_all(vectors(spark, sf), TOP_K))


def q_cf_anomalies(spark, sf):
    return round_doubles(S.cf_anomalies(vectors(spark, sf)))


def q_similarity_statistics(spark, sf):
    return round_doubles(S.similarity_statistics(vectors(spark, sf)))


# ---------------------------------------------------------------- G


def q_similarity_edges(spark, sf):
    return round_doubles(S.similarity_edges(vectors(spark, sf), THRESHOLD))


def q_connected_components(spark, sf):
    _, nodes, edges = _graph_inputs(spark, sf)
    return G.connected_components(nodes, edges).withColumnRenamed("id", "user_id")


def q_pagerank(spark, sf):
    _, nodes, edges = _graph_inputs(spark, sf)
    return round_doubles(G.pagerank(nodes, edges, max_iter=PR_ITER, tol=None)
                         .withColumnRenamed("id", "user_id"))


def q_degree_centrality(spark, sf):
    _, nodes, edges = _graph_inputs(spark, sf)
    return round_doubles(G.degree_centrality(nodes, edges).withColumnRenamed("id", "user_id"))


def q_isolated_nodes(spark, sf):
    _, nodes, edges = _graph_inputs(spark, sf)
    return round_doubles(G.isolated_nodes(G.degree_centrality(nodes, edges), 10))


def q_graph_anomalies(spark, sf):
    return round_doubles(_graph_scores(spark, sf))


def q_graph_statistics(spark, sf):
    _, nodes, edges = _graph_inputs(spark, sf)
    comps = G.connected_components(nodes, edges)
    return round_doubles(G.graph_statistics(nodes, edges, comps))


def q_graph_moments(spark, sf):
    _, nodes, edges = _graph_inputs(spark, sf)
    pr = G.pagerank(nodes, edges, max_iter=PR_ITER, tol=None)
    return round_doubles(G.graph_moments(pr, G.degree_centrality(nodes, edges)))


def q_graph_analysis(spark, sf):
    """G10 in one call: the highest graph scores of the similarity graph, each with the graph's statistics."""
    res = G.detect_anomalies(vectors(spark, sf), THRESHOLD, max_iter=PR_ITER, tol=None, show_top=TOP_K)
    return round_doubles(res.top.crossJoin(res.statistics))     # one row


# ---------------------------------------------------------------- K


def q_kmeans_lloyd(spark, sf):
    a = _lloyd_assigned(vectors(spark, sf))
    return round_doubles(a.select("user_id", "cluster", "cluster_distance"))


def q_kmeans_predict(spark, sf):
    a = _lloyd_assigned(vectors(spark, sf))
    return a.select("user_id", "cluster")


def q_kmeans_predict_new(spark, sf):
    """Clusters fitted on users predict rows that were not in the fit: one per (user, event type)."""
    df, feats = features(spark, sf)
    norm, model = zscore(df, feats)
    vecs = reliable_checkpoint(as_vectors(norm, model.features))
    cents, _ = K.lloyd(vecs, K.lowest_id_centroids(vecs, KM_K), KM_ITER)
    new = model.transform(_per_type(spark, sf), keep=["event_type"])
    rows = new.select("user_id", "event_type", vector(model.features).alias("z"))
    return round_doubles(K.assign_clusters(rows, cents, keep_vector=False).select("user_id", "event_type", "cluster", "cluster_distance"))


def q_centroid_distance(spark, sf):
    a = _lloyd_assigned(vectors(spark, sf))
    return round_doubles(a.select("user_id", "cluster_distance"))


def q_cluster_statistics(spark, sf):
    return K.cluster_statistics(_lloyd_assigned(vectors(spark, sf)))


def q_inertia(spark, sf):
    a = _lloyd_assigned(vectors(spark, sf))
    return round_doubles(spark.createDataFrame([(KM_K, K.inertia(a))], "k int, inertia double"))


def q_silhouette(spark, sf):
    vecs = X.embedding_vectors(X.table(spark, sf, "embeddings"))
    s = K.silhouette(vecs, "label", id_col="vec_id")
    return round_doubles(spark.createDataFrame([(s,)], "silhouette double"))


def q_optimal_k(spark, sf):
    _, table = K.find_optimal_k(vectors(spark, sf), range(2, 11), init="lowest_ids",
                                max_iter=KM_ITER, tol=None)
    return round_doubles(table)


def q_cluster_users(spark, sf):
    res = K.cluster_users(vectors(spark, sf), KM_K, init="lowest_ids", max_iter=KM_ITER, tol=None)
    return round_doubles(res.assigned.select("user_id", "cluster", "cluster_distance"))


def q_cluster_report(spark, sf):
    """K8's clusters with K4's figures of the own cluster beside each user."""
    res = K.cluster_users(vectors(spark, sf), KM_K, init="lowest_ids", max_iter=KM_ITER, tol=None)
    return round_doubles(res.assigned.select("user_id", "cluster", "cluster_distance")).join(F.broadcast(res.statistics), "cluster")  # k rows


def q_kmeans_best_of(spark, sf):
    """The best of ten D^2-weighted starts."""
    vecs = vectors(spark, sf)
    fit = K.best_of_starts(vecs, [KM_K], KM_STARTS, SEED, KM_ITER, tol=None)[KM_K]
    return round_doubles(K.assign_clusters(vecs, fit.centroids).select("user_id", "cluster", "cluster_distance"))


def q_kmeans_mllib(spark, sf):
    vecs = vectors(spark, sf)
    fit = K.mllib_kmeans(vecs, KM_K, seed=SEED, n_starts=10)
    return K.assign_clusters(vecs, fit.centroids).select("user_id", "cluster")


def q_kmeans_mllib_bound(spark, sf):
    """The best MLlib fit is no worse than Lloyd steps from the lowest ids: the greater of both inertias is the latter's."""
    vecs = vectors(spark, sf)
    fit = K.mllib_kmeans(vecs, KM_K, seed=SEED, n_starts=10)
    best = K.inertia(K.assign_clusters(vecs, fit.centroids))
    plain = _lloyd_assigned(vecs).agg(F.count(F.lit(1)).alias("n_users"), F.sum("d2").alias("d2"))
    return round_doubles(plain.select(F.lit(KM_K).alias("k"), "n_users", F.greatest("d2", F.lit(best)).alias("bound")))


# ---------------------------------------------------------------- A, P


def q_minmax_scores(spark, sf):
    a = _lloyd_assigned(vectors(spark, sf)).select("user_id", "cluster_distance")
    return round_doubles(A.minmax_scores(a, ["cluster_distance"]))


def q_combined_scores(spark, sf):
    return round_doubles(_combined(spark, sf))


def q_ranked_scores(spark, sf):
    return round_doubles(_ranked(spark, sf))


def q_top_anomalies(spark, sf):
    return round_doubles(A.top_anomalies(_ranked(spark, sf), 20))


def q_threshold_anomalies(spark, sf):
    return round_doubles(A.threshold_anomalies(_ranked(spark, sf), 90))


def q_score_summary(spark, sf):
    return round_doubles(A.score_summary(_combined(spark, sf), DET.normalized_weights()))


def q_export_top_k(spark, sf):
    """The k highest, written as CSV in the shared folder and read again."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/stray-export-{uuid.uuid4().hex}.csv"
    out = A.export_results(round_doubles(_ranked(spark, sf)), path, DET.top_k)
    return read_results(spark, path, schema=out.schema)


def _pipeline(spark, sf):
    from stray.plans.pipeline import run_pipeline
    df, feats = features(spark, sf)
    return run_pipeline(df, feats, DET.with_(show_summary=False))


def q_pipeline(spark, sf):
    return round_doubles(_pipeline(spark, sf).results)


def q_extended_results(spark, sf):
    return round_doubles(_pipeline(spark, sf).extended)


# ---------------------------------------------------------------- C


def _logs(spark, sf):
    return X.logs_from_events(X.table(spark, sf, "events"))


def _psycho(spark, sf):
    return X.psychometric_from_customer(X.table(spark, sf, "customer"))


def _union(frames):
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def q_distinct_users(spark, sf):
    from stray.operators.cohort import distinct_users
    return _union([distinct_users(df).select(F.lit(name).alias("log"), "user")
                   for name, df in _logs(spark, sf).items()])


def q_common_users(spark, sf):
    from stray.operators.cohort import common_users
    return common_users(_logs(spark, sf))


def q_sample_users(spark, sf):
    from stray.operators.cohort import common_users, sample_users
    return sample_users(common_users(_logs(spark, sf)), SAMPLE_N, SEED)


def q_sample_table(spark, sf):
    from stray.operators.cohort import sample_table
    return sample_table(_logs(spark, sf)["http"], "user", SAMPLE_N, SEED).select(
        "event_id", "user", "event_type", "value")


def q_cohort_filter(spark, sf):
    from stray.operators.cohort import cohort_filter, common_users, sample_users
    logs = _logs(spark, sf)
    sample = sample_users(common_users(logs), SAMPLE_N, SEED)
    kept = cohort_filter(logs, sample)
    return _union([df.select(F.lit(name).alias("log"), "event_id", "user", "value")
                   for name, df in kept.items()])


def q_cohort_report(spark, sf):
    from stray.operators.cohort import cohort_reduce
    res = cohort_reduce(_logs(spark, sf), _psycho(spark, sf), SAMPLE_N, SEED)
    return round_doubles(res.report.select("log", "rows_before", "rows_after", "reduction_pct"))


def q_cohort_reduce(spark, sf):
    from stray.operators.cohort import cohort_reduce
    res = cohort_reduce(_logs(spark, sf), _psycho(spark, sf), SAMPLE_N, SEED)
    return _union([df.groupBy("user").agg(F.count(F.lit(1)).alias("n_rows"))
                   .select(F.lit(name).alias("log"), "user", "n_rows")
                   for name, df in res.filtered.items()])


# ---------------------------------------------------------------- V


def _results(spark, sf):
    return _pipeline(spark, sf).results


def q_report_overview(spark, sf):
    from stray.plans.report import report_overview
    return round_doubles(report_overview(_results(spark, sf)))


def q_report_top_bars(spark, sf):
    from stray.plans.report import report_top_bars
    return round_doubles(report_top_bars(_results(spark, sf), 20))


def q_report_histogram(spark, sf):
    from stray.plans.report import report_histogram
    return round_doubles(report_histogram(_results(spark, sf), 50))


def q_report_cluster_sizes(spark, sf):
    from stray.plans.report import report_cluster_sizes
    return report_cluster_sizes(_results(spark, sf))


def q_report_correlation(spark, sf):
    from stray.plans.report import report_correlation
    df, feats = features(spark, sf)
    return round_doubles(report_correlation(df, feats))


def q_report_scatter(spark, sf):
    from stray.plans.report import report_scatter
    return round_doubles(report_scatter(_pipeline(spark, sf).extended, "value_avg", "value_std"))


def q_report_threshold(spark, sf):
    from stray.plans.report import report_threshold
    return round_doubles(report_threshold(_results(spark, sf), 90))


def q_report_detail(spark, sf):
    from stray.plans.report import report_detail
    return report_detail(_results(spark, sf), 20)


QUERIES: dict[str, Query] = {
    "feature_columns": q_feature_columns,
    "dataset_summary": q_dataset_summary,
    "zscore_features": q_zscore_features,
    "zscore_apply": q_zscore_apply,
    "scaling_params": q_scaling_params,
    "pairwise_similarity": q_pairwise_similarity,
    "global_similarity": q_global_similarity,
    "avg_similarity": q_avg_similarity,
    "avg_similarity_one": q_avg_similarity_one,
    "similar_users": q_similar_users,
    "similar_users_all": q_similar_users_all,
    "cf_anomalies": q_cf_anomalies,
    "similarity_statistics": q_similarity_statistics,
    "similarity_edges": q_similarity_edges,
    "connected_components": q_connected_components,
    "pagerank": q_pagerank,
    "degree_centrality": q_degree_centrality,
    "isolated_nodes": q_isolated_nodes,
    "graph_anomalies": q_graph_anomalies,
    "graph_statistics": q_graph_statistics,
    "graph_moments": q_graph_moments,
    "graph_analysis": q_graph_analysis,
    "kmeans_lloyd": q_kmeans_lloyd,
    "kmeans_predict": q_kmeans_predict,
    "kmeans_predict_new": q_kmeans_predict_new,
    "centroid_distance": q_centroid_distance,
    "cluster_statistics": q_cluster_statistics,
    "inertia": q_inertia,
    "silhouette": q_silhouette,
    "optimal_k": q_optimal_k,
    "cluster_users": q_cluster_users,
    "cluster_report": q_cluster_report,
    "kmeans_best_of": q_kmeans_best_of,
    "kmeans_mllib": q_kmeans_mllib,
    "kmeans_mllib_bound": q_kmeans_mllib_bound,
    "minmax_scores": q_minmax_scores,
    "combined_scores": q_combined_scores,
    "ranked_scores": q_ranked_scores,
    "top_anomalies": q_top_anomalies,
    "threshold_anomalies": q_threshold_anomalies,
    "score_summary": q_score_summary,
    "export_top_k": q_export_top_k,
    "anomaly_pipeline": q_pipeline,
    "extended_results": q_extended_results,
    "distinct_users": q_distinct_users,
    "common_users": q_common_users,
    "sample_users": q_sample_users,
    "sample_table": q_sample_table,
    "cohort_filter": q_cohort_filter,
    "cohort_report": q_cohort_report,
    "cohort_reduce": q_cohort_reduce,
    "report_overview": q_report_overview,
    "report_top_bars": q_report_top_bars,
    "report_histogram": q_report_histogram,
    "report_cluster_sizes": q_report_cluster_sizes,
    "report_correlation": q_report_correlation,
    "report_scatter": q_report_scatter,
    "report_threshold": q_report_threshold,
    "report_detail": q_report_detail,
}
