"""Oracle SQL (DuckDB) per registered query key; brute force on purpose."""

from __future__ import annotations

from stray.plans import catalog as C
from stray.plans.oracle import (F, avgsim_cte, base_ctes, cf_cte, degree_cte, edges_cte,
                                graph_score_cte, lloyd_ctes, minmax_sql, pagerank_ctes,
                                pairs_cte, r6, with_)
from stray.config import INTERSECT_LOGS
from stray.sources.fixtures import EVENT_TYPES, LOG_EVENT_TYPES


def _z_cols(prefix: str = "") -> str:
    return ", ".join(f"{r6(prefix + c)} AS {c}" for c in F)


def _base(*extra):
    return [*base_ctes(), pairs_cte(), *extra]


def feature_columns() -> str:
    from stray.plans.oracle import feat_cte
    rows = "\nUNION ALL\n".join(f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS feature, count({c}) AS n_values FROM feat"
                                for i, c in enumerate(F))
    return with_(feat_cte(), body=rows)


def dataset_summary() -> str:
    from stray.plans.oracle import feat_cte
    parts = ['''SELECT '*' AS "column", 'n_users' AS metric, CAST(count(*) AS DOUBLE) AS value FROM feat''',
             f"SELECT '*', 'n_features', CAST({len(F)} AS DOUBLE)"]
    for c in ["user_id", *F]:
        parts.append(f"SELECT '{c}', 'missing', CAST(count(*) - count({c}) AS DOUBLE) FROM feat")
    for c in F:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}', m, v FROM (SELECT
  count({x}) AS cnt, avg({x}) AS mean, stddev_samp({x}) AS std, min({x}) AS mn,
  quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS q2, quantile_cont({x}, 0.75) AS q3,
  max({x}) AS mx FROM feat) s,
  LATERAL (VALUES ('count', CAST(cnt AS DOUBLE)), ('mean', mean), ('std', std), ('min', mn),
                  ('25%', q1), ('50%', q2), ('75%', q3), ('max', mx)) t(m, v)""")
    body = 'SELECT "column", metric, round(value, 6) AS value FROM (\n' + "\nUNION ALL\n".join(parts) + "\n)"
    return with_(feat_cte(), body=body)


def zscore_features() -> str:
    return with_(*base_ctes(), body=f"SELECT user_id, {_z_cols()} FROM z")


def _per_type() -> tuple[str, str]:
    counts = ", ".join(f"CAST(sum(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{t}"
                       for t in EVENT_TYPES)
    return ("per", f"""SELECT user_id, event_type, {counts}, sum(value) AS value_sum,
  avg(value) AS value_avg, max(value) AS value_max, stddev_pop(value) AS value_std
FROM events GROUP BY user_id, event_type""")


def zscore_apply() -> str:
    from stray.plans.oracle import feat_cte, prm_cte, scale_expr
    per = _per_type()
    zs = ", ".join(f"{r6(f'(CAST({c} AS DOUBLE) - m_{c}) / {scale_expr(c)}')} AS {c}" for c in F)
    return with_(feat_cte(), prm_cte(), per, body=f"SELECT user_id, event_type, {zs} FROM per, prm")


def scaling_params() -> str:
    from stray.plans.oracle import feat_cte, prm_cte, scale_expr
    rows = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {r6(f'm_{c}')} AS mean, {r6(scale_expr(c))} AS std FROM prm" for c in F)
    return with_(feat_cte(), prm_cte(), body=rows)


def pairwise_similarity() -> str:
    return with_(*_base(), body=f"SELECT src, dst, {r6('sim')} AS similarity FROM pairs")


def global_similarity() -> str:
    return with_(*_base(), body=f"SELECT {r6('avg(sim)')} AS avg_similarity FROM pairs")


def avg_similarity() -> str:
    return with_(*_base(avgsim_cte()),
                 body=f"SELECT user_id, {r6('avg_similarity')} AS avg_similarity FROM avgsim")


def avg_similarity_one() -> str:
    return with_(*_base(avgsim_cte()),
                 body=f"SELECT user_id, {r6('avg_similarity')} AS avg_similarity FROM avgsim "
                      "WHERE user_id = (SELECT min(user_id) FROM unit)")


def _both() -> tuple[str, str]:
    return ("bothdir", "SELECT src AS uid, dst AS oid, sim FROM pairs UNION ALL SELECT dst, src, sim FROM pairs")


def similar_users() -> str:
    return with_(*_base(_both()), body=f"""SELECT oid AS user_id, {r6('sim')} AS similarity FROM bothdir
WHERE uid = (SELECT min(user_id) FROM unit) ORDER BY sim DESC, oid ASC LIMIT {C.TOP_K}""")


def similar_users_all() -> str:
    return with_(*_base(_both()), body=f"""SELECT uid AS user_id, CAST(rn AS INTEGER) AS rank,
  oid AS other_id, {r6('sim')} AS similarity
FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY sim DESC, oid ASC) AS rn FROM bothdir)
WHERE rn <= {C.TOP_K}""")


def cf_anomalies() -> str:
    return with_(*_base(avgsim_cte(), cf_cte()), body=f"""SELECT user_id,
  {r6('avg_similarity')} AS avg_similarity, {r6('cf_anomaly_score')} AS cf_anomaly_score, is_anomaly
FROM cf""")


def similarity_statistics() -> str:
    dbl = ("dbl", "SELECT sim FROM pairs UNION ALL SELECT sim FROM pairs")
    return with_(*_base(dbl), body=f"""SELECT metric, {r6('value')} AS value FROM (
  SELECT avg(sim) AS mean, quantile_cont(sim, 0.5) AS median, stddev_pop(sim) AS std,
    min(sim) AS mn, max(sim) AS mx, quantile_cont(sim, 0.25) AS q25, quantile_cont(sim, 0.75) AS q75
  FROM dbl) s,
  LATERAL (VALUES ('mean', mean), ('median', median), ('std', std), ('min', mn), ('max', mx),
                  ('q25', q25), ('q75', q75)) t(metric, value)""")


def _graph(*extra):
    return _base(edges_cte(C.THRESHOLD), *pagerank_ctes(C.PR_ITER), *extra)


def similarity_edges() -> str:
    return with_(*_base(edges_cte(C.THRESHOLD)), body=f"SELECT src, dst, {r6('weight')} AS weight FROM edges")


def _components_cte() -> list[tuple[str, str]]:
    return [("und", "SELECT src AS a, dst AS b FROM edges UNION ALL SELECT dst, src FROM edges"),
            ("comp", """SELECT node AS user_id, min(lbl) AS component FROM (
  WITH RECURSIVE reach(node, lbl) AS (
    SELECT user_id, user_id FROM unit
    UNION
    SELECT und.b, reach.lbl FROM reach JOIN und ON und.a = reach.node)
  SELECT * FROM reach) GROUP BY node""")]


def connected_components() -> str:
    return with_(*_base(edges_cte(C.THRESHOLD)), *_components_cte(),
                 body="SELECT user_id, component FROM comp")


def pagerank() -> str:
    return with_(*_graph(), body=f"SELECT id AS user_id, {r6('pagerank')} AS pagerank FROM pr")


def degree_centrality() -> str:
    return with_(*_graph(degree_cte()), ("dg", "SELECT a, count(*) AS c FROM dedge GROUP BY a"),
                 body=f"""SELECT d.id AS user_id, CAST(coalesce(g.c, 0) AS BIGINT) AS degree,
  {r6('d.degree_centrality')} AS degree_centrality FROM deg d LEFT JOIN dg g ON g.a = d.id""")


def isolated_nodes() -> str:
    return with_(*_graph(degree_cte()), body=f"""SELECT id AS user_id,
  {r6('degree_centrality')} AS degree_centrality
FROM deg ORDER BY degree_centrality ASC, id ASC LIMIT 10""")


def graph_anomalies() -> str:
    return with_(*_graph(degree_cte(), graph_score_cte()), body=f"""SELECT user_id,
  {r6('pagerank')} AS pagerank, {r6('degree_centrality')} AS degree_centrality,
  {r6('graph_anomaly_score')} AS graph_anomaly_score FROM gscore""")


def graph_statistics() -> str:
    return with_(*_base(edges_cte(C.THRESHOLD)), *_components_cte(), body="""SELECT
  CAST(n AS BIGINT) AS n_nodes, CAST(m AS BIGINT) AS n_edges,
  round(CASE WHEN n <= 1 OR m = 0 THEN 0.0 ELSE 2.0 * m / (n * (n - 1.0)) END, 6) AS density,
  CAST(c AS BIGINT) AS n_components,
  round(CASE WHEN n > 0 THEN 2.0 * m / n ELSE 0.0 END, 6) AS avg_degree
FROM (SELECT (SELECT count(*) FROM unit) AS n, (SELECT count(*) FROM edges) AS m,
             (SELECT count(DISTINCT component) FROM comp) AS c)""")


def graph_moments() -> str:
    return with_(*_graph(degree_cte()), body=f"""SELECT
  {r6('(SELECT avg(pagerank) FROM pr)')} AS pagerank_mean,
  {r6('(SELECT stddev_pop(pagerank) FROM pr)')} AS pagerank_std,
  {r6('(SELECT avg(degree_centrality) FROM deg)')} AS degree_mean,
  {r6('(SELECT stddev_pop(degree_centrality) FROM deg)')} AS degree_std""")


def graph_analysis() -> str:
    return with_(*_graph(degree_cte(), graph_score_cte(), *_components_cte()), body=f"""SELECT user_id,
  {r6('pagerank')} AS pagerank, {r6('degree_centrality')} AS degree_centrality,
  {r6('graph_anomaly_score')} AS graph_anomaly_score,
  CAST(n AS BIGINT) AS n_nodes, CAST(m AS BIGINT) AS n_edges,
  round(CASE WHEN n <= 1 OR m = 0 THEN 0.0 ELSE 2.0 * m / (n * (n - 1.0)) END, 6) AS density,
  CAST(c AS BIGINT) AS n_components, round(CASE WHEN n > 0 THEN 2.0 * m / n ELSE 0.0 END, 6) AS avg_degree,
  {r6('pm')} AS pagerank_mean, {r6('ps')} AS pagerank_std, {r6('dm')} AS degree_mean, {r6('ds')} AS degree_std
FROM (SELECT * FROM gscore ORDER BY graph_anomaly_score DESC, user_id LIMIT {C.TOP_K}),
     (SELECT (SELECT count(*) FROM unit) AS n, (SELECT count(*) FROM edges) AS m, (SELECT count(DISTINCT component) FROM comp) AS c),
     (SELECT avg(pagerank) AS pm, stddev_pop(pagerank) AS ps FROM pr),
     (SELECT avg(degree_centrality) AS dm, stddev_pop(degree_centrality) AS ds FROM deg)""")


# ---------------------------------------------------------------- K


def _km(k: int = C.KM_K, prefix: str = "km"):
    return [*base_ctes(), *lloyd_ctes(k, C.KM_ITER, prefix=prefix)]


def kmeans_lloyd() -> str:
    return with_(*_km(), body=f"""SELECT user_id, CAST(cluster AS INTEGER) AS cluster,
  {r6('sqrt(d2)')} AS cluster_distance FROM km_assign""")


def kmeans_best_of() -> str:
    from stray.plans.oracle import best_of_ctes
    return with_(*base_ctes(), *best_of_ctes(C.KM_K, C.KM_STARTS, C.SEED, C.KM_ITER), body=f"""SELECT user_id,
  CAST(cluster AS INTEGER) AS cluster, {r6('sqrt(d2)')} AS cluster_distance FROM bo_assign""")


def kmeans_predict() -> str:
    return with_(*_km(), body="SELECT user_id, CAST(cluster AS INTEGER) AS cluster FROM km_assign")


def kmeans_predict_new() -> str:
    from stray.plans.oracle import scale_expr
    zs = ", ".join(f"(CAST({c} AS DOUBLE) - m_{c}) / {scale_expr(c)} AS {c}" for c in F)
    d2 = " + ".join(f"(p.{c} - c.{c}) * (p.{c} - c.{c})" for c in F)
    return with_(*_km(), _per_type(), ("newz", f"SELECT user_id, event_type, {zs} FROM per, prm"), body=f"""SELECT user_id, event_type,
  CAST(arg_min(cluster, struct_pack(d := d2, c := cluster)) AS INTEGER) AS cluster, {r6('sqrt(min(d2))')} AS cluster_distance
FROM (SELECT p.user_id, p.event_type, c.cluster, {d2} AS d2 FROM newz p, km_c{C.KM_ITER} c) GROUP BY user_id, event_type""")


def centroid_distance() -> str:
    return with_(*_km(), body=f"SELECT user_id, {r6('sqrt(d2)')} AS cluster_distance FROM km_assign")


def cluster_statistics() -> str:
    return with_(*_km(), body="""SELECT CAST(cluster AS INTEGER) AS cluster, CAST(count(*) AS BIGINT) AS size,
  round(avg(sqrt(d2)), 3) AS avg_distance, round(stddev_samp(sqrt(d2)), 3) AS std_distance,
  round(max(sqrt(d2)), 3) AS max_distance
FROM km_assign GROUP BY cluster""")


def cluster_report() -> str:
    return with_(*_km(), ("st", """SELECT cluster, CAST(count(*) AS BIGINT) AS size,
  round(avg(sqrt(d2)), 3) AS avg_distance, round(stddev_samp(sqrt(d2)), 3) AS std_distance,
  round(max(sqrt(d2)), 3) AS max_distance FROM km_assign GROUP BY cluster"""), body=f"""SELECT CAST(a.cluster AS INTEGER) AS cluster,
  user_id, {r6('sqrt(d2)')} AS cluster_distance, size, avg_distance, std_distance, max_distance
FROM km_assign a JOIN st ON st.cluster = a.cluster""")


def kmeans_mllib_bound() -> str:
    return with_(*_km(), body=f"SELECT CAST({C.KM_K} AS INTEGER) AS k, count(*) AS n_users, {r6('sum(d2)')} AS bound FROM km_assign")


def inertia() -> str:
    return with_(*_km(), body=f"SELECT CAST({C.KM_K} AS INTEGER) AS k, {r6('sum(d2)')} AS inertia FROM km_assign")


def silhouette() -> str:
    return """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
d AS (SELECT a.vec_id AS i, a.label AS li, b.label AS lj, list_distance(a.v, b.v) AS dist
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
per AS (SELECT i, li, lj, avg(dist) AS md FROM d GROUP BY i, li, lj),
pt AS (SELECT i, max(CASE WHEN lj = li THEN md END) AS a, min(CASE WHEN lj <> li THEN md END) AS b
       FROM per GROUP BY i),
s AS (SELECT CASE WHEN a IS NULL THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0
                  ELSE (b - a) / greatest(a, b) END AS s FROM pt)
SELECT round(avg(s), 6) AS silhouette FROM s"""


def _sil_ctes(assign: str, tag: str) -> list[tuple[str, str]]:
    return [(f"per_{tag}", f"""SELECT zd.i, la.cluster AS li, lb.cluster AS lj, avg(zd.dist) AS md
FROM zd JOIN {assign} la ON la.user_id = zd.i JOIN {assign} lb ON lb.user_id = zd.j
GROUP BY zd.i, la.cluster, lb.cluster"""),
            (f"sil_{tag}", f"""SELECT avg(CASE WHEN a IS NULL THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0
  ELSE (b - a) / greatest(a, b) END) AS s FROM (SELECT i, max(CASE WHEN lj = li THEN md END) AS a,
  min(CASE WHEN lj <> li THEN md END) AS b FROM per_{tag} GROUP BY i)""")]


def optimal_k() -> str:
    ctes = [*base_ctes()]
    d = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in F)
    ctes.append(("zd", f"SELECT a.user_id AS i, b.user_id AS j, sqrt({d}) AS dist "
                       "FROM z a JOIN z b ON a.user_id <> b.user_id"))
    rows = []
    for k in range(2, 11):
        ctes += lloyd_ctes(k, C.KM_ITER, prefix=f"k{k}")
        ctes += _sil_ctes(f"k{k}_assign", str(k))
        rows.append(f"SELECT CAST({k} AS INTEGER) AS k, {r6(f'(SELECT sum(d2) FROM k{k}_assign)')} AS inertia, "
                    f"{r6(f'(SELECT s FROM sil_{k})')} AS silhouette")
    return with_(*ctes, body="\nUNION ALL\n".join(rows))


def cluster_users() -> str:
    return kmeans_lloyd()


# ---------------------------------------------------------------- A, P


def minmax_scores() -> str:
    return with_(*_km(), ("cd", "SELECT user_id, sqrt(d2) AS cluster_distance FROM km_assign"),
                 body=f"""SELECT user_id, {r6('cluster_distance')} AS cluster_distance,
  {r6(minmax_sql('cluster_distance', 'cd'))} AS cluster_distance_norm FROM cd""")


def _scored_ctes():
    wc, wf, wg = C.DET.normalized_weights()
    ctes = [*_graph(degree_cte(), graph_score_cte(), avgsim_cte(), cf_cte()),
            *lloyd_ctes(C.KM_K, C.KM_ITER, prefix="km")]
    ctes.append(("j", """SELECT a.user_id, a.cluster, sqrt(a.d2) AS cd, c.cf_anomaly_score AS cf,
  g.graph_anomaly_score AS gs FROM km_assign a JOIN cf c ON c.user_id = a.user_id
  JOIN gscore g ON g.user_id = a.user_id"""))
    ctes.append(("comb", f"""SELECT user_id, cluster, cd, {minmax_sql('cd', 'j')} AS cluster_distance_norm,
  {minmax_sql('cf', 'j')} AS cf_score_norm, {minmax_sql('gs', 'j')} AS graph_score_norm FROM j"""))
    ctes.append(("fin", f"""SELECT *, {wc!r} * cluster_distance_norm + {wf!r} * cf_score_norm
  + {wg!r} * graph_score_norm AS final_anomaly_score FROM comb"""))
    ctes.append(("ranked", """SELECT *, CAST(row_number() OVER (ORDER BY final_anomaly_score DESC, user_id ASC)
  AS BIGINT) AS rank FROM fin"""))
    return ctes


_SCORE_COLS = ", ".join(f"{r6(c)} AS {c}" for c in
                        ["cluster_distance_norm", "cf_score_norm", "graph_score_norm",
                         "final_anomaly_score"])


def combined_scores() -> str:
    return with_(*_scored_ctes(), body=f"SELECT user_id, {_SCORE_COLS} FROM fin")


def ranked_scores() -> str:
    return with_(*_scored_ctes(), body=f"SELECT user_id, {_SCORE_COLS}, rank FROM ranked")


def top_anomalies() -> str:
    return with_(*_scored_ctes(), body=f"SELECT user_id, {_SCORE_COLS}, rank FROM ranked "
                                       "ORDER BY rank LIMIT 20")


def threshold_anomalies() -> str:
    return with_(*_scored_ctes(), body=f"""SELECT user_id, {_SCORE_COLS}, rank FROM ranked
WHERE final_anomaly_score >= (SELECT quantile_cont(final_anomaly_score, 0.9) FROM ranked)""")


def score_summary() -> str:
    wc, wf, wg = C.DET.normalized_weights()
    return with_(*_scored_ctes(), body=f"""SELECT CAST(count(*) AS BIGINT) AS n_users,
  {r6(repr(wc))} AS weight_cluster, {r6(repr(wf))} AS weight_cf, {r6(repr(wg))} AS weight_graph,
  {r6('avg(final_anomaly_score)')} AS mean, {r6('median(final_anomaly_score)')} AS median,
  {r6('stddev_samp(final_anomaly_score)')} AS std FROM fin""")


def export_top_k() -> str:
    return with_(*_scored_ctes(), body=f"SELECT user_id, {_SCORE_COLS}, rank FROM ranked "
                                       f"ORDER BY rank LIMIT {C.DET.top_k}")


def pipeline() -> str:
    return with_(*_scored_ctes(), body=f"""SELECT user_id, {_SCORE_COLS}, rank,
  CAST(cluster AS INTEGER) AS cluster FROM ranked""")


def extended_results() -> str:
    zc = ", ".join(f"{r6('z.' + c)} AS {c}" for c in F)
    return with_(*_scored_ctes(), body=f"""SELECT r.user_id, {zc}, CAST(r.cluster AS INTEGER) AS cluster,
  {r6('r.cd')} AS cluster_distance, {r6('r.final_anomaly_score')} AS final_anomaly_score, r.rank
FROM ranked r JOIN z ON z.user_id = r.user_id""")


# ---------------------------------------------------------------- C


def _lg():
    cases = " ".join(f"WHEN '{t}' THEN '{name}'" for name, t in LOG_EVENT_TYPES.items())
    return [("lg", f"""SELECT CASE event_type {cases} END AS log, event_id, user_id AS "user",
  event_type, value FROM events""")]


def _common():
    sel = "\nINTERSECT\n".join(f'''SELECT "user" FROM lg WHERE log = '{n}' '''
                               for n in INTERSECT_LOGS)
    return [("common", sel),
            ("sample", f'''SELECT "user" FROM common
ORDER BY md5(concat('{C.SEED}|', CAST("user" AS VARCHAR))), "user" LIMIT {C.SAMPLE_N}''')]


def _psy():
    return [("psy", '''SELECT c_custkey AS "user" FROM customer''')]


def distinct_users() -> str:
    return with_(*_lg(), body='''SELECT DISTINCT log, "user" FROM lg''')


def common_users() -> str:
    return with_(*_lg(), *_common(), body='''SELECT "user" FROM common''')


def sample_users() -> str:
    return with_(*_lg(), *_common(), body='''SELECT "user" FROM sample''')


def sample_table() -> str:
    return with_(*_lg(), ("http", "SELECT * FROM lg WHERE log = 'http'"),
                 ("hs", f'''SELECT "user" FROM (SELECT DISTINCT "user" FROM http)
ORDER BY md5(concat('{C.SEED}|', CAST("user" AS VARCHAR))), "user" LIMIT {C.SAMPLE_N}'''),
                 body='''SELECT event_id, "user", event_type, value FROM http
WHERE "user" IN (SELECT "user" FROM hs)''')


def cohort_filter() -> str:
    return with_(*_lg(), *_common(), body='''SELECT log, event_id, "user", value FROM lg
WHERE "user" IN (SELECT "user" FROM sample)''')


def cohort_report() -> str:
    return with_(*_lg(), *_common(), *_psy(),
                 ("allrows", "SELECT log, \"user\" FROM lg UNION ALL SELECT 'psychometric', \"user\" FROM psy"),
                 body=f'''SELECT log, CAST(count(*) AS BIGINT) AS rows_before,
  CAST(count(*) FILTER (WHERE "user" IN (SELECT "user" FROM sample)) AS BIGINT) AS rows_after,
  {r6('(1.0 - count(*) FILTER (WHERE "user" IN (SELECT "user" FROM sample)) / count(*)) * 100.0')}
    AS reduction_pct
FROM allrows GROUP BY log''')


def cohort_reduce() -> str:
    return with_(*_lg(), *_common(), *_psy(),
                 ("allrows", "SELECT log, \"user\" FROM lg UNION ALL SELECT 'psychometric', \"user\" FROM psy"),
                 body='''SELECT log, "user", CAST(count(*) AS BIGINT) AS n_rows FROM allrows
WHERE "user" IN (SELECT "user" FROM sample) GROUP BY log, "user"''')


# ---------------------------------------------------------------- V


def report_overview() -> str:
    return with_(*_scored_ctes(), body=f"""SELECT CAST(count(*) AS BIGINT) AS n_users,
  {r6('avg(final_anomaly_score)')} AS mean_score, {r6('max(final_anomaly_score)')} AS max_score,
  CAST(count(*) FILTER (WHERE final_anomaly_score >=
    (SELECT quantile_cont(final_anomaly_score, 0.9) FROM ranked)) AS BIGINT) AS n_anomalies
FROM ranked""")


def report_top_bars() -> str:
    return with_(*_scored_ctes(), body=f"""SELECT CAST((SELECT least(20, count(*)) FROM ranked) - rank AS INTEGER)
  AS position, CAST(user_id AS VARCHAR) AS user_id, {r6('final_anomaly_score')} AS final_anomaly_score
FROM ranked WHERE rank <= 20""")


def report_histogram() -> str:
    return with_(*_scored_ctes(),
                 ("mm", "SELECT min(final_anomaly_score) AS lo, max(final_anomaly_score) AS hi FROM ranked"),
                 ("hb", """SELECT CASE WHEN hi - lo > 0 THEN least(floor((final_anomaly_score - lo) / (hi - lo)
  * 50.0), 49) ELSE 0 END AS bin FROM ranked, mm"""),
                 body=f"""SELECT CAST(g.i AS INTEGER) AS bin, {r6('lo + (hi - lo) * CAST(g.i AS DOUBLE) / 50.0')} AS bin_lo,
  {r6('lo + (hi - lo) * CAST(g.i + 1 AS DOUBLE) / 50.0')} AS bin_hi,
  CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM range(50) g(i) CROSS JOIN mm LEFT JOIN (SELECT bin, count(*) AS n FROM hb GROUP BY bin) c ON c.bin = g.i""")


def report_cluster_sizes() -> str:
    return with_(*_scored_ctes(), body="""SELECT CAST(cluster AS INTEGER) AS cluster,
  CAST(count(*) AS BIGINT) AS count FROM ranked GROUP BY cluster""")


def report_correlation() -> str:
    from stray.plans.oracle import feat_cte
    parts = []
    for x in F:
        for y in F:
            xv, yv = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
            parts.append(f"""SELECT '{x}' AS x, '{y}' AS y, CASE WHEN var_pop({xv}) > 0 AND var_pop({yv}) > 0
  THEN covar_pop({xv}, {yv}) / sqrt(var_pop({xv}) * var_pop({yv})) END AS corr FROM feat""")
    return with_(feat_cte(), body="SELECT x, y, round(corr, 6) AS corr FROM (\n"
                 + "\nUNION ALL\n".join(parts) + "\n)")


def report_scatter() -> str:
    return with_(*_scored_ctes(), body=f"""SELECT r.user_id, {r6('z.value_avg')} AS x, {r6('z.value_std')} AS y,
  CAST(r.cluster AS INTEGER) AS cluster FROM ranked r JOIN z ON z.user_id = r.user_id""")


def report_threshold() -> str:
    return with_(*_scored_ctes(), ("thr", "SELECT quantile_cont(final_anomaly_score, 0.9) AS t FROM ranked"),
                 body=f"""SELECT CAST(rank - 1 AS BIGINT) AS position, {r6('final_anomaly_score')} AS final_anomaly_score,
  final_anomaly_score >= t AS is_anomaly, {r6('t')} AS threshold FROM ranked, thr""")


def report_detail() -> str:
    return with_(*_scored_ctes(), body="""SELECT user_id, round(final_anomaly_score, 4) AS final_anomaly_score,
  rank, CAST(cluster AS INTEGER) AS cluster FROM ranked WHERE rank <= 20""")


SQL = {
    "feature_columns": feature_columns,
    "dataset_summary": dataset_summary,
    "zscore_features": zscore_features,
    "zscore_apply": zscore_apply,
    "scaling_params": scaling_params,
    "pairwise_similarity": pairwise_similarity,
    "global_similarity": global_similarity,
    "avg_similarity": avg_similarity,
    "avg_similarity_one": avg_similarity_one,
    "similar_users": similar_users,
    "similar_users_all": similar_users_all,
    "cf_anomalies": cf_anomalies,
    "similarity_statistics": similarity_statistics,
    "similarity_edges": similarity_edges,
    "connected_components": connected_components,
    "pagerank": pagerank,
    "degree_centrality": degree_centrality,
    "isolated_nodes": isolated_nodes,
    "graph_anomalies": graph_anomalies,
    "graph_statistics": graph_statistics,
    "graph_moments": graph_moments,
    "graph_analysis": graph_analysis,
    "kmeans_lloyd": kmeans_lloyd,
    "kmeans_best_of": kmeans_best_of,
    "cluster_report": cluster_report,
    "kmeans_mllib_bound": kmeans_mllib_bound,
    "kmeans_predict": kmeans_predict,
    "kmeans_predict_new": kmeans_predict_new,
    "centroid_distance": centroid_distance,
    "cluster_statistics": cluster_statistics,
    "inertia": inertia,
    "silhouette": silhouette,
    "optimal_k": optimal_k,
    "cluster_users": cluster_users,
    "minmax_scores": minmax_scores,
    "combined_scores": combined_scores,
    "ranked_scores": ranked_scores,
    "top_anomalies": top_anomalies,
    "threshold_anomalies": threshold_anomalies,
    "score_summary": score_summary,
    "export_top_k": export_top_k,
    "anomaly_pipeline": pipeline,
    "extended_results": extended_results,
    "distinct_users": distinct_users,
    "common_users": common_users,
    "sample_users": sample_users,
    "sample_table": sample_table,
    "cohort_filter": cohort_filter,
    "cohort_report": cohort_report,
    "cohort_reduce": cohort_reduce,
    "report_overview": report_overview,
    "report_top_bars": report_top_bars,
    "report_histogram": report_histogram,
    "report_cluster_sizes": report_cluster_sizes,
    "report_correlation": report_correlation,
    "report_scatter": report_scatter,
    "report_threshold": report_threshold,
    "report_detail": report_detail,
}


def all_sql() -> dict[str, str]:
    return {k: f() for k, f in SQL.items()}
