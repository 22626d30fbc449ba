"""DuckDB SQL text for the correctness oracle.

Each builder returns CTE bodies written independently of the Spark code:
features, z-scores and cosines are spelled out per column, pairs are a
brute-force self-join, iterative jobs are unrolled CTE chains.
"""

from __future__ import annotations

from collections.abc import Sequence

from stray.config import GRAPH_MINMAX_EPS, MINMAX_MIN_RANGE, STD_ZERO_RTOL
from stray.sources.fixtures import EVENT_FEATURES, EVENT_TYPES

F = list(EVENT_FEATURES)


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


def with_(*ctes: tuple[str, str], body: str) -> str:
    parts = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {parts}\n{body}"


def feat_cte() -> tuple[str, str]:
    counts = ",\n  ".join(
        f"CAST(sum(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{t}"
        for t in EVENT_TYPES)
    return ("feat", f"""SELECT user_id,
  {counts},
  sum(value) AS value_sum, avg(value) AS value_avg, max(value) AS value_max,
  stddev_pop(value) AS value_std
FROM events GROUP BY user_id""")


def prm_cte(src: str = "feat", cols: Sequence[str] = F) -> tuple[str, str]:
    parts = []
    for c in cols:
        parts.append(f"avg(CAST({c} AS DOUBLE)) AS m_{c}")
        parts.append(f"stddev_pop(CAST({c} AS DOUBLE)) AS sd_{c}")
    return ("prm", f"SELECT {', '.join(parts)} FROM {src}")


def scale_expr(c: str) -> str:
    return (f"(CASE WHEN sd_{c} IS NULL OR sd_{c} <= {STD_ZERO_RTOL!r} * greatest(1.0, abs(m_{c}))"
            f" THEN 1.0 ELSE sd_{c} END)")


def z_cte(src: str = "feat", cols: Sequence[str] = F) -> tuple[str, str]:
    zs = ", ".join(f"(CAST({c} AS DOUBLE) - m_{c}) / {scale_expr(c)} AS {c}" for c in cols)
    return ("z", f"SELECT user_id, {zs} FROM {src}, prm")


def unit_cte(cols: Sequence[str] = F) -> tuple[str, str]:
    sq = " + ".join(f"{c} * {c}" for c in cols)
    us = ", ".join(f"CASE WHEN nrm > 0 THEN {c} / nrm ELSE 0.0 END AS {c}" for c in cols)
    return ("unit", f"SELECT user_id, {us} FROM (SELECT *, sqrt({sq}) AS nrm FROM z)")


def pairs_cte(cols: Sequence[str] = F, name: str = "pairs") -> tuple[str, str]:
    """Brute force: every unordered pair with its cosine."""
    d = " + ".join(f"a.{c} * b.{c}" for c in cols)
    return (name, f"""SELECT a.user_id AS src, b.user_id AS dst, {d} AS sim
FROM unit a JOIN unit b ON a.user_id < b.user_id""")


def base_ctes(cols: Sequence[str] = F) -> list[tuple[str, str]]:
    return [feat_cte(), prm_cte(cols=cols), z_cte(cols=cols), unit_cte(cols)]


def avgsim_cte() -> tuple[str, str]:
    """Per-user mean cosine to all others by brute force over the pairs."""
    return ("avgsim", """SELECT u.user_id,
  CASE WHEN (SELECT count(*) FROM unit) > 1 THEN
    coalesce(sum(p.sim), 0.0) / ((SELECT count(*) FROM unit) - 1) END AS avg_similarity
FROM unit u LEFT JOIN (SELECT src AS id, sim FROM pairs UNION ALL SELECT dst, sim FROM pairs) p
  ON p.id = u.user_id
GROUP BY u.user_id""")


def cf_cte(pct: float = 25.0) -> tuple[str, str]:
    return ("cf", f"""SELECT user_id, avg_similarity, 1.0 - avg_similarity AS cf_anomaly_score,
  coalesce(avg_similarity < (SELECT quantile_cont(avg_similarity, {pct / 100.0!r}) FROM avgsim), false)
    AS is_anomaly
FROM avgsim""")


def edges_cte(threshold: float) -> tuple[str, str]:
    return ("edges", f"SELECT src, dst, sim AS weight FROM pairs WHERE sim >= {threshold!r}")


def pagerank_ctes(iterations: int, alpha: float = 0.85) -> list[tuple[str, str]]:
    """Unrolled weighted PageRank on the undirected `edges` over all users in `unit`."""
    ctes = [
        ("nodes", "SELECT user_id AS id FROM unit"),
        ("nn", "SELECT count(*) AS n FROM nodes"),
        ("dedge", "SELECT src AS a, dst AS b, weight AS w FROM edges "
                  "UNION ALL SELECT dst, src, weight FROM edges"),
        ("outw", "SELECT a, sum(w) AS sw FROM dedge GROUP BY a"),
        ("trans", "SELECT d.a, d.b, d.w / o.sw AS p FROM dedge d JOIN outw o ON d.a = o.a"),
        ("ndang", "SELECT n.id, o.a IS NULL AS dangling FROM nodes n LEFT JOIN outw o ON o.a = n.id"),
        ("pr0", "SELECT id, 1.0 / (SELECT n FROM nn) AS r FROM nodes"),
    ]
    for k in range(1, iterations + 1):
        prev = f"pr{k - 1}"
        ctes.append((f"pr{k}", f"""SELECT x.id,
  {alpha!r} * (coalesce(c.s, 0.0) + (SELECT coalesce(sum(q.r), 0.0) FROM {prev} q JOIN ndang g
      ON g.id = q.id WHERE g.dangling) / (SELECT n FROM nn))
  + (1.0 - {alpha!r}) / (SELECT n FROM nn) AS r
FROM nodes x LEFT JOIN (SELECT t.b AS id, sum(q.r * t.p) AS s FROM trans t JOIN {prev} q
  ON q.id = t.a GROUP BY t.b) c ON c.id = x.id"""))
    ctes.append(("pr", f"SELECT id, r AS pagerank FROM pr{iterations}"))
    return ctes


def degree_cte() -> tuple[str, str]:
    return ("deg", """SELECT n.id, CASE WHEN (SELECT n FROM nn) <= 1 THEN 1.0
  ELSE CAST(coalesce(d.c, 0) AS DOUBLE) / ((SELECT n FROM nn) - 1) END AS degree_centrality
FROM nodes n LEFT JOIN (SELECT a, count(*) AS c FROM dedge GROUP BY a) d ON d.a = n.id""")


def graph_score_cte() -> tuple[str, str]:
    eps = repr(GRAPH_MINMAX_EPS)
    return ("gscore", f"""SELECT p.id AS user_id, p.pagerank, d.degree_centrality,
  ((1.0 - (p.pagerank - mm.pmin) / (mm.pmax - mm.pmin + {eps}))
   + (1.0 - (d.degree_centrality - mm.dmin) / (mm.dmax - mm.dmin + {eps}))) / 2.0
   AS graph_anomaly_score
FROM pr p JOIN deg d ON d.id = p.id,
  (SELECT min(pagerank) AS pmin, max(pagerank) AS pmax FROM pr) mm1,
  (SELECT min(degree_centrality) AS dmin, max(degree_centrality) AS dmax FROM deg) mm2,
  (SELECT mm1.pmin, mm1.pmax, mm2.dmin, mm2.dmax) mm""")


def minmax_sql(col: str, src: str) -> str:
    lo = f"(SELECT min({col}) FROM {src})"
    hi = f"(SELECT max({col}) FROM {src})"
    return (f"CASE WHEN {hi} - {lo} < {MINMAX_MIN_RANGE!r} THEN 0.0 "
            f"ELSE ({col} - {lo}) / ({hi} - {lo}) END")


def lloyd_ctes(k: int, iterations: int, cols: Sequence[str] = F, src: str = "z",
               prefix: str = "km") -> list[tuple[str, str]]:
    """Lloyd from the k lowest-id rows, `iterations` assignment/update steps;
    an empty cluster keeps its centroid. Ends with `{prefix}_assign`."""
    sel = ", ".join(f"{c}" for c in cols)
    ctes = [(f"{prefix}_c0", f"SELECT CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS cluster, "
                             f"{sel} FROM (SELECT * FROM {src} ORDER BY user_id LIMIT {k})")]

    def assign(cen: str) -> str:
        d2 = " + ".join(f"(p.{c} - c.{c}) * (p.{c} - c.{c})" for c in cols)
        return f"""SELECT user_id, arg_min(cluster, struct_pack(d := d2, c := cluster)) AS cluster,
  min(d2) AS d2
FROM (SELECT p.user_id, c.cluster, {d2} AS d2 FROM {src} p, {cen} c) GROUP BY user_id"""

    for it in range(1, iterations + 1):
        prev = f"{prefix}_c{it - 1}"
        ctes.append((f"{prefix}_a{it}", assign(prev)))
        means = ", ".join(f"coalesce(m.{c}, o.{c}) AS {c}" for c in cols)
        avgs = ", ".join(f"avg(p.{c}) AS {c}" for c in cols)
        ctes.append((f"{prefix}_c{it}", f"""SELECT o.cluster, {means}
FROM {prev} o LEFT JOIN (SELECT a.cluster, {avgs} FROM {prefix}_a{it} a JOIN {src} p
  ON p.user_id = a.user_id GROUP BY a.cluster) m ON m.cluster = o.cluster"""))
    ctes.append((f"{prefix}_assign", assign(f"{prefix}_c{iterations}")))
    return ctes


def best_of_ctes(k: int, starts: int, seed: int, iterations: int, cols: Sequence[str] = F, src: str = "z",
                 prefix: str = "bo") -> list[tuple[str, str]]:
    """Lloyd from D^2-weighted starts (seeds seed, seed + 1, ..), all starts side by side; the start of the
    lowest inertia wins. Ends with `{prefix}_assign` (user_id, cluster, d2)."""
    sel = ", ".join(cols)
    hexed = lambda a: f"CAST('0x' || substr(md5(s || '|' || user_id), {a}, 12) AS BIGINT)"
    span = 2 ** 48
    d2 = " + ".join(f"(p.{c} - c.{c}) * (p.{c} - c.{c})" for c in cols)
    ctes = [(f"{prefix}_h", f"SELECT s, user_id, {hexed(1)} AS h1, {hexed(13)} AS h2 FROM {src}, range({seed}, {seed + starts}) t(s)")]

    def u(step: int) -> str:
        return f"(((h.h1 + {step} * h.h2) % {span} + 1) / {span + 1}.0)"

    ctes.append((f"{prefix}_s0", f"""SELECT s, 0 AS cluster, {sel} FROM (
  SELECT h.s, arg_min(h.user_id, struct_pack(w := -ln({u(0)}), i := h.user_id)) AS user_id FROM {prefix}_h h GROUP BY h.s)
  JOIN {src} USING (user_id)"""))
    for j in range(1, k):
        prev = f"{prefix}_s{j - 1}"
        ctes.append((f"{prefix}_s{j}", f"""SELECT s, cluster, {sel} FROM {prev} UNION ALL
SELECT s, {j} AS cluster, {sel} FROM (
  SELECT h.s, arg_min(h.user_id, struct_pack(w := -ln({u(j)}) / n.d2, i := h.user_id)) AS user_id
  FROM {prefix}_h h JOIN (SELECT c.s, p.user_id, min({d2}) AS d2 FROM {src} p, {prev} c GROUP BY c.s, p.user_id) n
    ON n.s = h.s AND n.user_id = h.user_id
  WHERE n.d2 > 0 GROUP BY h.s) JOIN {src} USING (user_id)"""))

    def assign(cen: str) -> str:
        return f"""SELECT s, user_id, arg_min(cluster, struct_pack(d := d2, c := cluster)) AS cluster, min(d2) AS d2
FROM (SELECT c.s, p.user_id, c.cluster, {d2} AS d2 FROM {src} p, {cen} c) GROUP BY s, user_id"""

    cen = f"{prefix}_s{k - 1}"
    means = ", ".join(f"coalesce(m.{c}, o.{c}) AS {c}" for c in cols)
    avgs = ", ".join(f"avg(p.{c}) AS {c}" for c in cols)
    for it in range(1, iterations + 1):
        ctes.append((f"{prefix}_a{it}", assign(cen)))
        ctes.append((f"{prefix}_c{it}", f"""SELECT o.s, o.cluster, {means}
FROM {cen} o LEFT JOIN (SELECT a.s, a.cluster, {avgs} FROM {prefix}_a{it} a JOIN {src} p
  ON p.user_id = a.user_id GROUP BY a.s, a.cluster) m ON m.s = o.s AND m.cluster = o.cluster"""))
        cen = f"{prefix}_c{it}"
    ctes.append((f"{prefix}_all", assign(cen)))
    ctes.append((f"{prefix}_best", f"""SELECT arg_min(s, struct_pack(c := cost, s := s)) AS s FROM (
  SELECT s, round(sum(d2), 6) AS cost FROM {prefix}_all GROUP BY s)"""))
    ctes.append((f"{prefix}_assign", f"SELECT user_id, cluster, d2 FROM {prefix}_all JOIN {prefix}_best USING (s)"))
    return ctes
