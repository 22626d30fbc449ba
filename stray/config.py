"""Pipeline parameters and the fixed values every stage shares."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Metadata columns that are never features (ids, timestamps,
# organisational attributes, the ground-truth label).
METADATA_COLUMNS = (
    "starttime", "endtime", "user_id", "b_unit",
    "role", "f_unit", "dept", "team", "insider",
)

# The raw activity logs of a cohort job, each keyed by `user`;
# the first four define the common users, `http` is filtered but not intersected.
LOG_NAMES = ("logon", "device", "file", "email", "http")
INTERSECT_LOGS = ("logon", "device", "file", "email")
USER_COLUMN = "user"

# Numeric guards.
STD_ZERO_RTOL = 1e-12      # std <= rtol * max(1, |mean|) counts as constant -> scale 1
MINMAX_MIN_RANGE = 1e-10   # score min-max: a smaller range maps every score to 0
GRAPH_MINMAX_EPS = 1e-10   # graph score min-max: added to the denominator


@dataclass(frozen=True)
class PipelineConfig:
    """Parameters of one scoring run (the reference's command-line options)."""

    n_clusters: int | None = None          # None -> 5 unless find_optimal_k
    find_optimal_k: bool = False
    k_range: tuple[int, ...] = tuple(range(2, 11))
    similarity_threshold: float = 0.7
    weight_cluster: float = 0.3
    weight_cf: float = 0.4
    weight_graph: float = 0.3
    top_k: int = 20
    show_summary: bool = True
    seed: int = 42
    # K-Means: "d2" = best of `kmeans_starts` D^2-weighted starts, "sampled" = of seeded
    # rows, all runs (and all k of find_optimal_k) advancing in one pass per step with
    # distance bounds; "mllib" = best of `kmeans_starts` MLlib fits (k-means||), one after
    # another; "lowest_ids" = Lloyd from the k rows with the lowest ids.
    kmeans_init: str = "d2"
    kmeans_starts: int = 10
    kmeans_max_iter: int = 300
    kmeans_tol: float | None = 1e-4
    cf_percentile: float = 25.0
    pagerank_alpha: float = 0.85
    pagerank_max_iter: int = 100
    pagerank_tol: float | None = 1e-6     # None -> run exactly max_iter steps
    block_size: int = 2048                 # users per block of the pair kernel
    nulls: str = "error"                   # "error" | "mean"

    def with_(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)

    def normalized_weights(self) -> tuple[float, float, float]:
        total = self.weight_cluster + self.weight_cf + self.weight_graph
        if total == 0:
            raise ValueError("weights sum to 0")
        return (self.weight_cluster / total, self.weight_cf / total, self.weight_graph / total)
