"""Cohort reduction of raw activity logs.

One grouped pass over the user columns of all logs gives one row per user: a bit for each
log that holds the user, and the user's rows in each. Users common to the core logs are
those with all their bits, and rows before and after the cut are sums over that table, so
the job reads a raw log twice: for the pass, and to keep its rows. The sample is ordered
by a seeded hash of the user (the same on any partitioning, in any engine with md5) and
ranked without one global task; every log keeps its sampled users' rows through a
left-semi join that the planner broadcasts or shuffles by true size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stray.config import INTERSECT_LOGS, USER_COLUMN
from stray.functions.ranking import global_rank
from stray.session import written
from stray.sources.logs import log_users, write_logs


def distinct_users(log: DataFrame, column: str = USER_COLUMN) -> DataFrame:
    """The distinct users of one log."""
    return log_users(log, column)


def user_logs(logs: Mapping[str, DataFrame], column: str = USER_COLUMN) -> DataFrame:
    """(user, logs, rows): for each user of any log a bit per log (in the order of `logs`) and its rows in each.
    One grouped pass; counts are partial before the shuffle, so a user with a third of all rows is a row per task."""
    if len(logs) > 62:
        raise ValueError(f"at most 62 logs, got {len(logs)}")
    each = None
    for i, df in enumerate(logs.values()):
        one = df.select(F.col(column), F.lit(i).alias("_log"), F.lit(1 << i).cast("long").alias("_bit"))
        each = one if each is None else each.unionByName(one)
    counts = F.array(*[F.count_if(F.col("_log") == i) for i in range(len(logs))])
    return each.groupBy(column).agg(F.bit_or("_bit").alias("logs"), counts.alias("rows"))


def in_all(users: DataFrame, logs: Sequence[str], names: Sequence[str], column: str = USER_COLUMN) -> DataFrame:
    """Of `user_logs` the users with the bits of all of `names` that are among `logs`."""
    mask = sum(1 << i for i, name in enumerate(logs) if name in names)
    return users.where(F.col("logs").bitwiseAND(F.lit(mask).cast("long")) == mask).select(column)


def common_users(logs: Mapping[str, DataFrame], names: Sequence[str] = INTERSECT_LOGS,
                 column: str = USER_COLUMN) -> DataFrame | None:
    """Users present in every one of `names` that exists; None if none exists."""
    wanted = {name: logs[name] for name in names if name in logs}
    return in_all(user_logs(wanted, column), list(wanted), names, column) if wanted else None


def sample_key(column: str, seed: int):
    """Seeded, partition-independent order: md5('<seed>|<user>')."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(column).cast("string")))


def sample_users(users: DataFrame, n_users: int = 500, seed: int = 42,
                 column: str = USER_COLUMN) -> DataFrame:
    """min(n, available) users without replacement, the same on any cluster."""
    keyed = users.select(F.col(column), sample_key(column, seed).alias("_k"))
    ranked = global_rank(keyed, [F.col("_k").asc(), F.col(column).asc()], "_r")
    return ranked.where(F.col("_r") <= n_users).select(column)


def keep_users(df: DataFrame, sample: DataFrame, column: str = USER_COLUMN) -> DataFrame:
    """Rows of `df` whose user is in the sample (left-semi join)."""
    return df.join(sample.select(column), column, "left_semi")


def sample_table(df: DataFrame, column: str = USER_COLUMN, n_users: int = 500, seed: int = 42) -> DataFrame:
    """C4: sample users of one table and keep their rows."""
    return keep_users(df, sample_users(distinct_users(df, column), n_users, seed, column), column)


def cohort_filter(logs: Mapping[str, DataFrame], sample: DataFrame, column: str = USER_COLUMN) -> dict[str, DataFrame]:
    """C5 over a set of logs."""
    return {name: keep_users(df, sample, column) for name, df in logs.items()}


def row_counts(users: DataFrame, names: Sequence[str]) -> dict[str, int]:
    """Rows of each log, summed over a table of `user_logs`."""
    sums = users.agg(*[F.coalesce(F.sum(F.col("rows")[i]), F.lit(0)).alias(f"n{i}") for i in range(len(names))]).first()
    return {name: int(sums[f"n{i}"]) for i, name in enumerate(names)}


def input_bytes(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    """Bytes of the files that each frame reads (file-system metadata only); frames without files are left out."""
    out = {}
    for name, df in frames.items():
        if files := df.inputFiles():
            out[name] = sum(path_bytes(df.sparkSession, f) for f in files)
    return out


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under a written path (file-system metadata only)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def cohort_report(spark: SparkSession, before: Mapping[str, int], after: Mapping[str, int],
                  bytes_in: Mapping[str, int] | None = None,
                  bytes_out: Mapping[str, int] | None = None) -> DataFrame:
    """Per log rows before/after, % cut, and MB in/out when paths were given."""
    rows = []
    for name, b in before.items():
        a = after.get(name, 0)
        pct = None if b == 0 else (1.0 - a / b) * 100.0
        mb_in = None if not bytes_in or name not in bytes_in else bytes_in[name] / (1024 * 1024)
        mb_out = None if not bytes_out or name not in bytes_out else bytes_out[name] / (1024 * 1024)
        rows.append((name, b, a, pct, mb_in, mb_out))
    return spark.createDataFrame(rows, "log string, rows_before long, rows_after long, "
                                       "reduction_pct double, mb_in double, mb_out double")


@dataclass
class CohortResult:
    sample: DataFrame
    n_sampled: int
    filtered: dict[str, DataFrame]
    report: DataFrame
    total_mb: float | None
    within_target: bool | None
    suggested_n_users: int | None


def cohort_reduce(logs: Mapping[str, DataFrame], psychometric: DataFrame | None = None,
                  n_users: int = 500, seed: int = 42, out_dir: str | None = None,
                  target_size_mb: float = 500.0, column: str = USER_COLUMN, fmt: str = "csv") -> CohortResult:
    """Common users -> sample -> keep rows of every log (+ psychometric)
    -> optional write -> report. No common users: empty cohort, zero rows kept."""
    before = dict(logs)
    if psychometric is not None:
        before["psychometric"] = psychometric
    spark = next(iter(before.values())).sparkSession
    names = list(before)
    users = written(user_logs(before, column), "user-logs").df
    known = any(name in before for name in INTERSECT_LOGS)
    common = in_all(users, names, INTERSECT_LOGS, column) if known else users.select(column).limit(0)
    sample = written(sample_users(common, n_users, seed, column), "cohort").df
    n_sampled = sample.count()
    filtered = cohort_filter(before, sample, column)
    total_mb = within = suggested = None
    bytes_out = None
    if out_dir is not None:
        paths = write_logs(filtered, out_dir, fmt)
        bytes_out = {k: path_bytes(spark, p) for k, p in paths.items()}
        total_mb = sum(bytes_out.values()) / (1024 * 1024)
        within = total_mb <= target_size_mb * 1.2
        suggested = None if within or total_mb == 0 else int(n_users * target_size_mb / total_mb)
    report = cohort_report(spark, row_counts(users, names), row_counts(keep_users(users, sample, column), names),
                           input_bytes(before) if out_dir is not None else None, bytes_out)
    return CohortResult(sample, n_sampled, filtered, report, total_mb, within, suggested)
