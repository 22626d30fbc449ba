"""Distributed statistics with bounded driver traffic.

Spark's exact ``percentile`` merges every distinct value of a global aggregate in one
task. Here a mergeable quantile sketch (``percentile_approx``: order statistics whose rank
is off by n / SKETCH at most) names two values between which each wanted rank lies, and
one counting pass takes how many values lie below them and the distinct values between
them with their counts: two passes over the data, whatever the distribution. What lies
between is a share of 4 / SKETCH of the rows at most, or a few hot values; it is written,
and ranks are located in it by histograms of bounded size. Infinities are values like any
other: they are the first and the last of their column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stray.session import reliable_checkpoint

#: Bins of a bracket in one pass; the driver gets at most so many rows for a rank.
BINS = 4096
#: Accuracy of the sketch, and how far from a rank, as a share of the rows, its bracket may reach:
#: the least that covers the sketch's error and two more ranks.
SKETCH = 2000
MARGINS = (2.0 / SKETCH, 0.02, 0.2, 1.0)


def rank_targets(n: int, ps: Sequence[float]) -> list[tuple[int, int, float]]:
    """Linear interpolation positions (numpy 'linear', DuckDB quantile_cont)."""
    out = []
    for p in ps:
        pos = (p / 100.0) * (n - 1)
        lo = int(math.floor(pos))
        hi = min(lo + 1, n - 1)
        out.append((lo, hi, pos - lo))
    return out


def interpolate(vlo: float, vhi: float, frac: float) -> float:
    if frac == 0.0 or vlo == vhi:
        return vlo
    return vlo + (vhi - vlo) * frac


def _pick(rows: list, r: int, below: int) -> tuple[int, object]:
    """Of rows in order with a count n, the one that holds rank r, and the values below it."""
    for row in rows:
        if r < below + row["n"]:
            return below, row
        below += row["n"]
    raise RuntimeError("rank outside its bracket")


def _located(between: DataFrame, wanted: dict[int, list[tuple[int, int]]]) -> dict[tuple[int, int], float]:
    """Values of ranks in `between` (q, x, n), finite distinct values with counts: wanted[q] = [(rank, values below)].

    Each pass bins every bracket between its least and greatest value; a bin is the next bracket."""
    done: dict[tuple[int, int], float] = {}
    state = {(q, r): (None, None, below) for q, rs in wanted.items() for r, below in rs}
    while state:
        brackets = sorted({(q, lo, hi) for (q, _), (lo, hi, _) in state.items()}, key=str)
        number = {b: k for k, b in enumerate(brackets)}
        if any(lo is None for _, lo, _ in brackets):
            ends = {r["q"]: (r["lo"], r["hi"]) for r in between.groupBy("q").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
            state = {(q, r): (*ends[q], below) if lo is None else (lo, hi, below) for (q, r), (lo, hi, below) in state.items()}
            done |= {at: lo for at, (lo, hi, _) in state.items() if lo == hi}
            state = {at: x for at, x in state.items() if at not in done}
            continue
        rows = between.sparkSession.createDataFrame([(k, q, lo, hi) for (q, lo, hi), k in number.items()], "k int, bq int, lo double, hi double")
        half = (F.col("x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        bin_no = F.least(F.lit(BINS - 1), F.floor(half * BINS)).cast("int")
        bins = (between.join(F.broadcast(rows), (F.col("q") == F.col("bq")) & F.col("x").between(F.col("lo"), F.col("hi")))
                .groupBy("k", bin_no.alias("b")).agg(F.sum("n").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
                .orderBy("k", "b").collect())
        of: dict[int, list] = {}
        for row in bins:
            of.setdefault(row["k"], []).append(row)
        for (q, r), (lo, hi, below) in list(state.items()):
            below, row = _pick(of[number[(q, lo, hi)]], r, below)
            if row["lo"] == row["hi"]:
                done[(q, r)] = row["lo"]
                del state[(q, r)]
            elif (row["lo"], row["hi"]) == (lo, hi):
                raise RuntimeError(f"no progress between {lo} and {hi}")
            else:
                state[(q, r)] = (row["lo"], row["hi"], below)
    return done


def exact_percentiles_by_column(df: DataFrame, cols: Sequence[str], ps: Sequence[float]
                                ) -> dict[str, list[float | None]]:
    """Exact linear-interpolated percentiles (p in 0..100) of several columns, nulls and NaN skipped."""
    if not cols:
        return {}
    spark = df.sparkSession
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("k"), F.col(f"`{c}`").cast("double").alias("x")) for c in cols
    ])).alias("kv")).select("kv.k", "kv.x").where(F.col("x").isNotNull() & ~F.isnan("x"))
    shares = [min(1.0, max(0.0, p / 100.0 + d)) for p in ps for m in MARGINS for d in (-m, m)]
    found = {r["k"]: r for r in long.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.percentile_approx("x", shares, SKETCH).alias("s")).collect()}
    targets = {c: rank_targets(found[c]["n"], ps) for c in cols if c in found}
    # one bracket for each column and percentage, wide enough for both of its ranks
    brackets, ranks = [], {}
    for c, ts in targets.items():
        f = found[c]
        wide = next((k for k, m in enumerate(MARGINS) if m >= 2.0 / f["n"] + 1.0 / SKETCH), len(MARGINS) - 1)
        for i, (lo, hi, _) in enumerate(ts):
            at = 2 * (len(MARGINS) * i + wide)
            first = f["lo"] if ps[i] / 100.0 <= MARGINS[wide] else f["s"][at]
            last = f["hi"] if ps[i] / 100.0 >= 1.0 - MARGINS[wide] else f["s"][at + 1]
            ranks[len(brackets)] = (c, i, lo, hi)
            brackets.append((c, first, last))
    vals: dict[tuple[str, int], float] = {}
    open_ = dict(enumerate(brackets))
    while open_:
        rows = F.broadcast(spark.createDataFrame([(q, *b) for q, b in open_.items()], "q int, bk string, lo double, hi double"))
        inside = (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))
        counts = reliable_checkpoint(
            long.join(rows, F.col("k") == F.col("bk")).where(F.col("x") <= F.col("hi"))
            .groupBy("q", F.when(inside, F.col("x")).alias("x")).agg(F.count(F.lit(1)).alias("n")))
        sums = {q: {"below": 0, "inside": 0} for q in open_}
        for r in counts.groupBy("q", F.col("x").isNotNull().alias("in")).agg(F.sum("n").alias("n")).collect():
            sums[r["q"]]["inside" if r["in"] else "below"] = r["n"]
        between = counts.where(F.col("x").isNotNull())
        edge = F.abs("x") == float("inf")
        ends = {(r["q"], r["x"]): r["n"] for r in between.where(edge).collect()}  # two a bracket at most
        wanted: dict[int, list] = {}
        following = {}
        for q, (c, lo, hi) in open_.items():
            _, _, first, last = ranks[q]
            below, total = sums[q]["below"], sums[q]["inside"]
            if first < below or last >= below + total:  # the input drifted between the passes: look further
                following[q] = (c, found[c]["lo"] if first < below else lo, found[c]["hi"] if last >= below + total else hi)
                if following[q] == open_[q]:
                    raise RuntimeError(f"the values of {c!r} change between passes: materialise them first")
                continue
            low, high = ends.get((q, float("-inf")), 0), ends.get((q, float("inf")), 0)
            for r in {first, last}:
                if r < below + low:
                    vals[(q, r)] = float("-inf")
                elif r >= below + total - high:
                    vals[(q, r)] = float("inf")
                else:
                    wanted.setdefault(q, []).append((r, below + low))
        if wanted:
            finite = between.where(~edge & F.col("q").isin(list(wanted)))
            if sum(sums[q]["inside"] for q in wanted) <= BINS:
                by_q: dict[int, list] = {}
                for row in finite.orderBy("q", "x").collect():
                    by_q.setdefault(row["q"], []).append(row)
                vals |= {(q, r): _pick(by_q[q], r, below)[1]["x"] for q, rs in wanted.items() for r, below in rs}
            else:
                vals |= _located(finite, wanted)
        open_ = following
    of: dict[str, list] = {c: [None] * len(ps) for c in cols}
    for q, (c, i, first, last) in ranks.items():
        of[c][i] = interpolate(vals[(q, first)], vals[(q, last)], targets[c][i][2])
    return of


def exact_percentiles(df: DataFrame, col: str | Column, ps: Sequence[float]) -> list[float | None]:
    """Exact linear-interpolated percentiles (p in 0..100) of one column."""
    c = F.col(col) if isinstance(col, str) else col
    return exact_percentiles_by_column(df.select(c.alias("x")), ["x"], ps)["x"]


def minmax_bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[F.min(c).alias(f"mn{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"mx{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"mn{i}"], row[f"mx{i}"]) for i, c in enumerate(cols)}


def minmax_cutoff(c: Column, lo: float | None, hi: float | None, min_range: float) -> Column:
    """(x - lo)/(hi - lo); a range below `min_range` maps everything to 0."""
    if lo is None or hi is None or (hi - lo) < min_range:
        return F.lit(0.0)
    return (c - F.lit(lo)) / F.lit(hi - lo)


def minmax_eps(c: Column, lo: float | None, hi: float | None, eps: float) -> Column:
    """(x - lo)/(hi - lo + eps)."""
    if lo is None or hi is None:
        return F.lit(0.0)
    return (c - F.lit(lo)) / F.lit(hi - lo + eps)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (final presentation only; never before a comparison)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])
