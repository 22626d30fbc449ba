"""Population z-score.

Fit is one global aggregate (partial per partition, so any skew is
absorbed map-side); its d means and d scales come back to the driver
(bounded by the feature count) and are applied as literals in a
projection, so the transform is a narrow, codegen'd stage with no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stray.config import METADATA_COLUMNS, STD_ZERO_RTOL
from stray.functions.vectors import vector
from stray.sources.loader import save_table


def resolve_feature_columns(df: DataFrame, features: Sequence[str] | None = None,
                            id_col: str = "user_id") -> list[str]:
    """A given list must exist; otherwise numeric/bool columns minus metadata."""
    if features is not None:
        missing = set(features) - set(df.columns)
        if missing:
            raise ValueError(f"Missing columns: {sorted(missing)}")
        return list(features)
    excluded = set(METADATA_COLUMNS) | {id_col}
    inferred = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in excluded]
    if not inferred:
        raise ValueError("No numeric columns found")
    return inferred


@dataclass(frozen=True)
class ZScoreModel:
    features: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    id_col: str = "user_id"
    nulls: str = "error"

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """(x - mean) / scale with the fitted parameters; keeps id (+ `keep`) + features."""
        missing = set(self.features) - set(df.columns)
        if missing:
            raise ValueError(f"Missing columns: {sorted(missing)}")
        cols = []
        for c, m, s in zip(self.features, self.means, self.scales):
            z = (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
            if self.nulls == "mean":
                z = F.coalesce(z, F.lit(0.0))
            cols.append(z.alias(c))
        return df.select(F.col(self.id_col), *keep, *cols)

    def params(self, spark: SparkSession) -> DataFrame:
        """Tidy (feature, mean, std)."""
        rows = [(f, float(m), float(s)) for f, m, s in zip(self.features, self.means, self.scales)]
        return spark.createDataFrame(rows, "feature string, mean double, std double")


def fit_zscore(df: DataFrame, features: Sequence[str] | None = None, id_col: str = "user_id",
               nulls: str = "error") -> ZScoreModel:
    """Fit means and population std in one aggregate; (near-)zero std becomes 1."""
    if nulls not in ("error", "mean"):
        raise ValueError("nulls must be 'error' or 'mean'")
    feats = resolve_feature_columns(df, features, id_col)
    x = [F.col(c).cast("double") for c in feats]
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(c).alias(f"_c{i}") for i, c in enumerate(x)],
                 *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(x)],
                 *[F.stddev_pop(c).alias(f"_s{i}") for i, c in enumerate(x)]).first()
    n = row["_n"]
    if n == 0:
        raise ValueError("empty feature table")
    means, scales = [], []
    for i, c in enumerate(feats):
        if row[f"_c{i}"] < n and nulls == "error":
            raise ValueError(f"feature '{c}' has {n - row[f'_c{i}']} null values (use nulls='mean')")
        m = row[f"_m{i}"]
        s = row[f"_s{i}"]
        m = 0.0 if m is None else float(m)
        s = 0.0 if s is None else float(s)
        if s <= STD_ZERO_RTOL * max(1.0, abs(m)):
            s = 1.0
        means.append(m)
        scales.append(s)
    return ZScoreModel(tuple(feats), tuple(means), tuple(scales), id_col, nulls)


def zscore(df: DataFrame, features: Sequence[str] | None = None, id_col: str = "user_id",
           nulls: str = "error") -> tuple[DataFrame, ZScoreModel]:
    """Fit + transform."""
    model = fit_zscore(df, features, id_col, nulls)
    return model.transform(df), model


def normalize_features(df: DataFrame, save_path: str = "", features: Sequence[str] | None = None,
                       id_col: str = "user_id", nulls: str = "error") -> DataFrame:
    """Z-score, optionally written out."""
    out, _ = zscore(df, features, id_col, nulls)
    if save_path:
        save_table(out, save_path)
    return out


def as_vectors(normalized: DataFrame, features: Sequence[str], id_col: str = "user_id",
               keep: Sequence[str] = ()) -> DataFrame:
    """(id, z array<double>) working form for the matrix stages."""
    return normalized.select(F.col(id_col), vector(features).alias("z"), *keep)
