"""User feature tables: load, detect features, validate, summarise, save."""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stray.config import METADATA_COLUMNS
from stray.functions.stats import exact_percentiles_by_column

#: Quotes within quotes are doubled.
CSV_QUOTES = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: The words that stand for a missing value.
NA_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
            "NULL", "NaN", "None", "n/a", "nan", "null")
_INTEGER = r"^\s*[+-]?[0-9]{1,18}\s*$"
_NUMBER = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)\s*$"
_FEATURE_TYPES = (T.NumericType, T.BooleanType)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) or bool(fs.globStatus(p))


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def _balanced(spark: SparkSession, path: str) -> None:
    """Fail where a quoted value goes on over a line break: a line then has an odd number of quotes."""
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    first = spark.read.text(path).where(F.contains(F.col("value"), F.lit('"')) & odd).limit(1).collect()
    if first:
        raise ValueError(f"{path}: unbalanced quotes in the line {first[0].value[:80]!r}; if quoted values hold line breaks, "
                         "read with multi_line=True (one task for each file)")


def with_types(df: DataFrame) -> DataFrame:
    """Columns of text whose values all are whole numbers, numbers or truth values, missing ones apart, as such; one
    aggregate. Whole numbers with gaps stay whole numbers. All other columns stay text."""
    if not df.columns:
        return df
    checks = []
    for i, c in enumerate(df.columns):
        x = _quoted(c)
        checks += [F.count(x).alias(f"n{i}"), F.count_if(x.rlike(_INTEGER)).alias(f"i{i}"), F.count_if(x.rlike(_NUMBER)).alias(f"d{i}"),
                   F.count_if(F.lower(x).isin("true", "false")).alias(f"b{i}")]
    got = df.agg(*checks).first()
    out = []
    for i, c in enumerate(df.columns):
        n, x = got[f"n{i}"], _quoted(c)
        kind = None if not n else "bigint" if got[f"i{i}"] == n else "double" if got[f"d{i}"] == n else "boolean" if got[f"b{i}"] == n else None
        out.append((F.trim(x).cast(kind) if kind else x).alias(c))
    return df.select(*out)


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema: T.StructType | str | None = None, as_text: bool = False, multi_line: bool = False) -> DataFrame:
    """CSV (header, NA_WORDS as null, doubled quotes) or Parquet by extension; a missing path is an error.

    A large CSV file is split over many tasks. Where quoted values hold line breaks that cannot be: such a file is an
    error unless `multi_line`, which reads each file in one task. `as_text` leaves CSV values as they stand."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"File not found: {path}")
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt != "csv":
        return reader.format(fmt).load(path)
    if not multi_line:
        _balanced(spark, path)
    reader = reader.options(header=True, multiLine=multi_line, **CSV_QUOTES)
    if schema is not None:
        return reader.options(nullValue="NA", nanValue="NaN").csv(path)
    text = reader.option("inferSchema", False).csv(path)
    text = text.select(*[F.when(~_quoted(c).isin(*NA_WORDS), _quoted(c)).alias(c) for c in text.columns])
    return text if as_text else with_types(text)


def feature_columns(df: DataFrame, exclude: Iterable[str] | None = None,
                    id_col: str = "user_id") -> list[str]:
    """Numeric and boolean columns in file order, minus metadata and `exclude`."""
    excluded = set(METADATA_COLUMNS) | set(exclude or ()) | {id_col}
    feats = [f.name for f in df.schema.fields
             if isinstance(f.dataType, _FEATURE_TYPES) and f.name not in excluded]
    if not feats:
        raise ValueError("No numeric features found")
    return feats


def require_id(df: DataFrame, id_col: str = "user_id") -> None:
    if id_col not in df.columns:
        raise ValueError(f"Column '{id_col}' is required")


def check_unique_ids(df: DataFrame, id_col: str = "user_id") -> None:
    """One row per user (duplicates would fan out every later join). One shuffle of ids."""
    dup = (df.groupBy(id_col).agg(F.count(F.lit(1)).alias("c"))
           .where(F.col("c") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"duplicate {id_col}: {dup[0][id_col]!r} appears {dup[0]['c']} times")


def load_user_features(spark: SparkSession, path: str, exclude_columns: Sequence[str] | None = None,
                       fmt: str | None = None, schema=None, id_col: str = "user_id",
                       validate: bool = True, multi_line: bool = False) -> tuple[DataFrame, list[str]]:
    """Read, check the key, detect features; NaN in features becomes null."""
    df = read_table(spark, path, fmt, schema, multi_line=multi_line)
    return prepare_user_features(df, exclude_columns, id_col, validate)


def prepare_user_features(df: DataFrame, exclude_columns: Sequence[str] | None = None,
                          id_col: str = "user_id", validate: bool = True
                          ) -> tuple[DataFrame, list[str]]:
    require_id(df, id_col)
    feats = feature_columns(df, exclude_columns, id_col)
    fixed = df.select(*[
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])
    if validate:
        check_unique_ids(fixed, id_col)
    return fixed, feats


def dataset_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """S3 as a tidy (column, metric, value) frame.

    n_users / n_features once, null count of every column, and for each
    feature the describe() set: count, mean, std (sample), min, 25%, 50%, 75%, max.
    """
    spark = df.sparkSession
    fx = [F.col(c).cast("double") for c in features]
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(df.columns)]
    for i, c in enumerate(fx):
        aggs += [F.count(c).alias(f"_cnt_{i}"), F.avg(c).alias(f"_avg_{i}"),
                 F.stddev_samp(c).alias(f"_std_{i}"),
                 F.min(c).alias(f"_min_{i}"), F.max(c).alias(f"_max_{i}")]
    row = df.agg(*aggs).first()
    q = exact_percentiles_by_column(df, list(features), [25, 50, 75])
    out = [("*", "n_users", float(row["_n"])), ("*", "n_features", float(len(features)))]
    out += [(c, "missing", float(row[f"_null_{i}"])) for i, c in enumerate(df.columns)]
    for i, c in enumerate(features):
        std = row[f"_std_{i}"]
        out += [(c, "count", float(row[f"_cnt_{i}"])), (c, "mean", row[f"_avg_{i}"]),
                (c, "std", std if std is None else float(std)),
                (c, "min", row[f"_min_{i}"]), (c, "25%", q[c][0]), (c, "50%", q[c][1]),
                (c, "75%", q[c][2]), (c, "max", row[f"_max_{i}"])]
    schema = "column string, metric string, value double"
    return spark.createDataFrame([(a, b, None if v is None else float(v)) for a, b, v in out], schema)


def save_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """One distributed write (a folder of part files)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.options(header=True, **CSV_QUOTES)
    w.format(fmt).save(path)


def extended_path(output_path: str) -> str:
    root, ext = os.path.splitext(output_path.rstrip("/"))
    return f"{root}_extended{ext}"


def read_results(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """A ranked result table; it must hold final_anomaly_score."""
    df = read_table(spark, path, fmt, schema)
    if "final_anomaly_score" not in df.columns:
        raise ValueError("the results must contain 'final_anomaly_score'")
    return df
