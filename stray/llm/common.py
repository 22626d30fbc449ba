"""What several operators share: tables, shared-folder tables, Arrow batch bounds, words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stray.session import checkpoint_dir

#: Arrow batches carry whole texts; this bounds a batch by bytes, whatever the text lengths.
BATCH_BYTES = 4 << 20
#: White space that separates words: 0x20 and 0x09 to 0x0D, which is what bytes.split() cuts at.
SPACES = " \t\n\r\x0b\x0c"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that very long texts do not meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares (spark.checkpoint.dir)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stray-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives the planner the
    true size of the table, by which it chooses broadcast or shuffle joins.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def least_count(counts: DataFrame, limit: int) -> int | None:
    """The least c such that at most `limit` rows of `counts` (c) have it or more; None if there is none.
    Rows of equal count are in or out together, so the choice needs no order within them."""
    total, least = 0, None
    for r in counts.groupBy("c").agg(F.count("*").alias("k")).orderBy(F.desc("c")).toLocalIterator():
        total += r.k
        if total > limit:
            break
        least = int(r.c)
    return least


def text_of(col: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z only, unlike lower()."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def squeezed(c: Column) -> Column:
    """Lower case, runs of white space as one blank, none at the ends."""
    return F.lower(F.trim(F.regexp_replace(c, SPACE_RUN, " ")))


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, xor-shift), vectorised over uint64."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash for each word, the same in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    return pd.util.hash_array(np.asarray(distinct, dtype=object), categorize=False)[codes]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; a shorter text is one shingle of all its words."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    out = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i:n - size + 1 + i]
    return mixed(out + np.uint64(size))


def batch_word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Word hashes for each text of a batch; words are hashed once a batch."""
    split = [t.split() for t in texts]
    flat = word_hashes([w for ws in split for w in ws])
    ends = np.cumsum([len(ws) for ws in split])
    return np.split(flat, ends[:-1]) if split else []


def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return (b for b in batches if len(b))
