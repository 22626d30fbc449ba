"""Quality rules by cross-document line frequency.

Lines are normalised (lower case, white-space runs as one blank) and hashed; for each
host the distinct documents holding a line are counted, exact copies of a text once.
A line in more than max(`min_docs`, `growth` floor(log2 n)) of the n distinct texts of its host is
removed, and a document that loses too many words is rejected: the limit hardly rises
with the host. References (host, text, line, words) are joined with the lines above the
limit by (host, line), and what a text loses comes back by (host, text); Spark splits such
joins where a line or host holds a third of all rows, counts pre-aggregate, and no text is
shuffled to be judged. Only the stage, which returns texts, joins them with their lines.

Defined cases: a null text has no words; a null host is the host ''; lines without a
word are neither counted nor removed; repeated rows are judged alike, each on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stray.llm.common import SPACES, bounded_batches, materialise, text_of

SYMBOLS = "#*$%&|<>"
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
PROFILE = StructType([StructField(c, LongType()) for c in FIGURES])


@dataclass(frozen=True)
class LineRules:
    """A line is removed when more than max(min_docs, growth floor(log2 n)) of the n distinct
    documents of its host hold it; a document is depleted when less than `remain` of its
    words is left."""

    min_docs: int = 5
    growth: int = 2
    remain: float = 0.5
    min_words: int = 50
    max_repeat_percent: int = 50


def line_hash(line: str) -> int | None:
    """Hash of a normalised line; null for a line without a word."""
    words = line.encode().split()
    if not words:
        return None
    plain = b" ".join(words).decode("utf-8", "replace").lower()
    return int.from_bytes(hashlib.blake2b(plain.encode(), digest_size=8).digest(), "little", signed=True)


def keys_of(host: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(host).cast("string"), F.lit("")).alias("h"), F.xxhash64(text_of(text)).alias("copy")]


def line_references(docs: DataFrame, host: str, text: str) -> DataFrame:
    """(h, copy, line, words): the lines of every distinct text of a host, each once, and their words in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lines, words = [], [], []
            for i, t in enumerate(batch.column("t").to_pylist()):
                own: dict[int, int] = {}
                for line in t.split("\n"):
                    key = line_hash(line)
                    if key is not None:
                        own[key] = own.get(key, 0) + len(line.encode().split())
                rows += [i] * len(own)
                lines += own.keys()
                words += own.values()
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("h").take(at), batch.column("copy").take(at), pa.array(lines, pa.int64()),
                                              pa.array(words, pa.int64())], ["h", "copy", "line", "words"])

    found = docs.select(*keys_of(host, text), text_of(text).alias("t")).mapInArrow(run, "h string, copy long, line long, words long")
    return materialise(found.distinct(), "line-refs")


def losses(docs: DataFrame, host: str, text: str, rules: LineRules) -> DataFrame:
    """(h, copy, lost, bad): the words that a text loses on its host, and the hashes of the lines that go."""
    refs = line_references(docs, host, text)
    sizes = docs.select(*keys_of(host, text)).distinct().groupBy("h").agg(F.count("*").alias("n"))
    held = refs.groupBy("h", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > rules.min_docs)
    limit = F.greatest(F.lit(rules.min_docs), rules.growth * (F.length(F.bin("n")) - 1))
    often = materialise(held.join(sizes, "h").where(F.col("docs") > limit).select("h", "line"), "frequent-lines")
    return materialise(refs.join(often, ["h", "line"]).groupBy("h", "copy").agg(
        F.sum("words").alias("lost"), F.collect_set("line").alias("bad")), "losses")


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    _, pairs = np.unique(ids[:-2] * len(codes) + ids[1:-1], return_inverse=True)
    _, window, times = np.unique(pairs * len(codes) + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    inside = np.zeros(n, bool)
    for i in range(3):
        inside[i:n - 2 + i] |= again
    return int(inside.sum())


def profile(text: str) -> tuple[int, ...]:
    """The base figures of a text."""
    words = text.encode().split()
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            dup += line in seen
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup, repeated_words(words))


@F.pandas_udf(PROFILE)
def profiles(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([profile(t) for t in text], columns=list(FIGURES)).astype("int64")


@F.pandas_udf(StringType())
def without_lines(text: pd.Series, bad: pd.Series) -> pd.Series:
    return text.combine(bad, lambda t, b: t if b is None else "\n".join(x for x in t.split("\n") if line_hash(x) not in set(b)))


def judge(docs: DataFrame, host: str = "source", text: str = "text", rules: LineRules = LineRules(),
          keep_text: bool = True) -> DataFrame:
    """One row (doc, f, kept_words, base_failed, kept) per row of `docs`, and where `keep_text` the text (_t) and
    the hashes of the lines that go (bad).

    `doc` is the whole input row as a struct (without the text where that is not kept), so no column can clash.
    """
    bounded_batches(docs.sparkSession)
    lost = losses(docs, host, text, rules)
    columns = [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(f"`{c}`") for c in columns], F.lit(None).alias("_none")).alias("doc")
    said = [text_of(text).alias("_t")] if keep_text else []
    rows = docs.select(row, *keys_of(host, text), *said, profiles(text_of(text)).alias("f"))
    if not keep_text:
        lost = lost.drop("bad")
    out = rows.join(lost, ["h", "copy"], "left")
    failed = ((F.col("f.n_words") < rules.min_words)
              | (100 * F.col("f.n_repeat_words") > rules.max_repeat_percent * F.col("f.n_words")))
    out = out.withColumn("kept_words", F.col("f.n_words") - F.coalesce("lost", F.lit(0))).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("kept_words") >= rules.remain * F.col("f.n_words")))


def quality_query(docs: DataFrame) -> DataFrame:
    """The digest of every document: figures, base_failed and kept."""
    return judge(docs.select("doc_id", "text", "source"), keep_text=False).select(
        "doc.doc_id", "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines", "f.n_repeat_words",
        "base_failed", "kept", "kept_words")


def quality_stage(docs: DataFrame) -> DataFrame:
    """Kept documents without their removed lines; n_chars follows the text."""
    kept = judge(docs).where("kept").select("doc", without_lines("_t", "bad").alias("cleaned"))
    put = {"text": F.col("cleaned"), "n_chars": F.char_length("cleaned").cast("long")}
    return kept.select(*[put[c].alias(c) if c in put else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS h FROM documents),
ln AS (SELECT doc_id, h, t, i, string_split(t, chr(10))[i] AS l
       FROM (SELECT *, unnest(generate_series(1, len(string_split(t, chr(10))))) AS i FROM d)),
nl AS (SELECT *, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))) AS p FROM ln),
sizes AS (SELECT h, count(DISTINCT t) AS n FROM d GROUP BY h),
freq AS (SELECT nl.h, p FROM nl JOIN sizes USING (h) WHERE p <> ''
         GROUP BY nl.h, p, n HAVING count(DISTINCT t) > greatest(5, 2 * floor(log2(n)))),
lw AS (SELECT doc_id, p <> '' AS worded, (freq.p IS NULL) AS stays,
              row_number() OVER (PARTITION BY doc_id, l ORDER BY i) AS k,
              len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS w
       FROM nl LEFT JOIN freq USING (h, p)),
lines AS (SELECT doc_id, sum(CASE WHEN worded AND k > 1 THEN 1 ELSE 0 END) AS dup,
                 sum(CASE WHEN stays THEN w ELSE 0 END) AS left_words FROM lw GROUP BY doc_id),
ws AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
pos AS (SELECT doc_id, i, w[i] || chr(10) || w[i+1] || chr(10) || w[i+2] AS g
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM ws WHERE len(w) > 2)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM pos) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + s) AS r FROM rep, (VALUES (0), (1), (2)) AS v(s) GROUP BY doc_id),
f AS (SELECT ws.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(dup AS BIGINT) AS n_dup_lines, CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words,
             CAST(left_words AS BIGINT) AS kept_words
      FROM ws JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND kept_words >= 0.5 * n_words) AS kept,
       kept_words
FROM f
"""
