"""Document fingerprints by a threshold-scaled sketch.

Of the hashes of a text's five-word shingles, every one below a fixed fraction of the
hash range is retained. Such sketches have no fixed size, merge by union, and compare
texts of very unequal lengths: the retained part of an intersection is a fair sample of
the intersection. Likeness is the containment of the smaller sketch in the larger.

To meet each document's successor (by descending id) without one global order in one
task, documents are cut into ranges of ids of bounded bytes, sorted within their range,
and the first document of each range is sent to the range before it as well. Texts are
compressed for that one exchange.

A text of k shingles retains none with probability (1 - fraction)^k. Where that happens to
either of two texts, their likeness comes from all their shingles, which are few in one of
them, and a text that retains none has the digest of its words as its fingerprint, so that
short texts of different words differ.

Defined cases: a null text is empty; a text without words has the fingerprint '', likeness
1 to another such and 0 to all others; a text of fewer than five words is one shingle; of
equal ids the digest of the text decides the order; null ids
come last; a single document is its own successor; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from stray.llm.common import batch_word_hashes, bounded_batches, rows_of, shingle_hashes, text_of

FRACTION = 1 / 8
SHINGLE = 5
#: Texts of one range, in bytes, about; smaller ones, down to the least, where there would be fewer than tasks.
RANGE_BYTES = 16 << 20
LEAST_BYTES = 1 << 18
#: Ranges at most: their borders pass through the driver. A range is sorted and streamed, never held.
MAX_RANGES = 4096


def sketch(words: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sorted distinct shingle hashes below `fraction` of the range."""
    h = shingle_hashes(words, SHINGLE)
    return np.unique(h[h < np.uint64(fraction * 2.0 ** 64)])


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    return np.union1d(a, b)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Containment of the smaller sketch in the larger."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def as_text(s: np.ndarray) -> str:
    return base64.b64encode(s.astype("<u8").tobytes()).decode()


def fingerprint(words: np.ndarray, s: np.ndarray) -> str:
    """The sketch `s` of the words as text; the digest of the words where it is empty and they are not."""
    if len(s) or not len(words):
        return as_text(s)
    return "words:" + hashlib.sha256(words.astype("<u8").tobytes()).hexdigest()


def nearness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Likeness of two texts (words, sketch): of their sketches, or of all their shingles where either is empty."""
    if len(a[1]) and len(b[1]):
        return likeness(a[1], b[1])
    return likeness(*(np.unique(shingle_hashes(words, SHINGLE)) for words, _ in (a, b)))


def edited(text: str, following: str) -> str:
    """The last half replaced by as many first code points of the next text, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


SENT = StructType([StructField("doc_id", StringType()), StructField("range", IntegerType()), StructField("border", BooleanType()),
                   StructField("digest", StringType()), StructField("packed", BinaryType())])
PRINTS = StructType([StructField("doc_id", StringType()), StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
                     StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()),
                     StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())])


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): its fingerprint, that of its edited text, and likenesses."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_of("text").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).head().b
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(max(MAX_RANGES, tasks), max(1, -(-size // RANGE_BYTES), min(tasks, -(-size // LEAST_BYTES))))
    steps = [k / ranges for k in range(1, ranges)]
    cuts = np.unique(rows.approxQuantile("id", steps, max(1e-4, 0.1 / ranges)) if steps else []).astype(np.int64)

    def range_of(doc: str | None) -> int:
        """0 has the highest ids; null ids are in the last. Any cuts give right results."""
        return len(cuts) - (0 if doc is None else int(np.searchsorted(cuts, int(doc))))

    def tops(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows_of(batches):
            top: dict[int, int | None] = {}
            for doc in batch["id"]:
                r = range_of(doc)
                best = top.setdefault(r, None)
                if doc is not None and (best is None or int(doc) > best):
                    top[r] = int(doc)
            yield pd.DataFrame([(r, None if t is None else str(t)) for r, t in top.items()], columns=["range", "top"])

    ids = rows.select(F.col("id").cast("string").alias("id"))
    found = ids.mapInPandas(tops, "range int, top string").groupBy("range").agg(F.max(F.col("top").cast("long")).alias("top"))
    first = {r.range: r.top for r in found.collect()}  # one row a range
    order = sorted(first)
    before = {r: order[k - 1] for k, r in enumerate(order)}  # the first range's first document goes to the last range

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in rows_of(batches):
            out = []
            for doc, text in zip(batch["id"], batch["text"]):
                r, raw = range_of(doc), text.encode()
                row = (doc, r, False, hashlib.sha256(raw).hexdigest(), squeeze(raw))
                out.append(row)
                if (None if doc is None else int(doc)) == first[r]:
                    out.append((doc, before[r], True, *row[3:]))
            yield pd.DataFrame(out, columns=SENT.names)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expand = zstandard.ZstdDecompressor().decompress
        held: tuple | None = None  # the row whose successor comes next

        def pairs() -> Iterator[tuple[str | None, str, str]]:
            nonlocal held
            for batch in rows_of(batches):
                for doc, r, border, packed in zip(batch["doc_id"], batch["range"], batch["border"], batch["packed"]):
                    if held is not None and held[0] == r:
                        yield held[1], held[2], (text := expand(packed).decode())
                        held = None if border else (r, doc, text)
                    elif not border:
                        held = (r, doc, expand(packed).decode())

        waiting: list[tuple] = []
        size = 0
        for triple in pairs():
            waiting.append(triple)
            size += len(triple[1])
            if size > 1 << 22:
                yield described(waiting)
                waiting, size = [], 0
        if waiting:
            yield described(waiting)

    sent = rows.select(F.col("id").cast("string").alias("id"), "text").mapInPandas(send, SENT)
    ordered = sent.repartition(max(1, 2 * len(order)), "range").sortWithinPartitions(
        "range", "border", F.col("doc_id").cast("long").desc_nulls_last(), "digest")
    return ordered.mapInPandas(compare, PRINTS).withColumn("doc_id", F.col("doc_id").cast("long"))


def described(triples: list[tuple[str | None, str, str]]) -> pd.DataFrame:
    """The rows of (id, text, next text) triples."""
    changed = [edited(t, f) for _, t, f in triples]
    hashes = batch_word_hashes([t.encode() for _, t, _ in triples] + [c.encode() for c in changed]
                               + [f.encode() for _, _, f in triples])
    n = len(triples)
    out = []
    for k, (doc, text, _) in enumerate(triples):
        own, new, following = ((w := hashes[k + j * n], sketch(w)) for j in range(3))
        out.append((doc, len(text), hashlib.sha256(changed[k].encode()).hexdigest(), fingerprint(*own), fingerprint(*new),
                    nearness(own, new), nearness(own, following)))
    return pd.DataFrame(out, columns=PRINTS.names)
