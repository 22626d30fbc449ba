"""Vector bin packing of examples into sequences, by the dot-product heuristic.

Every piece has a size in three dimensions: tokens, segments (one) and loss-bearing
tokens. A sequence is filled by the piece with the largest dot product of its size with
the sequence's remaining capacity (both as shares of the capacity) among those that fit
in all dimensions; when none fits, the next sequence opens. Pieces of equal size are
alike, so a step looks at the distinct sizes only.

Documents are cut at multiples of the capacity; what is left over after the full pieces
fills the gaps. Pieces are packed in blocks of bounded length dealt out evenly, so no
task holds them all and only figures about pieces are shuffled, never ids.

Defined cases: a null or empty text is its closing id alone; repeated rows are packed
each; an empty table gives no pieces; an item that exceeds a capacity by itself raises
ValueError.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stray.llm.bpe import ChunkEncoder, tokenizer_path
from stray.llm.common import bounded_batches, materialise, rows_of, text_of

#: Pieces packed together by one task.
BLOCK = 16_384


@dataclass(frozen=True)
class Limits:
    """Capacities of one sequence."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048

    def as_array(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss_tokens], dtype=np.int64)


def pack(sizes: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin, place within the bin) for each row of `sizes` (items x dimensions)."""
    if len(sizes) and (sizes > capacity).any():
        raise ValueError("an item exceeds the capacity of a sequence")
    bins, places = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    full = (sizes == capacity).any(axis=1)  # such an item is the best for an empty sequence, and fills it
    alone = np.flatnonzero(full)
    bins[alone] = np.arange(len(alone))
    rest = np.flatnonzero(~full)
    kinds, kind_of = np.unique(sizes[rest], axis=0, return_inverse=True)
    kind_of = kind_of.ravel()
    items = rest[np.argsort(kind_of, kind="stable")]
    left = np.bincount(kind_of, minlength=len(kinds))
    following = np.cumsum(left) - left
    columns = np.ascontiguousarray(kinds.T)
    share = np.ascontiguousarray((kinds / capacity).T)
    room, current, place = capacity.copy(), len(alone), 0
    for _ in range(len(rest)):
        for fresh in (False, True):
            if fresh:
                room, current, place = capacity.copy(), current + 1, 0
            fits = left > 0
            for column, r in zip(columns, room):
                fits &= column <= r
            score = (room / capacity) @ share
            score[~fits] = -1.0
            k = int(score.argmax())
            if score[k] >= 0:
                break
        item = items[following[k]]
        bins[item], places[item] = current, place
        room = room - kinds[k]
        left[k] -= 1
        following[k] += 1
        place += 1
    return bins, places


#: Ids travel as text through pandas, which would turn a column with nulls into floats.
PIECES = StructType([StructField("doc_id", StringType())] + [
    StructField(c, LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "loss_tokens")])
PLACES = StructType([StructField(c, LongType()) for c in ("sequence_id", "offset")])


def cut_documents(docs: DataFrame, limits: Limits, path: str, ranks: str, closing_id: int = 1) -> DataFrame:
    """Pieces of every document of (doc_id, text): its ids and the closing id, cut at the capacity.

    The first id of a piece has no context in it and so bears no loss.
    """
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = ChunkEncoder(path, ranks)
        for batch in rows_of(batches):
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encoder.encode(text), np.uint32(closing_id)).astype("<u4")
                for at in range(0, len(ids), limits.tokens):
                    part = ids[at:at + limits.tokens]
                    out.append((doc, at, len(part), zlib.crc32(part.tobytes()), len(ids), len(part) - 1))
            yield pd.DataFrame(out, columns=PIECES.names)

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of("text").alias("text")).mapInPandas(cut, PIECES)


def pack_items(items: DataFrame, limits: Limits, tokens: str = "length", loss: str = "loss_tokens",
               block: int = BLOCK) -> DataFrame:
    """`items` with (sequence_id, offset). `items` should be a written table: blocks of at
    most about `block` rows are dealt evenly, the same way again if a task is repeated."""
    blocks = max(1, -(-items.count() // block))
    capacity = limits.as_array()
    schema = StructType(items.schema.fields + PLACES.fields)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(rows_of(batches))
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        size = np.stack([rows[tokens].to_numpy(np.int64), np.ones(len(rows), np.int64),
                         rows[loss].to_numpy(np.int64)], axis=1)
        bins, places = pack(size, capacity)
        order = np.lexsort((places, bins))
        before = np.cumsum(size[order, 0]) - size[order, 0]
        new = np.r_[True, np.diff(bins[order]) > 0]
        rows.loc[order, "offset"] = before - before[new][np.cumsum(new) - 1]
        rows["sequence_id"] = (np.int64(TaskContext.get().partitionId()) << 32) + bins
        rows["offset"] = rows["offset"].astype("int64")
        yield rows[schema.names]

    return items.repartition(blocks).mapInPandas(fill, schema)


def pack_documents(docs: DataFrame, limits: Limits = Limits(), path: str | None = None,
                   ranks: str | None = None) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    ranks = ranks or tokenizer_path("byte_bpe_50k.tiktoken")
    pieces = materialise(cut_documents(docs, limits, path, ranks), "pieces")
    return pack_items(pieces, limits).withColumn("doc_id", F.col("doc_id").cast("long"))
