"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts.

A line's key is the line without white space at both ends, A-Z lower-cased. A `LineStore`
holds four tables in the shared folder: the documents it knows, the references (key,
document), the exact reference count of each key with the last document that holds it,
and one cuckoo filter for each shard of keys, with the fingerprints of the keys that have
enough references to be dropped. Inserting documents adds references and counts and puts
the keys that reach the limit into their filters; deleting documents takes the same away
again, and a cuckoo filter, unlike a Bloom filter, can forget a key. So a store after
deletion equals one that never had the documents.

Reading goes through the filters: every reference meets the filter of its shard, and only
those it lets through are joined with the exact counts, so false positives never count.
References are dealt by shard and by a lot of the document, so a line that a third of all
documents hold is spread over `lots` tasks; counts pre-aggregate. A filter has a fixed
size, and the number of shards follows the number of keys in the filters. If a filter is
full, further keys stand in its stash, so it never loses one.

Defined cases: a null or empty text is one empty line; rows of one id are one document,
also the null id, which is the smallest; repeated lines of a document are one reference,
and all of them go or stay; a document inserted again is ignored; an unknown document
deleted changes nothing; an empty table gives no rows; other columns of the documents
are never read by `digests`, and `dedupe` returns them unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stray.llm.common import SPACES, bounded_batches, materialise

BLANKS = SPACES.encode()
SLOTS = 4
#: Buckets of a filter (a power of two) and the keys for which it is meant.
BUCKETS = 1 << 13
SHARD_KEYS = BUCKETS * SLOTS // 2
KICKS = 200


@dataclass(frozen=True)
class LineRules:
    """Keys of at least `min_chars` code points in at least `min_docs` documents are dropped
    from all but the last document; references of a shard are dealt to `lots` lots."""

    min_chars: int = 20
    min_docs: int = 3
    lots: int = 32


class CuckooFilter:
    """Two candidate buckets of four 16-bit fingerprints for each 128-bit key; what finds no place is in the stash."""

    def __init__(self, cells: bytes | None = None, stash: list[bytes] | None = None) -> None:
        self.cells = np.frombuffer(cells, "<u2").tolist() if cells else [0] * (BUCKETS * SLOTS)
        self.stash = list(stash or [])

    @staticmethod
    def places(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of each key."""
        halves = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        print_ = (halves[:, 1] & np.uint64(0xFFFF)).astype(np.int64)
        print_[print_ == 0] = 1
        one = ((halves[:, 1] >> np.uint64(16)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        return print_, one, one ^ CuckooFilter.jump(print_)

    @staticmethod
    def jump(print_):
        return (print_ * 0x5BD1E995 >> 7) & (BUCKETS - 1)

    def insert(self, keys: list[bytes]) -> None:
        if not keys:
            return
        for key, f, a, b in zip(keys, *(x.tolist() for x in self.places(keys))):
            if not (self.put(f, a) or self.put(f, b) or self.kick(f, a)):
                self.stash.append(key)

    def put(self, f: int, bucket: int) -> bool:
        for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.cells[i]:
                self.cells[i] = f
                return True
        return False

    def kick(self, f: int, bucket: int) -> bool:
        """Move others to their second buckets until all have a place; undone if that fails."""
        moved = []
        for step in range(KICKS):
            at = bucket * SLOTS + step % SLOTS
            moved.append((at, self.cells[at]))
            f, self.cells[at] = self.cells[at], f
            bucket ^= self.jump(f)
            if self.put(f, bucket):
                return True
        for at, was in reversed(moved):
            self.cells[at] = was
        return False

    def delete(self, keys: list[bytes]) -> None:
        """Take out keys that are in; the exact counts guarantee that they are."""
        if not keys:
            return
        for key, f, a, b in zip(keys, *(x.tolist() for x in self.places(keys))):
            if key in self.stash:
                self.stash.remove(key)
                continue
            for i in (*range(a * SLOTS, a * SLOTS + SLOTS), *range(b * SLOTS, b * SLOTS + SLOTS)):
                if self.cells[i] == f:
                    self.cells[i] = 0
                    break

    def holds(self, keys: list[bytes]) -> np.ndarray:
        """True for every key that is in, and for few others."""
        if not keys:
            return np.zeros(0, bool)
        cells = np.array(self.cells, np.int64).reshape(-1, SLOTS)
        print_, one, two = self.places(keys)
        found = (cells[one] == print_[:, None]).any(1) | (cells[two] == print_[:, None]).any(1)
        if self.stash:
            stash = set(self.stash)
            found |= np.fromiter((k in stash for k in keys), bool, len(keys))
        return found

    def row(self) -> tuple[bytes, list[bytes]]:
        return np.array(self.cells, "<u2").tobytes(), self.stash


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """Digest of the key of each line, null for keys too short."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(BLANKS)
        size = len(key)
        if size < min_chars or size < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
            out.append(None)
        else:
            out.append(hashlib.blake2b(key.lower(), digest_size=16).digest())  # bytes: A-Z only
    return out


def bytes_of(text: str) -> Column:
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def line_references(docs: DataFrame, rules: LineRules, doc_id: str, text: str) -> DataFrame:
    """(key, doc): the long keys of every row, each once a row."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("doc", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for i, t in enumerate(batch.column("t").to_pylist()):
                own = {k for k in line_keys(t, rules.min_chars) if k is not None}
                keys += own
                rows += [i] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("doc").take(pa.array(rows, pa.int64()))],
                                             ["key", "doc"])

    return docs.select(F.col(doc_id).alias("doc"), bytes_of(text).alias("t")).mapInArrow(run, schema)


def counted(refs: DataFrame) -> DataFrame:
    """(key, n, last): documents of each key. Two steps, so that rows of a document are one."""
    return refs.distinct().groupBy("key").agg(F.count("*").alias("n"), F.max("doc").alias("last"))


FILTER = "shard long, cells binary, stash array<binary>"


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards))


def filters_of(keys: DataFrame, shards: int, filters: DataFrame | None = None) -> DataFrame:
    """The filters (shard, cells, stash) after the changes in `keys` (key, up): in where up, out where not."""
    schema = pa.schema([("shard", pa.int64()), ("cells", pa.binary()), ("stash", pa.list_(pa.binary()))])

    def changed(old: pa.Table, new: pa.Table) -> pa.Table:
        """One shard: at most one row of the old filters, and its changed keys, of which there are few by the shards' size."""
        row = (old.to_pylist() or [{"cells": None, "stash": None}])[0]
        shard = row["shard"] if old.num_rows else new.column("shard")[0].as_py()
        f, rows = CuckooFilter(row["cells"], row["stash"]), new.select(["key", "up"]).to_pylist()
        f.delete(sorted(r["key"] for r in rows if not r["up"]))
        f.insert(sorted(r["key"] for r in rows if r["up"]))
        return pa.Table.from_pylist([dict(zip(schema.names, (shard, *f.row())))], schema)

    dealt = keys.select(shard_of(shards).alias("shard"), "key", "up")
    if filters is None:
        filters = keys.sparkSession.createDataFrame([], FILTER)
    return filters.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(changed, FILTER)


def let_through(refs: DataFrame, filters: DataFrame, shards: int, lots: int) -> DataFrame:
    """The references whose shard's filter holds their key. The filters are copied to all lots of
    their shard and come first in each slot, so a task holds one filter at a time."""
    kind = refs.schema["doc"].dataType
    slot = lambda lot: (F.col("shard") * lots + lot).alias("slot")
    own = refs.withColumn("shard", shard_of(shards)).select(
        slot(F.pmod(F.xxhash64("doc", F.lit(0)), F.lit(lots))), F.lit(1).alias("turn"), "key", "doc",
        F.lit(None).cast("binary").alias("cells"), F.lit(None).cast("array<binary>").alias("stash"))
    lot = F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))
    sent = filters.select("*", lot.alias("lot")).select(
        slot(F.col("lot")), F.lit(0).alias("turn"), F.lit(None).cast("binary").alias("key"),
        F.lit(None).cast(kind).alias("doc"), "cells", "stash")
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("doc", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, CuckooFilter()
        for batch in batches:
            slots = batch.column("slot").to_numpy()
            first = batch.column("turn").to_numpy() == 0
            cut = np.flatnonzero(np.r_[True, (slots[1:] != slots[:-1]) | first[1:] | first[:-1]]) if len(slots) else []
            for i, j in zip(cut, [*cut[1:], len(slots)]):
                if first[i]:
                    at, held = slots[i], CuckooFilter(batch.column("cells")[i].as_py(), batch.column("stash")[i].as_py())
                    continue
                if slots[i] != at:  # no key of this shard is dropped
                    at, held = slots[i], None
                if held is None:
                    continue
                part = batch.slice(i, j - i).select(["key", "doc"])
                yield part.filter(pa.array(held.holds(part.column("key").to_pylist())))

    return (own.unionByName(sent).repartition("slot").sortWithinPartitions("slot", "turn")
            .mapInArrow(run, schema))


@dataclass(frozen=True)
class LineStore:
    """A version of the store; inserting and deleting return the next one."""

    spark: SparkSession
    rules: LineRules
    shards: int
    members: DataFrame | None  # doc
    refs: DataFrame | None     # key, doc
    counts: DataFrame | None   # key, n, last
    filters: DataFrame | None  # shard, cells, stash

    @staticmethod
    def empty(spark: SparkSession, rules: LineRules = LineRules()) -> LineStore:
        return LineStore(spark, rules, 1, None, None, None, None)

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineStore:
        """With the lines of all documents that are not in yet."""
        new = line_references(docs, self.rules, doc_id, text)
        ids = docs.select(F.col(doc_id).alias("doc")).distinct()
        if self.members is not None:
            known = self.members.select(F.col("doc").alias("_known"))
            new = new.join(known, F.col("doc").eqNullSafe(F.col("_known")), "left_anti")
            ids = self.members.unionByName(ids).distinct()
        new = materialise(new, "line-refs")
        members = materialise(ids, "line-docs")
        fresh = counted(new)
        if self.counts is None:
            counts = materialise(fresh.select("*", F.lit(0).cast("long").alias("was")), "line-counts")
            return replace(self, members=members, refs=new, counts=counts.drop("was"))._filtered(counts)
        both = (self.counts.select("*", F.col("n").alias("was"))
                .unionByName(fresh.select("*", F.lit(0).cast("long").alias("was"))))
        counts = materialise(both.groupBy("key").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.sum("was").alias("was")),
                             "line-counts")
        refs = materialise(self.refs.unionByName(new), "line-refs")
        return replace(self, members=members, refs=refs, counts=counts.drop("was"))._filtered(counts)

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> LineStore:
        """Without the documents of these ids; counts and last documents of their keys are taken anew."""
        if self.members is None:
            return self
        gone = ids.select(F.col(doc_id).alias("_gone")).distinct()
        same = F.col("doc").eqNullSafe(F.col("_gone"))
        touched = materialise(self.refs.join(gone, same, "left_semi").select("key").distinct(), "line-touched")
        refs = materialise(self.refs.join(gone, same, "left_anti"), "line-refs")
        members = materialise(self.members.join(gone, same, "left_anti"), "line-docs")
        left = counted(refs.join(touched, "key", "left_semi"))
        now = (self.counts.join(touched, "key", "left_semi").select("key", F.col("n").alias("was"))
               .join(left, "key", "left").select("key", F.coalesce("n", F.lit(0)).alias("n"), "last", "was"))
        rest = self.counts.join(touched, "key", "left_anti").select("*", F.col("n").alias("was"))
        counts = materialise(rest.unionByName(now), "line-counts")
        return replace(self, members=members, refs=refs, counts=counts.where("n > 0").drop("was"))._filtered(counts)

    def _filtered(self, counts: DataFrame) -> LineStore:
        """The filters follow the counts (n, was): keys that crossed the limit go in or out. Where the
        filters become too full there are twice as many, filled anew."""
        least = self.rules.min_docs
        total = counts.where(F.col("n") >= least).count()
        shards = self.shards
        while total > shards * SHARD_KEYS:
            shards *= 2
        if shards != self.shards or self.filters is None:
            keys, old = counts.where(F.col("n") >= least).select("key", F.lit(True).alias("up")), None
        else:
            crossed = counts.where((F.col("n") >= least) != (F.col("was") >= least))
            keys, old = crossed.select("key", (F.col("n") >= least).alias("up")), self.filters
        return replace(self, shards=shards, filters=materialise(filters_of(keys, shards, old), "line-filters"))

    def dropped(self) -> DataFrame:
        """(doc, gone): the keys that each document loses."""
        if self.refs is None:
            raise ValueError("the store is empty")
        maybe = let_through(self.refs, self.filters, self.shards, self.rules.lots)
        exact = self.counts.where(F.col("n") >= self.rules.min_docs).select("key", "last")
        lost = maybe.join(exact, "key").where(~F.col("doc").eqNullSafe(F.col("last")))
        return lost.groupBy("doc").agg(F.collect_set("key").alias("gone"))

    def _joined(self, docs: DataFrame, doc_id: str, *columns: Column) -> DataFrame:
        gone = materialise(self.dropped(), "line-gone").withColumnRenamed("doc", "_doc")
        # a shuffle join at every size: what a document loses has no bound over all documents
        own = docs.select(F.col(doc_id).alias("_id"), *columns).hint("merge")
        return own.join(gone, F.col("_id").eqNullSafe(F.col("_doc")), "left").drop("_doc")

    def digests(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, n_lines, n_dropped, kept_sha256) for each row."""
        kind = docs.schema[doc_id].dataType
        schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n_lines", T.LongType()),
                               T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())])
        rules = self.rules

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [kept_lines(t, gone, rules.min_chars) for t, gone in
                        zip(batch.column("_t").to_pylist(), batch.column("gone").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), pa.array([n for _, n, _ in rows], pa.int64()), pa.array([k for _, _, k in rows], pa.int64()),
                     pa.array([hashlib.sha256(t).hexdigest() for t, _, _ in rows], pa.string())], schema.names)

        return self._joined(docs, doc_id, bytes_of(text).alias("_t")).mapInArrow(run, schema)

    def dedupe(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """The documents without the lines they lose; all other columns as they are."""
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
        rules = self.rules

        @F.pandas_udf("string")
        def kept(t, gone):
            return t.combine(gone, lambda a, g: kept_lines(a, g, rules.min_chars)[0].decode("utf-8", "replace"))

        out = self._joined(docs, doc_id, bytes_of(text).alias("_t"), whole)
        return out.select(*[kept("_t", "gone").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def kept_lines(text: bytes, gone, min_chars: int) -> tuple[bytes, int, int]:
    """The text without the lines of the keys in `gone`, its lines before, and the lines dropped."""
    total = text.count(b"\n") + 1
    if gone is None or not len(gone):
        return text, total, 0
    lost = set(gone)
    kept = [line for line, key in zip(text.split(b"\n"), line_keys(text, min_chars)) if key not in lost]
    return b"\n".join(kept), total, total - len(kept)


def line_dedup_query(docs: DataFrame) -> DataFrame:
    """Digest of every document after dedup, through a store of all documents."""
    own = docs.select("doc_id", "text")
    return LineStore.empty(docs.sparkSession).insert(own).digests(own)


LINE_DEDUP_SQL = """
WITH parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
lines AS (
  SELECT doc_id, unnest(p) AS line, generate_subscripts(p, 1) AS i FROM parts),
keyed AS (
  SELECT doc_id, line, i, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.line, k.i, (o.key IS NOT NULL AND k.doc_id <> o.last) AS gone
  FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
