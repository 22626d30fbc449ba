"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

Texts with the same words in the same order are one class and go on as one row. A
class's five-word shingles are weighted by count times idf, idf = 1 + ln(n / df), with
the exact df of every shingle; one that is in a single class matches nothing and weighs as
if it were in two. Shingles in more than a share `common` of all classes are found first:
hash-bucket sums leave few candidates, which are then counted one by one. There are at most
(shingles per class) / `common` of those, so their table is bounded. The others are dealt by
ranges of their hashes and counted there; each class gets those of its own that are in more
than two classes back. A `floor` above 0 takes shingles in a smaller share for as frequent.

Consistent weighted samples (Ioffe's scheme) agree between two classes with probability
equal to their weighted Jaccard similarity. Two samples make a band, and classes that
agree in two bands are candidates. In each bucket of candidates a few leaders are
compared with the rest, by exact weighted Jaccard; classes in a leader's group are done and
the rest get four times as many leaders in the next round, until all have led or are done.
Then classes of different groups in one bucket are compared, a few first, at last all.
So any two candidates are compared or are in one group already: no bucket is expanded into
rows of pairs, and none is capped. Links are closed to groups by min-label propagation.

Classes that buckets connect are a cluster, and a cluster goes through all these rounds in
one task, which cuts every text once; where it is too large for one, its rounds are tables
and it is dealt to lots, two of which meet in a task. A bound on the weight that two classes
share saves most exact comparisons of classes that are not near, and loses none that are.

Defined cases: a text that is null or has no words is a group of its own, kept; fewer
than five words are one shingle; repeated rows are copies; the kept row of a group is the
one with the least id, then the first such row; null ids come last; extra columns are
carried in one struct; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from stray.llm.common import (batch_word_hashes, bounded_batches, materialise, mixed, rows_of, shared_path,
                              shingle_hashes, squeezed, text_of)

SHINGLE = 5
SUMS = 1 << 16
LOW = np.uint64(0xFFFF)
#: Texts in bytes that are cut in words at once.
WORDS_BYTES = 1 << 20
#: Shingles sampled at once.
BLOCK = 1 << 14
#: Shingles of a unit of classes, and of a range of hashes, about.
UNIT = RANGE = 1 << 19
#: Shingles of the classes that one task compares by itself, at most, and cells that bound what two classes share.
LOCAL, CELLS = 1 << 21, 256


@dataclass(frozen=True)
class NearDup:
    similarity: float = 0.8
    bands: int = 10
    rows: int = 2
    floor: float = 0.0
    common: float = 0.05
    seed: int = 11


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, id, row, first, words, cls): cls is equal for texts of equal words; wordless texts have their own.
    `first` orders the rows of a class: least id, null ids last, then the first row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.col("doc_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                       squeezed(text_of(text)).alias("words"))
    own = F.concat(F.lit("row "), F.col("row").cast("string"))
    return rows.withColumns({"first": F.struct(F.col("id").isNull().alias("no_id"), "id", "row"),
                             "cls": F.when(F.col("words") == "", own).otherwise(F.md5("words"))})


def class_table(rows: DataFrame) -> DataFrame:
    """(cls, first, z): one row per class, as a table bucketed by class.

    z is the compressed text of the words. Rows of a class pre-aggregate, so a class that
    holds a third of all rows is no hot task.
    """

    @F.pandas_udf(BinaryType())
    def squeeze(words: pd.Series) -> pd.Series:
        compress = zstandard.ZstdCompressor(level=3).compress
        return words.map(lambda w: compress(w.encode()))

    picked = rows.select("cls", F.struct("first", squeeze("words").alias("z")).alias("m")).groupBy("cls").agg(
        F.min("m").alias("m")).select("cls", "m.first", "m.z")
    return bucketed(picked, "classes")


def bucketed(df: DataFrame, what: str) -> DataFrame:
    """`df` as a table bucketed by class in the shared folder."""
    spark = df.sparkSession
    name = f"stray_{what}_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.format("parquet").option("compression", "zstd").bucketBy(parts, "cls")
     .option("path", shared_path(spark, what)).saveAsTable(name))
    return spark.table(name)


def shingles_of(packed: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct shingle hashes, counts) of each compressed text; few texts are held as words or shingles at once."""
    expand = zstandard.ZstdDecompressor().decompress
    waiting: list[bytes] = []
    size = 0

    def hashed() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for h in batch_word_hashes(waiting):
            yield np.unique(shingle_hashes(h, SHINGLE), return_counts=True)
        waiting.clear()

    for z in packed:
        waiting.append(expand(z))
        size += len(waiting[-1])
        if size >= WORDS_BYTES:
            yield from hashed()
            size = 0
    yield from hashed()


def bucket_sums(classes: DataFrame) -> np.ndarray:
    """How many shingles of all classes (each once a class) lie in each of SUMS buckets of hashes."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SUMS, np.int64)
        for batch in rows_of(batches):
            for h, _ in shingles_of(batch["z"]):
                total += np.bincount((h >> np.uint64(48)).astype(np.int64), minlength=SUMS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at.astype(np.int32), "n": total[at]})

    got = classes.select("z").mapInPandas(sums, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toPandas()  # at most SUMS rows
    out = np.zeros(SUMS, np.int64)
    out[got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out


def common_shingles(classes: DataFrame, n: int, p: NearDup, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, document frequencies) of the shingles in more than max(2, common n, floor n) classes, sorted."""
    least = max(2.0, p.common * n, p.floor * n)
    full = np.flatnonzero(sums > least)
    if not len(full):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    marked = np.zeros(SUMS, bool)
    marked[full] = True

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows_of(batches):
            found = np.concatenate([h[marked[(h >> np.uint64(48)).astype(np.int64)]] for h, _ in shingles_of(batch["z"])])
            distinct, times = np.unique(found, return_counts=True)
            yield pd.DataFrame({"shingle": distinct.view(np.int64), "n": times.astype(np.int64)})

    df = classes.select("z").mapInPandas(candidates, "shingle long, n long").groupBy("shingle").agg(
        F.sum("n").alias("n")).where(F.col("n") > least).toPandas()
    order = np.argsort(df["shingle"].to_numpy().view(np.uint64))
    return df["shingle"].to_numpy().view(np.uint64)[order], df["n"].to_numpy()[order]


PARTS = "part int, unit long, h binary, who binary, cls array<string>"
COUNTED = "unit long, h binary, who binary, df binary, cls array<string>"


def runs_of(batches: Iterator[pd.DataFrame], key: str) -> Iterator[list]:
    """The rows of each value of `key`, by which the batches are in order."""
    rows: list = []
    for batch in rows_of(batches):
        for row in batch.itertuples(index=False):
            if rows and getattr(rows[0], key) != getattr(row, key):
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def own_frequencies(classes: DataFrame, common: np.ndarray, n: int, p: NearDup, total: int) -> DataFrame:
    """(cls, own): the class's shingles in more than max(2, floor n) classes that are not `common`, and their document
    frequencies, packed (`unpacked`), as a table bucketed by class. `total` is the number of shingles.

    A task cuts its classes in units and sends a unit's shingles, with the places of their classes in the unit, to
    ranges of hashes. A range is counted by one task, and holds few shingles as the common ones are not sent."""
    spark = classes.sparkSession
    least = max(2.0, p.floor * n)
    bits = max(0, (total // RANGE).bit_length())
    sent = spark.sparkContext.broadcast(common)  # bounded, see common_shingles

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, done = TaskContext.get().partitionId() << 32, 0
        cls: list[str] = []
        held: list[np.ndarray] = []

        def unit() -> pd.DataFrame:
            who = np.repeat(np.arange(len(held), dtype=np.int32), [len(h) for h in held])
            h = np.concatenate(held)
            order = np.argsort(h, kind="stable")
            h, who = h[order], who[order]
            part = (h >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(h), np.int32)
            at = np.flatnonzero(np.diff(part, prepend=-1))
            rows = [(int(part[i]), first + done, h[i:j].tobytes(), who[i:j].tobytes(), None)
                    for i, j in zip(at, [*at[1:], len(h)])]
            rows.append((done % (1 << bits), first + done, None, None, list(cls)))
            return pd.DataFrame(rows, columns=["part", "unit", "h", "who", "cls"])

        size = 0
        for batch in rows_of(batches):
            for name, (h, _) in zip(batch["cls"], shingles_of(batch["z"])):
                held.append(h[~np.isin(h, sent.value, assume_unique=True)] if len(sent.value) else h)
                cls.append(name)
                size += len(held[-1])
                if size >= UNIT or len(cls) >= UNIT:
                    yield unit()
                    done, size = done + 1, 0
                    cls.clear(), held.clear()
        if cls:
            yield unit()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in runs_of(batches, "part"):
            out = [(r.unit, None, None, None, r.cls) for r in rows if r.h is None]
            rows = [r for r in rows if r.h is not None]
            if rows:
                held = [np.frombuffer(r.h, np.uint64) for r in rows]
                _, at, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
                for r, h, df in zip(rows, held, np.split(times[at], np.cumsum([len(h) for h in held])[:-1])):
                    often = df > least
                    if often.any():
                        out.append((r.unit, h[often].tobytes(), np.frombuffer(r.who, np.int32)[often].tobytes(),
                                    df[often].astype(np.uint32).tobytes(), None))
            yield pd.DataFrame(out, columns=["unit", "h", "who", "df", "cls"])

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in runs_of(batches, "unit"):
            (cls,) = [r.cls for r in rows if r.cls is not None]
            h, who, df = (np.concatenate([np.zeros(0, kind), *(np.frombuffer(getattr(r, c), kind) for r in rows if r.h is not None)])
                          for c, kind in (("h", np.uint64), ("who", np.int32), ("df", np.uint32)))
            order = np.lexsort((h, who))
            h, df = h[order], df[order]
            ends = np.searchsorted(who[order], np.arange(len(cls) + 1))
            yield pd.DataFrame({"cls": cls, "own": [h[i:j].tobytes() + df[i:j].tobytes() for i, j in zip(ends, ends[1:])]})

    dealt = classes.select("cls", "z").mapInPandas(deal, PARTS).repartition("part").sortWithinPartitions("part")
    counted = dealt.mapInPandas(count, COUNTED).repartition("unit").sortWithinPartitions("unit")
    return bucketed(counted.mapInPandas(gather, "cls string, own binary").repartition("cls"), "frequencies")


def unpacked(own: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, document frequencies)"""
    k = len(own) // 12
    return np.frombuffer(own, np.uint64, k), np.frombuffer(own, np.uint32, k, 8 * k)


@dataclass
class Weights:
    """Weights of shingles by the table of the common ones, which is bounded, and the class's own (see `own_frequencies`)."""

    shingles: np.ndarray
    df: np.ndarray
    n: int
    floor: float

    def of(self, h: np.ndarray, times: np.ndarray, own: bytes = b"") -> np.ndarray:
        df = np.full(len(h), max(2.0, self.floor * self.n))
        for shingles, counts in ((self.shingles, self.df), unpacked(own)):
            if len(shingles) and len(h):
                at = np.minimum(np.searchsorted(shingles, h), len(shingles) - 1)
                df = np.where(shingles[at] == h, counts[at], df)
        return times * (1 + np.log(np.maximum(self.n / df, 1.0)))


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two (sorted distinct hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / max(a[1].sum() + b[1].sum() - both, 1e-300))


class Sampler:
    """Consistent weighted samples: for each shingle k and sample i, r and c are Gamma(2, 1) and b uniform,
    drawn from tables by the hash of (k, i); t = floor(ln w / r + b), a = c exp(-r (t - b + 1)); least a wins."""

    def __init__(self, p: NearDup) -> None:
        rng = np.random.default_rng(p.seed)
        size = 1 << 16
        self.r = rng.gamma(2.0, 1.0, size).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, size)).astype(np.float32)
        self.b = rng.random(size, dtype=np.float32)
        self.salts = mixed(np.arange(1, p.bands * p.rows + 1, dtype=np.uint64) + np.uint64(p.seed << 8))
        self.shape = (p.bands, p.rows)

    def bands(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        """One hash per band. Very long texts are sampled in blocks of shingles, the least kept."""
        n = len(self.salts)
        least, picks = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64)
        for at in range(0, len(h), BLOCK):
            part, log_w = h[at:at + BLOCK], np.log(w[at:at + BLOCK]).astype(np.float32)
            x = mixed(part[None, :] ^ self.salts[:, None])
            r, c, b = (table.take(((x >> shift) & LOW).view(np.int64)) for table, shift in zip(
                (self.r, self.log_c, self.b), np.array([0, 16, 32], np.uint64)))
            t = log_w / r
            t += b
            np.floor(t, out=t)
            a = t - b
            a += np.float32(1)
            a *= r
            np.subtract(c, a, out=a)
            k = a.argmin(axis=1)
            i = np.arange(n)
            better = a[i, k] < least
            found = part[k] * np.uint64(0x9E3779B97F4A7C15) + t[i, k].astype(np.int64).view(np.uint64)
            picks, least = np.where(better, found, picks), np.where(better, a[i, k], least)
        out = np.zeros(self.shape[0], np.uint64)
        for column in picks.reshape(self.shape).T:
            out = mixed(out * np.uint64(31) + column)
        return out + np.arange(self.shape[0], dtype=np.uint64)


SIGNED = StructType([StructField("cls", StringType()), StructField("bands", ArrayType(LongType())), StructField("size", LongType())])


def shared_by_two(rows: DataFrame, key: str, name: str) -> DataFrame:
    """The rows whose key occurs twice or more."""
    often = materialise(rows.groupBy(key).agg(F.count("*").alias("k")).where("k > 1").select(key), f"{name}-keys")
    return materialise(rows.join(often, key, "left_semi"), name)


def buckets(classes: DataFrame, weights: Weights, p: NearDup) -> tuple[DataFrame, DataFrame]:
    """(bucket, cls, rank): a bucket for each two bands that a class shares with others, of two classes or more; and
    (cls, size): how many shingles each class has. rank orders the classes evenly over [0, 1), alike in all buckets, so
    that buckets share their leaders."""
    sent = classes.sparkSession.sparkContext.broadcast(weights)  # bounded: the common shingles

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = Sampler(p)
        for batch in rows_of(batches):
            out = [(cls, sampler.bands(h, sent.value.of(h, times, own)).view(np.int64), len(h))
                   for cls, own, (h, times) in zip(batch["cls"], batch["own"], shingles_of(batch["z"])) if len(h)]
            yield pd.DataFrame(out, columns=SIGNED.names)

    signed = materialise(classes.select("cls", "z", "own").mapInPandas(sign, SIGNED), "signed")
    bands = shared_by_two(signed.select(F.explode("bands").alias("band"), "cls"), "band", "bands")
    held = bands.groupBy("cls").agg(F.sort_array(F.collect_list("band")).alias("b"))  # at most p.bands a class
    two = F.flatten(F.transform("b", lambda x, i: F.transform(
        F.slice("b", i + 2, F.size("b")), lambda y: F.xxhash64(x, y))))
    each = materialise(held.select("cls", F.explode(two).alias("bucket")), "pairs-of-bands")
    rank = F.xxhash64("cls").cast("double") / F.lit(2.0 ** 64) + 0.5
    return shared_by_two(each.select("bucket", "cls", rank.alias("rank")), "bucket", "buckets"), signed.select("cls", "size")


def components(links: DataFrame) -> DataFrame:
    """(cls, label): the least class of each connected group of `links` (a, b), by min-label
    propagation with pointer jumps; every step is a written table."""
    edges = materialise(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialise(edges.groupBy(F.col("a").alias("cls")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("cls")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("cls") == F.col("a")).select("cls", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("cls").alias("to"), F.col("label").alias("further"))
        new = materialise(step.join(jump, "to").select("cls", F.least("to", "further").alias("label"),
                                                       (F.least("to", "further") != F.col("label")).alias("moved")), "labels")
        labels = new.select("cls", "label")
        if new.where("moved").isEmpty():
            return labels


class Cluster:
    """Classes that one task compares, numbered by (rank, cls): a whole cluster in all rounds (`links`), or two lots of one
    in one round (`links_of`). Every text is cut once.

    A pair is compared exactly unless a bound rules it out: the shingles that several classes hold are dealt to CELLS
    cells, and what two classes have in common is at most the sum over the cells of the lesser of their two weights there."""

    def __init__(self, rows: list, weights: Weights, p: NearDup) -> None:
        rows = sorted(rows, key=lambda r: (r.rank, r.cls))
        self.p, self.m, self.rows, self.rank = p, len(rows), rows, np.array([r.rank for r in rows])
        self.bags = [(h, weights.of(h, times, r.own)) for r, (h, times) in zip(rows, shingles_of(pd.Series([r.z for r in rows])))]
        self.total = np.array([w.sum() for _, w in self.bags])
        _, code, held = np.unique(np.concatenate([h for h, _ in self.bags]), return_inverse=True, return_counts=True)
        several = held[code] > 1  # the others are in no two
        place = (np.cumsum(held > 1) - 1)[code[several]]
        who = np.repeat(np.arange(self.m), [len(h) for h, _ in self.bags])[several]
        w = np.concatenate([w for _, w in self.bags])[several]
        self.ends = np.searchsorted(who, np.arange(self.m + 1))
        self.place, self.w = place.astype(np.int32), w
        self.spread = np.zeros(int((held > 1).sum()))
        self.cells = np.bincount(who * CELLS + place % CELLS, w, self.m * CELLS).reshape(self.m, CELLS).astype(np.float32)
        self.label = np.arange(self.m)
        self.done: dict[int, np.ndarray] = {}
        self.wanted: dict[int, np.ndarray] = {}
        self.found: list[tuple[int, np.ndarray]] = []

    def want(self, i: int, others: np.ndarray) -> None:
        """Compare class i with `others`, which come after it."""
        if len(others):
            if i not in self.wanted:
                self.wanted[i] = np.zeros(self.m - i, bool)
            self.wanted[i][others - i] = True

    def near(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` with a weighted Jaccard of at least the similarity to class i."""
        t, out = self.p.similarity, []
        for at in range(0, len(others), BLOCK // 8):
            j = others[at:at + BLOCK // 8]
            least = (self.total[i] + self.total[j]) * t / (1 + t)  # that the two must have in common
            out.append(j[np.minimum(self.cells[j], self.cells[i]).sum(axis=1) >= least * (1 - 1e-4)])
        mine = slice(self.ends[i], self.ends[i + 1])
        self.spread[self.place[mine]] = self.w[mine]
        found = []
        for j in np.concatenate(out).tolist():
            his = slice(self.ends[j], self.ends[j + 1])
            both = np.minimum(self.spread[self.place[his]], self.w[his]).sum()
            sim = both / max(self.total[i] + self.total[j] - both, 1e-300)
            # As `verified` has it, where the order of a sum may decide.
            if sim >= t + 1e-9 or (sim > t - 1e-9 and weighted_jaccard(self.bags[j], self.bags[i]) >= t):
                found.append(j)
        self.spread[self.place[mine]] = 0.0
        return np.array(found, np.int64)

    def compare(self) -> None:
        """Compare the wanted pairs that have not been compared, and label the groups again."""
        for i, asked in self.wanted.items():
            done = self.done.get(i)
            fresh = np.flatnonzero(asked if done is None else asked & ~done) + i
            self.done[i] = asked if done is None else asked | done
            found = self.near(i, fresh) if len(fresh) else fresh
            if len(found):
                self.found.append((i, found))
                labels = np.unique(self.label[[i, *found]])
                if len(labels) > 1:
                    self.label[np.isin(self.label, labels)] = labels[0]
        self.wanted = {}

    def by_bucket(self, *columns: str) -> Iterator[list[np.ndarray]]:
        """For each bucket its classes in order, and what the rows say of them there."""
        held = [np.concatenate([getattr(r, c) for r in self.rows]) for c in ("buckets", *columns)]
        i = np.repeat(np.arange(self.m, dtype=np.int32), [len(r.buckets) for r in self.rows])
        order = np.lexsort((i, held[0]))
        cuts = np.flatnonzero(np.diff(held[0][order])) + 1
        return map(list, zip(*(np.split(x[order], cuts) for x in (i, *held[1:]))))

    def pairs(self) -> list[tuple[str, str]]:
        """(a, b) of the links found."""
        cls = [r.cls for r in self.rows]
        return [(min(cls[i], cls[j]), max(cls[i], cls[j])) for i, found in self.found for j in found.tolist()]

    def links(self) -> list[tuple[str, str]]:
        """Of a whole cluster: its rounds are those of `Rounds`."""
        # Buckets of the same classes ask for the same comparisons.
        self.buckets = list({b.tobytes(): b for (b,) in self.by_bucket()}.values())
        for b in self.buckets:
            self.want(int(b[0]), b[1:])
        self.compare()
        self.tie()
        self.join()
        return self.pairs()

    def links_of(self, left: set[str], right: set[str]) -> list[tuple[str, str]]:
        """Of the pairs that the rows ask for (see `links_in_tiles`), the first class in `left`, the second in `right`."""
        first, second = (np.array([r.cls in side for r in self.rows]) for side in (left, right))
        label = np.unique([r.label for r in self.rows], return_inverse=True)[1]
        for b, lead, many in self.by_bucket("lead", "many"):
            for at in np.flatnonzero(lead.astype(bool) & first[b]).tolist():
                rest = b[at + 1:]
                self.want(int(b[at]), rest[second[rest] & (label[rest] != label[b[at]]) & (many[at] | many[at + 1:].astype(bool))])
        self.compare()
        return self.pairs()

    def tie(self) -> None:
        waiting = [b[self.label[b] != self.label[b[0]]] for b in self.buckets]
        waiting, leaders = [b for b in waiting if len(b) > 1], 4
        while waiting:
            leads = [np.flatnonzero((np.arange(len(b)) == 0) | (self.rank[b] < leaders / len(b))) for b in waiting]
            for b, lead in zip(waiting, leads):
                for at in lead.tolist():
                    self.want(int(b[at]), b[at + 1:])
            self.compare()
            waiting = [b[~np.isin(self.label[b], self.label[b[lead]])] for b, lead in zip(waiting, leads)]
            waiting = [b for b in waiting if len(b) > 1]
            leaders *= 4

    def join(self) -> None:
        few = 8
        while True:
            most = 0
            for b in self.buckets:
                _, group, size = np.unique(self.label[b], return_inverse=True, return_counts=True)
                if len(size) == 1 or size.max() == 1:
                    continue
                most = max(most, int(size.max()))
                k, rank = size[group], self.rank[b]
                first = np.full(len(size), np.inf)
                np.minimum.at(first, group, rank)
                some = (rank <= first[group]) | (rank < few / k)
                b, group, k = b[some], group[some], k[some]
                for at in range(len(b)):
                    rest = slice(at + 1, None)
                    apart = group[rest] != group[at]
                    self.want(int(b[at]), b[rest][apart if k[at] > 1 else apart & (k[rest] > 1)])
            self.compare()
            if few >= most:
                return
            few *= 32


def clusters(shared: DataFrame) -> DataFrame:
    """(cls, cluster) of all classes of `shared`: those that buckets connect, by one after the other, are one cluster."""
    least = shared.groupBy("bucket").agg(F.min("cls").alias("a"))
    tied = materialise(shared.join(least, "bucket").where(F.col("a") != F.col("cls")).select("a", F.col("cls").alias("b")).distinct(), "tied")
    return components(tied).withColumnRenamed("label", "cluster")


def links_in_clusters(rows: DataFrame, weights: Weights, p: NearDup) -> DataFrame:
    """(a, b): the links of whole clusters, `rows` (cluster, cls, rank, buckets, z, own), each in one task."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)  # bounded: the common shingles
    return by_run(rows, "cluster", lambda members: Cluster(members, sent.value, p).links())


def by_run(rows: DataFrame, key: str, links: Callable[[list], list[tuple[str, str]]]) -> DataFrame:
    """(a, b): `links` of the rows of each value of `key`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple[str, str]] = []
        for members in runs_of(batches, key):
            found += links(members)
            if len(found) >= BLOCK:
                yield pd.DataFrame(found, columns=["a", "b"])
                found = []
        yield pd.DataFrame(found, columns=["a", "b"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # tasks by their work, which is not in their bytes
    return rows.repartition(parts, key).sortWithinPartitions(key).mapInPandas(run, "a string, b string")


def links_in_tiles(asked: DataFrame, of: DataFrame, classes: DataFrame, weights: Weights, p: NearDup) -> DataFrame:
    """(a, b): the links among the pairs that `asked` (bucket, cls, rank, label, lead, many) asks for: two classes of a
    bucket, of different labels, the first by (rank, cls) with `lead` and one of them with `many`.

    `of` (cls, cluster, lots) deals a cluster to lots by class. A task compares the leading classes of one lot with those
    of one lot, so a text is sent once or twice for each lot of its cluster, not once for each pair."""
    sent = asked.sparkSession.sparkContext.broadcast(weights)
    each = asked.groupBy("cls").agg(F.min("rank").alias("rank"), F.min("label").alias("label"), F.max("lead").alias("leads"),
                                    F.collect_list(F.struct("bucket", "lead", "many")).alias("asks"))
    texts = each.join(of, "cls").join(classes.select("cls", "z", "own"), "cls").select(
        "cluster", "cls", "rank", "label", "leads", "z", "own", F.col("asks.bucket").alias("buckets"), "asks.lead", "asks.many",
        F.pmod(F.xxhash64("cls"), "lots").cast("int").alias("lot"), F.sequence(F.lit(0), F.col("lots") - 1).alias("all"))
    left = texts.where("leads").withColumn("left", F.lit(True)).withColumn("other", F.explode("all")).withColumn(
        "tile", F.concat_ws("/", "cluster", "lot", "other"))
    right = texts.withColumn("left", F.lit(False)).withColumn("other", F.explode("all")).withColumn(
        "tile", F.concat_ws("/", "cluster", "other", "lot"))
    columns = ["tile", "left", "cls", "rank", "label", "buckets", "lead", "many", "z", "own"]

    def link(rows: list) -> list[tuple[str, str]]:
        first, second = ({r.cls for r in rows if r.left == side} for side in (True, False))
        return Cluster(list({r.cls: r for r in rows}.values()), sent.value, p).links_of(first, second) if first and second else []

    return by_run(left.select(columns).union(right.select(columns)), "tile", link)


class Rounds:
    """Comparisons of clusters that are too large for one task: each round is a table."""

    def __init__(self, of: DataFrame, classes: DataFrame, weights: Weights, p: NearDup) -> None:
        self.of, self.classes, self.weights, self.p = of, classes, weights, p
        self.found: DataFrame | None = None

    def compare(self, asked: DataFrame) -> None:
        """Find the links of `asked`, see `links_in_tiles`; pairs may be asked for in several rounds."""
        new = materialise(links_in_tiles(asked, self.of, self.classes, self.weights, self.p), "linked")
        self.found = new if self.found is None else materialise(self.found.union(new).distinct(), "linked")

    def marked(self, rows: DataFrame) -> DataFrame:
        """`rows` (.., cls) with the group (label) that the links so far give each class."""
        labels = components(self.found)
        return rows.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))

    def links(self, shared: DataFrame) -> DataFrame:
        """(a, b) of the classes of `shared` (bucket, cls, rank)."""
        self.meet(shared)
        self.tie(shared)
        self.join(shared)
        return self.found

    def meet(self, shared: DataFrame) -> None:
        """Compare each bucket with its class of least rank."""
        first = materialise(shared.groupBy("bucket").agg(F.min(F.struct("rank", "cls")).alias("first")), "first")
        self.compare(self.leading(shared.join(first, "bucket"), F.col("cls") == F.col("first.cls")))

    def tie(self, shared: DataFrame) -> None:
        """Compare more leaders with their buckets until every class of a bucket has led or is in a leader's group."""
        marked = materialise(self.marked(shared), "marked")
        own = materialise(marked.groupBy("bucket").agg(F.min_by("label", F.struct("rank", "cls")).alias("led")), "led")
        rest = materialise(marked.join(own, "bucket").where(F.col("label") != F.col("led")).select(shared.columns), "rest")
        waiting, leaders = shared_by_two(rest, "bucket", "waiting"), 4
        while not waiting.isEmpty():
            # About `leaders` classes of each bucket lead: those of least rank, and always the first.
            sizes = materialise(waiting.groupBy("bucket").agg(
                F.count("*").alias("k"), F.min(F.struct("rank", "cls")).alias("first")), "sizes")
            leads = (F.col("cls") == F.col("first.cls")) | (F.col("rank") < leaders / F.col("k"))
            asked = materialise(self.leading(waiting.join(sizes, "bucket"), leads), "asked")
            self.compare(asked)
            marked = materialise(self.marked(asked.drop("label")), "marked")
            led = marked.where("lead").select("bucket", "label").distinct()
            rest = materialise(marked.join(led, ["bucket", "label"], "left_anti").select(shared.columns), "rest")
            waiting = rest if rest.isEmpty() else shared_by_two(rest, "bucket", "waiting")
            leaders *= 4

    @staticmethod
    def leading(rows: DataFrame, leads: Column) -> DataFrame:
        """`rows`, in which some lead and are to be compared with all after them, whatever their groups."""
        return rows.select("bucket", "cls", "rank", F.col("cls").alias("label"), leads.alias("lead"), F.lit(True).alias("many"))

    def join(self, shared: DataFrame) -> None:
        """Compare classes of different groups that share a bucket: two in the groups of different leaders, or one
        in a group and one leader. First a few of each group, then more, at last all, so that groups that belong
        together meet early and only groups that stay apart are compared in full."""
        few = 8
        while True:
            marked = materialise(self.marked(shared), "marked")
            groups = materialise(marked.groupBy("bucket", "label").agg(F.count("*").alias("k"), F.min("rank").alias("first")), "groups")
            # Classes that are alone in their buckets have led, and so have met all the others that are.
            several = materialise(groups.groupBy("bucket").agg(F.count("*").alias("n"), F.max("k").alias("most")).where(
                "n > 1 and most > 1"), "several")
            most = several.agg(F.max("most").alias("m")).head().m
            if most is None:
                return
            some = marked.join(groups.join(several.select("bucket"), "bucket", "left_semi"), ["bucket", "label"]).where(
                (F.col("rank") <= F.col("first")) | (F.col("rank") < few / F.col("k")))
            self.compare(materialise(some.select("bucket", "cls", "rank", "label", F.lit(True).alias("lead"), F.expr("k > 1").alias("many")), "some"))
            if few >= most:
                return
            few *= 32


def links_between(classes: DataFrame, weights: Weights, p: NearDup) -> DataFrame:
    """(a, b): verified links. Any two classes that share a bucket were compared or are in one group by others, unless
    bounds say that they are not near.

    Clusters of at most LOCAL shingles, a class counted as CELLS or more, are compared in one task each (`Cluster`); larger
    ones in rounds over all tasks (`Rounds`), in lots of half as many. Both compare the same pairs."""
    shared, sizes = buckets(classes, weights, p)
    if shared.isEmpty():
        return shared.select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    of = clusters(shared)
    whole = materialise(of.join(sizes, "cls").groupBy("cluster").agg(
        F.ceil(F.sum(F.greatest("size", F.lit(CELLS))) / (LOCAL / 2)).cast("int").alias("lots")), "cluster-lots")
    held = shared.groupBy("cls").agg(F.min("rank").alias("rank"), F.collect_list("bucket").alias("buckets"))
    small = of.join(whole.where("lots <= 2").select("cluster"), "cluster", "left_semi")
    links = links_in_clusters(held.join(small, "cls").join(classes.select("cls", "z", "own"), "cls").select(
        "cluster", "cls", "rank", "buckets", "z", "own"), weights, p)
    large = materialise(of.join(whole.where("lots > 2"), "cluster").select("cls", "cluster", "lots"), "large")
    if large.isEmpty():
        return links
    rest = materialise(shared.join(large.select("cls"), "cls", "left_semi").select(shared.columns), "large-buckets")
    return links.union(Rounds(large, classes, weights, p).links(rest))


def verdicts(rows: DataFrame, p: NearDup) -> DataFrame:
    """(row, id, group_id, n_links, kept) for each of the keyed rows."""
    bounded_batches(rows.sparkSession)
    classes = class_table(rows)
    n = classes.count()
    sums = bucket_sums(classes)
    weights = Weights(*common_shingles(classes, n, p, sums), n, p.floor)
    weighed = classes.join(own_frequencies(classes, weights.shingles, n, p, int(sums.sum())), "cls")
    links = materialise(links_between(weighed, weights, p), "links")
    counted = links.select(F.col("a").alias("cls")).union(links.select("b")).groupBy("cls").agg(F.count("*").alias("links"))
    grouped = materialise(components(links).join(counted, "cls"), "groups")
    best = materialise(grouped.join(classes.select("cls", "first"), "cls").groupBy("label").agg(F.min("first").alias("best")), "best")
    of_class = materialise(classes.select("cls", "first").join(
        grouped.join(best, "label").select("cls", "best", "links"), "cls", "left").select(
        F.col("cls").alias("c"), F.coalesce("best", "first").alias("best"), F.coalesce("links", F.lit(0)).alias("links")), "of-class")
    return rows.select("cls", "id", "row").join(of_class, F.col("cls") == F.col("c")).select(
        "row", "id", F.col("best.id").alias("group_id"), F.col("links").cast("long").alias("n_links"),
        (F.col("row") == F.col("best.row")).alias("kept"))


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """One row per row of `docs` (doc_id, text): its group (the id of the group's kept row), the number of
    verified links of its class, and whether it is the kept row."""
    return verdicts(keyed(docs.select("doc_id", "text")), p).select(
        F.col("id").alias("doc_id"), "group_id", "n_links", "kept")


def near_dup_stage(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """One row of each group, unchanged."""
    rows = keyed(docs)
    gone = materialise(verdicts(rows, p).where(~F.col("kept")).select(F.col("row").alias("r")), "gone")
    return rows.join(gone, F.col("row") == F.col("r"), "left_anti").select(
        *[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
