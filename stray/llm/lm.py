"""Deleted interpolation: a bigram model mixed by context-frequency buckets.

Recursive interpolation of maximum-likelihood estimates:

    p1(w)    = (1 - e) c(w) / N + e / (V + 1)
    p(w | h) = l(h) p2(w | h) + (1 - l(h)) p1(w)

All counts are exact and cover every training token: of each word, and of each pair of a
word and the one before it. Weights come from deleted (held-out) counts: training
documents fall in two folds, the estimates of each are mixed to fit the counts of the
other, in both directions, by expectation-maximisation: e over all words, l(h) for each
bucket floor(log2 c(h)) of the true count of h. The weight of a bucket depends on a pair
by p2 / p1 only, so the pairs are summed in bins of 1/64 octave of it, each bin at its
mean.

Word counts are one shuffle of (word, count) pre-aggregated in each batch. The
`frequent` most frequent words (a bounded table) are looked up where the text is read;
only the rest, a few in a hundred tokens, travel to their counts, as (word, row, times).
No word of that rest can be hot: each is rarer than all `frequent` words. Pairs go the
same way: one shuffle of pre-aggregated counts, the `pairs` most frequent looked up where
the text is read, the rest of each text joined as (pair, row, times). Words are known by
64-bit hashes, pairs by both words.

With `classes` set, contexts and outcomes are the `classes - 1` most frequent words and
one class for all others, within which p1 divides the mass: a smaller model, not the one
that the query uses.

Defined cases: a null or empty text is its end token; a null id counts as the text '';
repeated rows are counted and scored each; without training documents all counts are 0
and the model is uniform; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from stray.llm.common import bounded_batches, least_count, materialise, rows_of, text_of, word_hashes

#: The end token: white space, so no word is equal to it.
END = b"\n"


@dataclass(frozen=True)
class Shape:
    """classes: outcomes of the bigram level, None for all words; frequent, pairs: words and pairs looked up
    where the text is read."""

    classes: int | None = None
    frequent: int = 1 << 19
    pairs: int = 1 << 19
    em_steps: int = 30


def folded(docs: DataFrame) -> DataFrame:
    """(doc_id as text, text, fold): fold -1 is held out; 0 and 1 are the training folds."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of("text").alias("text"),
                       F.when(crc % 7 == 2, -1).otherwise((F.floor(crc / 7) % 2).cast("int")).alias("fold"))


def tokens(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens of a batch, number of tokens of each text); A-Z lower-cased, an end token each."""
    flat: list[bytes] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        words = t.encode().lower().split()
        flat += words
        flat.append(END)
        sizes[i] = len(words) + 1
    return word_hashes(flat).view(np.int64), sizes


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, a, b): counts in the two training folds."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows_of(batches):
            words, sizes = tokens(batch["text"])
            fold = np.repeat(batch["fold"].to_numpy(), sizes)
            distinct, code = np.unique(words, return_inverse=True)
            a, b = (np.bincount(code, fold == k, len(distinct)).astype(np.int64) for k in (0, 1))
            yield pd.DataFrame({"word": distinct, "a": a, "b": b})

    return rows.where("fold >= 0").mapInPandas(count, "word long, a long, b long").groupBy("word").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"))


def at_most(counts: DataFrame, limit: int) -> pd.DataFrame:
    """(word, c) of the most frequent words, sorted by word; words of equal count are in or out together."""
    both = counts.select("word", (F.col("a") + F.col("b")).alias("c"))
    least = least_count(both, limit)
    if least is None:
        return pd.DataFrame({"word": np.zeros(0, np.int64), "c": np.zeros(0, np.int64)})
    return both.where(F.col("c") >= least).toPandas().sort_values("word", ignore_index=True)


def places(words: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Where each word stands in the sorted array `among`, or -1."""
    if not len(among):
        return np.full(len(words), -1, np.int64)
    at = np.minimum(np.searchsorted(among, words), len(among) - 1)
    return np.where(among[at] == words, at, -1)


def classes_of(words: np.ndarray, named: np.ndarray) -> np.ndarray:
    """The class of each word: its place among the named ones, or the class of all others."""
    at = places(words, named)
    return np.where(at < 0, len(named), at)


def contexts(classes: np.ndarray, sizes: np.ndarray, end_class: int) -> np.ndarray:
    """The class before each token; before the first of a text stands the end token."""
    before = np.r_[end_class, classes[:-1]]
    before[np.cumsum(sizes) - sizes] = end_class
    return before


def pair_counts(rows: DataFrame, named: np.ndarray) -> np.ndarray:
    """Counts [fold, context, outcome] of the bigram level: a fixed (classes x classes) table."""
    k = len(named) + 1
    end_class = int(classes_of(word_hashes([END]).view(np.int64), named)[0])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(2 * k * k, np.int32)
        for batch in rows_of(batches):
            words, sizes = tokens(batch["text"])
            c = classes_of(words, named)
            cell = (np.repeat(batch["fold"].to_numpy(), sizes) * k + contexts(c, sizes, end_class)) * k + c
            distinct, times = np.unique(cell, return_counts=True)
            seen[distinct] += times.astype(np.int32)
        cells = np.flatnonzero(seen)
        for at in range(0, len(cells), 1 << 17):
            part = cells[at:at + (1 << 17)]
            yield pd.DataFrame({"cell": part.astype(np.int32), "n": seen[part]})

    found = rows.where("fold >= 0").mapInPandas(count, "cell int, n int").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(2 * k * k, np.int64)
    table[found["cell"].to_numpy()] = found["n"].to_numpy()
    return table.reshape(2, k, k)


def em(mass: np.ndarray, p_high: np.ndarray, p_low: np.ndarray, group: np.ndarray, groups: int, steps: int) -> np.ndarray:
    """For each group the weight of `p_high` that fits the held-out `mass` best."""
    weight = np.full(groups, 0.5)
    total = np.bincount(group, mass, groups)
    for _ in range(steps):
        high = weight[group] * p_high
        share = high / np.maximum(high + (1 - weight[group]) * p_low, 1e-300)
        weight = np.where(total > 0, np.bincount(group, mass * share, groups) / np.maximum(total, 1e-300), weight)
    return weight


@dataclass
class Model:
    """The bounded part of the model: all but the counts of rare words."""

    words: np.ndarray       # the frequent words, sorted
    counts: np.ndarray      # their counts
    named: np.ndarray       # the words with a class of their own, sorted
    n: int                  # training tokens
    v: int                  # distinct training tokens
    e: float                # weight of the uniform part
    bigram: np.ndarray      # l(h) p2 [context, class]; of the last class per unit of its p1
    keep: np.ndarray        # 1 - l(h)

    def base(self, c):
        return np.log10((c + 1) / (self.n + 1 * (self.v + 1)))

    def p1(self, c):
        return (1 - self.e) * c / max(self.n, 1) + self.e / (self.v + 1)


def buckets(of_context: np.ndarray) -> np.ndarray:
    return np.where(of_context > 0, 1 + np.floor(np.log2(np.maximum(of_context, 1))), 0).astype(np.int64)


def learn(rows: DataFrame, counts: DataFrame, shape: Shape) -> Model:
    totals = counts.agg(F.coalesce(F.sum(F.col("a")), F.lit(0)).alias("a"), F.coalesce(F.sum(F.col("b")), F.lit(0)).alias("b"),
                        F.count("*").alias("v")).head()
    n, v = totals.a + totals.b, totals.v
    top = at_most(counts, shape.frequent)
    words, c = top["word"].to_numpy(np.int64), top["c"].to_numpy(np.int64)
    if not n:
        one = np.zeros((1, 1))
        return Model(words, c, words[:0], 0, 0, 1.0, one, np.ones(1))
    # e: estimates of one fold against the counts of the other; words of equal count are alike.
    sides = []
    for mine, theirs in (("a", "b"), ("b", "a")):
        t = counts.groupBy(F.col(mine).alias("m")).agg(F.sum(theirs).alias("t")).toPandas()
        sides.append((t["t"].to_numpy(float), t["m"].to_numpy(float) / max(getattr(totals, mine), 1)))
    mass, ml = np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides])
    e = 1 - float(em(mass, ml, np.full(len(ml), 1 / (v + 1)), np.zeros(len(ml), np.int64), 1, shape.em_steps)[0])
    e = min(max(e, 1e-9), 1.0)
    if shape.classes is None:
        return Model(words, c, words[:0], n, v, e, np.zeros((1, 1)), np.ones(1))
    # l(h): the same at the level of classes.
    best = np.sort(np.lexsort((words, -c))[:shape.classes - 1])
    named, named_c = words[best], c[best]
    pairs = pair_counts(rows, named)
    k = len(named) + 1
    parts = []
    for mine in (0, 1):
        own, other = pairs[mine], pairs[1 - mine]
        h, w = np.nonzero(other)
        of_context = own.sum(axis=1)
        p2 = own[h, w] / np.maximum(of_context[h], 1)
        p1 = (own.sum(axis=0)[w] + 0.5) / (own.sum() + 0.5 * k)
        parts.append((other[h, w].astype(float), p2, p1, buckets(of_context)[h]))
    mass, p2, p1, group = (np.concatenate(x) for x in zip(*parts))
    both = pairs.sum(axis=0)
    of_context = both.sum(axis=1)
    own_bucket = buckets(of_context)
    groups = int(max(group.max(initial=0), own_bucket.max(initial=0))) + 1
    weight = em(mass, p2, p1, group, groups, shape.em_steps)
    weight[np.bincount(group, mass, groups) == 0] = 0.0
    l = np.where(of_context > 0, weight[own_bucket], 0.0)
    model = Model(words, c, named, n, v, e, np.zeros((k, k)), 1 - l)
    bigram = l[:, None] * both / np.maximum(of_context, 1)[:, None]
    rest = 1 - model.p1(named_c).sum()  # what p1 gives to all words without a class of their own
    bigram[:, -1] /= max(rest, 1e-300)
    model.bigram = bigram
    return model


FOUND = StructType([StructField("word", LongType()), StructField("row", LongType()), StructField("times", LongType()),
                    StructField("doc_id", StringType()), StructField("held_out", BooleanType()), StructField("n_tokens", LongType()),
                    StructField("n_known", LongType()), StructField("base", DoubleType()), StructField("score", DoubleType())])


def read_texts(rows: DataFrame, model: Model) -> DataFrame:
    """Per text one row (times null) with what the bounded tables tell, and one per rare word in it."""
    sent = rows.sparkSession.sparkContext.broadcast(model)  # at most `frequent` words and classes^2 cells

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        end_class = int(classes_of(word_hashes([END]).view(np.int64), m.named)[0])
        row = np.int64(TaskContext.get().partitionId()) << 36
        for batch in rows_of(batches):
            words, sizes = tokens(batch["text"])
            owner = np.repeat(np.arange(len(batch)), sizes)
            at = places(words, m.words)
            rare = at < 0
            c = np.where(rare, 0, m.counts[at] if len(m.counts) else 0)
            cls = classes_of(words, m.named)
            h = contexts(cls, sizes, end_class)
            named = cls < len(m.named)
            p1 = m.p1(c)
            factor = m.bigram[h, cls]
            p = np.where(named, factor + m.keep[h] * p1, (factor + m.keep[h]) * np.where(rare, 1.0, p1))
            base = np.where(rare, 0.0, m.base(c))
            n = len(batch)
            yield pd.DataFrame({
                "word": word_hashes([str(row + i).encode() for i in range(n)]).view(np.int64), "row": row + np.arange(n),
                "times": pd.array([pd.NA] * n, dtype="Int64"), "doc_id": batch["doc_id"].to_numpy(),
                "held_out": batch["fold"].to_numpy() < 0, "n_tokens": sizes, "n_known": np.bincount(owner, ~rare, n).astype(np.int64),
                "base": np.bincount(owner, base, n), "score": np.bincount(owner, np.log10(p), n)})
            if rare.any():
                pairs = pd.DataFrame({"word": words[rare], "row": row + owner[rare]}).value_counts(sort=False)
                some = pairs.rename("times").reset_index()
                for name in ("doc_id", "held_out", "n_tokens", "n_known", "base", "score"):
                    some[name] = None
                yield some
            row += n

    return rows.mapInPandas(read, FOUND)


#: A pair's words: places among the frequent words, or hashes of rare ones, told by kind (1: w is rare, 2: h is, 3: both).
PAIR = "h long, w long, kind int"
COUNTS = ("a", "b", "ha", "hb", "wa", "wb")  # of the pair, its context and its outcome, in each fold
#: Kind of a rare word that stands alone, in the same table as the pairs.
WORD = 4
#: Bins of p2 / p1 an octave, for the weights.
BINS = 64
SLICE = 1 << 17


def pairs_of(words: np.ndarray, sizes: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, ...]:
    """(code of each token's pair, h, w, kind of each code); before the first word of a text stands the end token."""
    end = word_hashes([END]).view(np.int64)[0]
    before = np.r_[end, words[:-1]]
    before[np.cumsum(sizes) - sizes] = end
    code, distinct = pd.factorize(np.r_[words, before])
    n, k = len(words), len(distinct)
    pair, cells = pd.factorize(code[n:] * np.int64(k) + code[:n])
    at = places(distinct, among)
    name, rare = np.where(at < 0, distinct, at), at < 0
    h, w = cells // k, cells % k
    return pair, name[h], name[w], (2 * rare[h] + rare[w]).astype(np.int32)


def all_pairs(rows: DataFrame, words: np.ndarray) -> DataFrame:
    """(h, w, kind, a, b) of every pair of the training texts: its counts in the two folds."""
    sent = rows.sparkSession.sparkContext.broadcast(words)  # at most `frequent`

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows_of(batches):
            found, sizes = tokens(batch["text"])
            pair, h, w, kind = pairs_of(found, sizes, sent.value)
            first = np.repeat(batch["fold"].to_numpy() == 0, sizes)
            a = np.bincount(pair[first], minlength=len(h))
            b = np.bincount(pair[~first], minlength=len(h))
            for i in range(0, len(h), SLICE):
                at = slice(i, i + SLICE)
                yield pd.DataFrame({"h": h[at], "w": w[at], "kind": kind[at], "a": a[at], "b": b[at]})

    return materialise(rows.where("fold >= 0").mapInPandas(count, f"{PAIR}, a long, b long").groupBy("h", "w", "kind").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")), "pairs")


def with_counts(pairs: DataFrame, counts: DataFrame, sides: np.ndarray) -> DataFrame:
    """(h, w, kind, COUNTS): the pairs with the counts of both words; `sides` has those of the frequent words."""
    sent = pairs.sparkSession.sparkContext.broadcast(sides)  # two columns of at most `frequent` rows

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in rows_of(batches):
            for name, bit in (("h", 2), ("w", 1)):
                known = (p["kind"].to_numpy() & bit) == 0
                got = np.zeros((len(p), 2), np.int64)
                got[known] = sent.value[p[name].to_numpy()[known]]
                p[f"{name}a"], p[f"{name}b"] = got[:, 0], got[:, 1]
            yield p

    out = pairs.mapInPandas(look_up, f"{PAIR}, {', '.join(f'{c} long' for c in COUNTS)}")
    plain, odd = out.where("kind = 0"), out.where("kind > 0")
    # A pair with one rare word is dealt by that word in both joins, and takes nothing from the other: no key is hot.
    for name, bit, other in (("h", 2, "w"), ("w", 1, "h")):
        rare = F.col("kind").bitwiseAND(bit) != 0
        theirs = counts.select(F.col("word").alias("k"), F.col("a").alias("ka"), F.col("b").alias("kb"))
        odd = odd.withColumn("key", F.when(rare, F.col(name)).otherwise(F.col(other))).join(
            theirs, F.col("key") == F.col("k"), "left").withColumns(
            {f"{name}{f}": F.when(rare, F.col(f"k{f}")).otherwise(F.col(f"{name}{f}")) for f in "ab"}).select(*out.columns)
    return plain.unionByName(odd)


def bucket_weights(pairs: DataFrame, model: Model, n: tuple[int, int], shape: Shape) -> np.ndarray:
    """l(h) by bucket of the context count; 0 for unseen contexts and for buckets without held-out counts."""
    e, v = model.e, model.v

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in rows_of(batches):
            for own, other, size in (("a", "b", n[0]), ("b", "a", n[1])):
                q = p[p[other] > 0]
                k, mass, h, w = (q[c].to_numpy(float) for c in (own, other, f"h{own}", f"w{own}"))
                low = (1 - e) * w / max(size, 1) + e / (v + 1)
                ratio = k / np.maximum(h, 1) / low
                at = np.where(k > 0, np.floor(np.log2(np.where(k > 0, ratio, 1)) * BINS), -(1 << 20)).astype(np.int32)
                yield pd.DataFrame({"bucket": buckets(h), "bin": at, "mass": mass, "high": mass * ratio}).groupby(
                    ["bucket", "bin"], as_index=False).sum()

    got = pairs.mapInPandas(bins, "bucket long, bin int, mass double, high double").groupBy("bucket", "bin").agg(
        F.sum("mass").alias("mass"), F.sum("high").alias("high")).orderBy("bucket", "bin").toPandas()  # bounded bins
    group, mass = got["bucket"].to_numpy(np.int64), got["mass"].to_numpy(float)
    groups = 66  # a count has at most 64 bits
    weight = em(mass, got["high"].to_numpy(float) / np.maximum(mass, 1), np.ones(len(mass)), group, groups, shape.em_steps)
    weight[np.bincount(group, mass, groups) == 0] = 0.0
    weight[0] = 0.0
    return np.clip(weight, 0.0, 1 - 1e-9)


def pair_gains(pairs: DataFrame, model: Model, weight: np.ndarray) -> DataFrame:
    """(h, w, kind, c, gain): what log10 p(w | h) is above log10((1 - l(h)) p1(w)), for each pair seen."""
    e, n, v = model.e, model.n, model.v

    def gain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in rows_of(batches):
            c, h, w = ((p[f"{x}a"] + p[f"{x}b"]).to_numpy(float) for x in ("", "h", "w"))
            l = weight[buckets(h)]
            low = (1 - e) * w / max(n, 1) + e / (v + 1)
            yield pd.DataFrame({"h": p["h"], "w": p["w"], "kind": p["kind"], "c": c.astype(np.int64),
                                "gain": np.log10(1 + l * c / np.maximum(h, 1) / ((1 - l) * low))})

    return pairs.mapInPandas(gain, f"{PAIR}, c long, gain double")


KEYED = pa.schema([("h", pa.int64()), ("w", pa.int64()), ("kind", pa.int32()), ("row", pa.int64()), ("times", pa.int64()),
                   ("doc_id", pa.string()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                   ("base", pa.float64()), ("score", pa.float64())])


def read_pairs(rows: DataFrame, model: Model, weight: np.ndarray, top: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per text one row (times null) with what the bounded tables tell, one per rare word and one per other pair in it."""
    sent = rows.sparkSession.sparkContext.broadcast((model, weight, top))  # at most `frequent` words and `pairs` pairs

    def batch_of(columns: dict) -> pa.RecordBatch:
        size = len(columns["row"])
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
                                           for f in KEYED], schema=KEYED)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, l, (top_pairs, top_gain) = sent.value
        row = np.int64(TaskContext.get().partitionId()) << 36
        for batch in rows_of(b.to_pandas() for b in batches):
            words, sizes = tokens(batch["text"])
            n = len(batch)
            owner = np.repeat(np.arange(n), sizes)
            at = places(words, m.words)
            rare = at < 0
            c = np.where(rare, 0, m.counts[at] if len(m.counts) else 0)
            base = np.where(rare, 0.0, m.base(c))
            # Every word but the last stands before another, and the end token before the first: so each is a context once.
            own = np.where(rare, 0.0, np.log10(m.p1(c)) + np.log10(1 - l[buckets(c)]))
            pair, h, w, kind = pairs_of(words, sizes, m.words)
            spot = np.where(kind == 0, places(np.where(kind == 0, h << 20 | w, -1), top_pairs), -1)
            gain = np.where(spot < 0, 0.0, top_gain[spot] if len(top_gain) else 0.0)
            own += gain[pair]
            yield batch_of({
                "h": word_hashes([str(row + i).encode() for i in range(n)]).view(np.int64), "kind": np.full(n, -1, np.int32),
                "row": row + np.arange(n), "doc_id": batch["doc_id"].tolist(),
                "held_out": batch["fold"].to_numpy() < 0, "n_tokens": sizes, "n_known": np.bincount(owner, ~rare, n).astype(np.int64),
                "base": np.bincount(owner, base, n), "score": np.bincount(owner, own, n)})
            single, alone = pd.factorize(words[rare])
            yield from counted(single, owner[rare], alone, np.zeros(len(alone), np.int64), np.full(len(alone), WORD, np.int32), row)
            left = spot[pair] < 0
            yield from counted(pair[left], owner[left], h, w, kind, row)
            row += n

    def counted(code, owner, h, w, kind, row) -> Iterator[pa.RecordBatch]:
        each, times = np.unique(owner * np.int64(max(len(h), 1)) + code, return_counts=True)
        for i in range(0, len(each), SLICE):
            part = each[i:i + SLICE]
            code = part % len(h)
            yield batch_of({"h": h[code], "w": w[code], "kind": kind[code], "row": row + part // len(h), "times": times[i:i + SLICE]})

    return rows.mapInArrow(read, f"{PAIR}, row long, times long, doc_id string, held_out boolean, n_tokens long, n_known long, "
                                 "base double, score double")


def score_by_pairs(rows: DataFrame, counts: DataFrame, model: Model, shape: Shape) -> DataFrame:
    """The scores with every word as a context and outcome of its own."""
    sides = np.zeros((0, 2), np.int64)
    if len(model.words):
        least = int(model.counts.min())
        sides = counts.where(F.col("a") + F.col("b") >= least).toPandas().sort_values("word")[["a", "b"]].to_numpy(np.int64)
    n = counts.agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in "ab"]).head()
    raw = all_pairs(rows, model.words)
    pairs = with_counts(raw, counts, sides)
    weight = bucket_weights(pairs, model, (n.a, n.b), shape) if model.n else np.zeros(66)
    gains = pair_gains(pairs, model, weight)
    # No pair of the rest can be hot: each is rarer than all of these, or as rare as its rarer word.
    least = least_count(raw.where("kind = 0").select((F.col("a") + F.col("b")).alias("c")), shape.pairs)
    top = (np.zeros(0, np.int64), np.zeros(0))
    if least is not None:
        often = pair_gains(with_counts(raw.where((F.col("kind") == 0) & (F.col("a") + F.col("b") >= least)), counts, sides).where(
            "kind = 0"), model, weight).select(F.shiftleft("h", 20).bitwiseOR(F.col("w")).alias("at"), "gain").toPandas().sort_values("at")
        top = (often["at"].to_numpy(np.int64), often["gain"].to_numpy(float))
        gains = gains.where((F.col("kind") > 0) | (F.col("c") < least))
    found = read_pairs(rows, model, weight, top)
    table = gains.select("h", "w", "kind", F.col("gain").alias("value")).unionByName(counts.select(
        F.col("word").alias("h"), F.lit(0).cast("long").alias("w"), F.lit(WORD).alias("kind"),
        (F.col("a") + F.col("b")).cast("double").alias("value")))
    value = F.coalesce(F.col("value"), F.lit(0.0))
    one = F.lit(1.0)
    base = F.log10((value + 1) / (one * model.n + 1 * (one * model.v + 1)))
    keep = F.array(*[F.lit(float(np.log10(1 - x))) for x in weight])
    bucket = F.when(value > 0, F.length(F.bin(value.cast("long")))).otherwise(0)
    p1 = F.log10(value * ((1 - model.e) / max(model.n, 1)) + model.e / (model.v + 1)) + F.get(keep, bucket)
    n, word, text = F.col("times"), F.col("kind") == WORD, F.col("kind") < 0
    joined = found.withColumn("w", F.coalesce("w", F.lit(0))).join(table, ["h", "w", "kind"], "left")
    return joined.groupBy("row").agg(
        F.max("doc_id").cast("long").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.when(text, F.col("n_known")).otherwise(F.when(word & (value > 0), n).otherwise(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        F.sum(F.when(text, F.col("base")).otherwise(F.when(word, n * base).otherwise(0.0))).alias("base_score"),
        F.sum(F.when(text, F.col("score")).otherwise(n * F.when(word, p1).otherwise(value))).alias("score")).drop("row")


def score_documents(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """One row per row of `docs` (doc_id, text): token figures, base score and model score."""
    bounded_batches(docs.sparkSession)
    rows = folded(docs)
    counts = materialise(word_counts(rows), "words")
    model = learn(rows, counts, shape)
    if shape.classes is None:
        return score_by_pairs(rows, counts, model, shape)
    found = read_texts(rows, model)
    rare = counts.select("word", (F.col("a") + F.col("b")).alias("c"))
    c = F.coalesce(F.col("c"), F.lit(0)).cast("double")
    one = F.lit(1.0)
    base = F.log10((c + 1) / (one * model.n + 1 * (one * model.v + 1)))
    p1 = F.log10(c * ((1 - model.e) / max(model.n, 1)) + model.e / (model.v + 1))
    n = F.col("times")
    joined = found.join(rare, "word", "left")
    return joined.groupBy("row").agg(
        F.max("doc_id").cast("long").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.when(n.isNull(), F.col("n_known")).otherwise(F.when(c > 0, n).otherwise(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        F.sum(F.when(n.isNull(), F.col("base")).otherwise(n * base)).alias("base_score"),
        F.sum(F.when(n.isNull(), F.col("score")).otherwise(n * p1)).alias("score")).drop("row")
