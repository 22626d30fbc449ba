"""Spelling variants: a relational frontier over a distributed trie.

Words are near if exactly one code point inserted, deleted or replaced makes one of the
other. The trie of all words is a table of edges (level, node, label, child, word ending
there), and so is the trie of all words read backwards. States (word, position, node,
edits) are joined with the edges of one level at a time; every join follows an edge by an
equal label, by one replaced code point, or by skipping one code point of the word. A
state that has read its word with one edit, where a word ends, is a pair of neighbours;
insertions are the same pairs seen from the other word.

One edit leaves the front half or the back half of the word as it is. So the states of the
forward trie read the front half without edits, those of the backward trie the back half,
and edits are tried below depth three only, where nodes have few children: the frontier
stays a small multiple of the words. Edges carry one code point down to depth 16 and
doubling blocks below, so very long words take few levels. Nodes are 64-bit hashes of
their prefixes; should two collide, more states are followed, and every pair is verified
at the end, so none is wrong or lost.

Each level is written to the shared folder. States of one node are joined by a plain
shuffle join, which Spark splits where a node holds very many states.

Defined cases: a null text has no words; a null id counts as the empty text in the
digest; repeated rows count each; words without neighbours have n_near 0; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stray.llm.common import bounded_batches, materialise

#: Words that a task counts before it passes them on.
COUNTED = 200_000


@dataclass(frozen=True)
class SpellingRules:
    """A letter pattern, the least word length and count, how many times as often a form must occur,
    and the digest that damages one run in `damage` of the query's table (0: none)."""

    letters: str = "A-Za-zÀ-ÿ"
    min_chars: int = 6
    min_count: int = 5
    ratio: int = 5
    damage: int = 199


def damaged(doc: str, run: str, modulus: int) -> str:
    h = zlib.crc32(f"{doc}:{run}".encode())
    if modulus and h % modulus == 0:
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return run


def word_counts(docs: DataFrame, rules: SpellingRules = SpellingRules(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words long and frequent enough, over whole texts; counts pre-aggregate in the task."""
    bounded_batches(docs.sparkSession)
    # maximal runs: a shorter run can't match, and a longer one is taken whole
    runs = re.compile(f"[{rules.letters}]{{{rules.min_chars},}}")

    def flushed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc, t in zip(batch.column("doc").to_pylist(), batch.column("t").to_pylist()):
                own = Counter(runs.findall(t.lower().decode("utf-8", "replace")))  # bytes: A-Z only
                for word, n in own.items():
                    word = damaged(doc, word, rules.damage)
                    if len(word) >= rules.min_chars:
                        counts[word] += n
                if len(counts) > COUNTED:
                    yield flushed(counts)
                    counts = Counter()
        yield flushed(counts)

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"),
                       F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("t"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= rules.min_count))


def depths(longest: int) -> list[int]:
    """Depths where labels begin: one code point each down to 16, then doubling blocks."""
    out = list(range(17))
    while out[-1] < longest:
        out.append(2 * out[-1])
    return out


def node(way: Column, word: Column, depth) -> Column:
    return F.xxhash64(way, F.substring(word, 1, depth) if isinstance(depth, int) else F.left(word, depth))


def oriented(words: DataFrame) -> DataFrame:
    """(word, way, s, half): each word forward and backward, and where its edits may begin."""
    size = F.char_length("word")
    half = F.floor(size / 2).cast("int")
    ways = F.array(F.struct(F.lit("f").alias("way"), F.col("word").alias("s"), half.alias("half")),
                   F.struct(F.lit("b").alias("way"), F.reverse("word").alias("s"), (size - half).alias("half")))
    return words.select("word", F.explode(ways).alias("o")).select("word", "o.*")


def trie_edges(words: DataFrame, cuts: list[int], top: int) -> DataFrame:
    """(level, node, label, child, ends): all edges from level `top` on; `ends` is the word that ends at the child."""
    levels = F.array(*[F.struct(F.lit(k).alias("level"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                       for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if k >= top])
    size = F.char_length("s")
    steps = oriented(words).select("word", "way", "s", F.explode(F.filter(levels, lambda x: x["a"] < size)).alias("l"))
    label = F.substring(F.col("s"), F.col("l.a") + 1, F.col("l.b") - F.col("l.a"))
    return (steps.select(F.col("l.level").alias("level"), node(F.col("way"), F.col("s"), F.col("l.a")).alias("node"), label.alias("label"),
                         node(F.col("way"), F.col("s"), F.col("l.b")).alias("child"),
                         F.when(F.col("l.b") >= size, F.col("word")).alias("ends"))
            .groupBy("level", "node", "label", "child").agg(F.max("ends").alias("ends")))


def followed(states: DataFrame, edges: DataFrame) -> DataFrame:
    """All states after one more label, with the word found (`near`), if any."""
    m, own = F.char_length("label"), F.substring(F.col("s"), F.col("pos") + 1, F.char_length("label"))
    joined = states.join(edges, "node").where((F.col("edits") == 0) | (own == F.col("label")))
    more = F.substring(F.col("s"), F.col("pos") + 1, m + 1)
    equal, clean = own == F.col("label"), F.col("edits") == 0
    replaced = clean & ~equal & (F.char_length(own) == m) & ((m == 1) | (F.levenshtein(own, "label") == 1))
    # one code point skipped: of a run of equal ones the last, which is where the next label differs
    skipped = clean & (F.char_length(more) == m + 1) & F.when(
        m == 1, ~equal & (F.substring(more, 2, 1) == F.col("label"))).otherwise(F.levenshtein(more, "label") == 1)
    nothing = F.lit(None).cast("struct<pos:int,edits:int>")

    def to(step: Column, edits) -> Column:
        return F.struct((F.col("pos") + step).cast("int").alias("pos"), F.lit(edits).cast("int").alias("edits") if isinstance(edits, int)
                        else edits.cast("int").alias("edits"))

    ways = F.array_compact(F.array(F.when(equal, to(m, F.col("edits"))).otherwise(nothing),
                                   F.when(replaced, to(m, 1)).otherwise(nothing),
                                   F.when(skipped, to(m + 1, 1)).otherwise(nothing)))
    moved = joined.select("word", "s", "child", "ends", F.explode(ways).alias("to"))
    left = F.char_length("s") - F.col("to.pos")
    # a clean state one code point before its end skips that
    near = F.when((F.col("to.edits") == 1) & (left == 0) | (F.col("to.edits") == 0) & (left == 1), F.col("ends"))
    return (moved.select("word", "s", F.col("child").alias("node"), F.col("to.pos").alias("pos"), F.col("to.edits").alias("edits"), near.alias("near"))
            .where(F.col("near").isNotNull() | (F.char_length("s") > F.col("pos"))))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of near words, both ways."""
    spark = words.sparkSession
    spans = words.agg(F.min(F.char_length("word")), F.max(F.char_length("word"))).first()
    if spans[0] is None:
        return spark.createDataFrame([], "word string, near string")
    cuts = depths(spans[1])
    level_of = lambda depth: max(k for k, c in enumerate(cuts[:-1]) if c <= depth)
    top = level_of(spans[0] // 2)
    edges = materialise(trie_edges(words, cuts, top).repartition("level", "node"), "trie-edges")
    starts = oriented(words)
    found, states = [], None
    for k in range(top, len(cuts) - 1):
        begin = starts.where((F.col("half") >= cuts[k]) & (F.col("half") < cuts[k + 1])).select(
            "word", "s", node(F.col("way"), F.col("s"), cuts[k]).alias("node"), F.lit(cuts[k]).alias("pos"), F.lit(0).alias("edits"))
        states = begin if states is None else begin.unionByName(states)
        level = materialise(followed(states, edges.where(F.col("level") == k).drop("level")), f"trie-level-{k}")
        found.append(level.where(F.col("near").isNotNull()).select("word", "near"))
        states = level.where(F.char_length("s") > F.col("pos")).drop("near")
    pairs = reduce(DataFrame.unionByName, found)
    both = pairs.select(F.explode(F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))).alias("p"))
    return both.select("p.*").distinct().where(F.levenshtein("word", "near") == 1)


def variants(words: DataFrame, rules: SpellingRules = SpellingRules()) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word (word, n)."""
    pairs = near_words(words)
    other = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (pairs.join(other, "near").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("b")))
    chosen = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("b.k") >= rules.ratio * F.col("n"), F.struct(F.col("b.near").alias("form"), (-F.col("b.k")).alias("form_n"))).alias("f"))
    chosen = materialise(chosen.select("word", "n", "n_near", "f.form", "f.form_n"), "variants")
    # A form is `ratio` times as frequent as its word, so chains are short; each step doubles what is followed.
    links = chosen.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        links = materialise(links, "roots")
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not links.join(on, "root", "left_semi").limit(1).count():
            break
        links = links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return chosen.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_query(docs: DataFrame, rules: SpellingRules = SpellingRules()) -> DataFrame:
    """Every word of the documents with its variants' form and root."""
    return variants(materialise(word_counts(docs, rules), "words"), rules)
