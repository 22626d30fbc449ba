"""BPE encoding by a minimal acyclic transducer of frequent words, and exact merging of the rest.

Frequent chunks of the corpus (a blank and what follows it) are compiled, in byte order,
into a minimal acyclic automaton: equal suffixes share their states. Every arc carries
the number of words that sort before those below it, so the sum along a word's arcs is
the word's number, and the number leads to its ids. The arrays are written to one file,
sent to the executors by SparkContext.addFile, and mapped into memory there, so all
workers of a machine share one copy. The lexicon is bounded by `words`, a parameter;
its size does not change results, since every chunk that is not in it is cut by the
pre-tokeniser's pattern and merged pair by pair, lowest rank first.

Defined cases: a null or empty text has no ids and decodes to ''; repeated rows are
encoded each; the added token's string in a text is its id, as the tokenizers library
reads it; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stray.llm.bpe import MARK, byte_ranks, chunks, tokenizer_path
from stray.llm.common import bounded_batches, least_count, materialise, rows_of, text_of

#: Fixed value: the pre-tokeniser's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARK_ID = 50256
#: Chunks, and pieces of them, that a worker remembers before it starts afresh.
REMEMBERED = 400_000
#: Characters whose chunks a worker holds at once.
AT_ONCE = 1 << 20
#: Bytes up to which pieces are merged many at once, by looking at all their pairs.
SHORT = 32


class PairTable:
    """Which two ids join to which: all cuts of the tokens in two tokens, as sorted arrays."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        rank, keys, joined = ranks.get, [], []
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                left = rank(token[:cut])
                if left is not None and (right := rank(token[cut:])) is not None:
                    keys.append(left << 20 | right)
                    joined.append(i)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.joined = np.array(keys, np.int64)[order], np.array(joined, np.int64)[order]
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.none = len(ranks) + MARK_ID

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair joins to, which is its rank, or `none`."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.joined[at], self.none)


def merge_many(pieces: list[bytes], table: PairTable) -> list[list[int]]:
    """Ids of many pieces at once: in every step each piece joins its pair of lowest rank, of equals the first."""
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ids = table.single[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), size)
    rank = np.full(len(ids), table.none)
    if len(ids) > 1:
        rank[:-1] = np.where(owner[1:] == owner[:-1], table.of(ids[:-1], ids[1:]), table.none)
    done_ids, done_owner = [], []
    while len(ids):
        begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        least = np.minimum.reduceat(rank, begin)
        count = np.diff(np.r_[begin, len(ids)])
        open_ = np.repeat(least < table.none, count)
        if not open_.all():
            done_ids.append(ids[~open_])
            done_owner.append(owner[~open_])
            least, count = least[least < table.none], count[least < table.none]
            ids, owner, rank = ids[open_], owner[open_], rank[open_]
            if not len(ids):
                break
        hit = np.flatnonzero(rank == np.repeat(least, count))
        hit = hit[np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]]
        ids[hit] = rank[hit]
        keep = np.ones(len(ids), bool)
        keep[hit + 1] = False
        ids, owner, rank = ids[keep], owner[keep], rank[keep]
        hit = hit - np.arange(len(hit))  # one id before it has gone from each earlier piece
        for left in (hit, hit - 1):
            left = left[(left >= 0) & (left < len(ids))]
            after = np.minimum(left + 1, len(ids) - 1)
            rank[left] = np.where((after > left) & (owner[after] == owner[left]), table.of(ids[left], ids[after]), table.none)
    if not done_ids:
        return []
    ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    ends = np.cumsum(np.bincount(owner, minlength=len(pieces)))
    flat = ids[order].tolist()
    return [flat[i:j] for i, j in zip([0, *ends.tolist()], ends.tolist())]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Neighbours are linked and pairs wait in a heap, so a piece of n bytes takes n log n steps."""
    n = len(piece)
    part = [piece[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    waiting = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, i, size = heapq.heappop(waiting)
        j = after[i]
        if part[i] is None or j >= n or len(part[i]) + len(part[j]) != size:
            continue  # one of the two has been joined meanwhile
        part[i] += part[j]
        part[j] = None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(part[i] + part[k])) is not None:
                heapq.heappush(waiting, (r, i, len(part[i]) + len(part[k])))
        h = before[i]
        if h >= 0 and (r := ranks.get(part[h] + part[i])) is not None:
            heapq.heappush(waiting, (r, h, len(part[h]) + len(part[i])))
    return [ranks[p] for p in part if p is not None]


@cache
def pattern():
    return regex.compile(PATTERN)


def plain_word(chunk: str) -> bool:
    """A blank and Latin letters, which are one piece whatever the Unicode version."""
    return chunk[:1] == " " and chunk[1:].isalpha() and max(chunk) <= "ſ"


class Merger:
    """Ids of chunks by merging their pieces; pieces of chunks that are no plain words are remembered."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.table, self.known = ranks, None, {}

    def chunks(self, many: list[str]) -> list[list[int]]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        plain = [plain_word(c) for c in many]
        cut = [None if p else [pattern().findall(section) for section in c.split(MARK)] for c, p in zip(many, plain)]
        self.known.update(self.merged(sorted({p for c in cut if c for section in c for p in section if p not in self.known})))
        words = self.merged([c for c, p in zip(many, plain) if p])
        out = []
        for c, sections in zip(many, cut):
            if sections is None:
                out.append(words[c])
                continue
            ids: list[int] = []
            for k, section in enumerate(sections):
                if k:
                    ids.append(MARK_ID)
                for piece in section:
                    ids += self.known[piece]
            out.append(ids)
        return out

    def merged(self, pieces: list[str]) -> dict[str, list[int]]:
        out, short, rank = {}, [], self.ranks.get
        for piece in pieces:
            raw = piece.encode()
            whole = rank(raw)
            if whole is not None:
                out[piece] = [whole]
            elif len(raw) <= SHORT:
                short.append((piece, raw))
            else:
                out[piece] = merge_long(raw, self.ranks)
        if short:
            self.table = self.table or PairTable(self.ranks)
            out.update(zip((p for p, _ in short), merge_many([raw for _, raw in short], self.table)))
        return out


def minimal_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """Arrays of the minimal acyclic automaton of sorted, distinct words.

    State s has the arcs first[s] to first[s + 1], by label; an arc has its label, its
    target and how many words sort before those that continue through it.
    """
    registry: dict[tuple, int] = {}
    arcs_of: list[tuple] = []
    final_of: list[bool] = []
    count_of: list[int] = []

    def register(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, *arcs)
        state = registry.get(key)
        if state is None:
            state = registry[key] = len(arcs_of)
            arcs_of.append(tuple(arcs))
            final_of.append(final)
            count_of.append(final + sum(count_of[t] for _, t in arcs))
        return state

    path: list[list] = [[False, []]]  # states still open along the last word: final, arcs
    last = b""
    for word in words:
        same = len(os.path.commonprefix([word, last]))
        for depth in range(len(last), same, -1):
            final, arcs = path.pop()
            path[-1][1].append((last[depth - 1], register(final, arcs)))
        path += [[False, []] for _ in range(same, len(word))]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        final, arcs = path.pop()
        path[-1][1].append((last[depth - 1], register(final, arcs)))
    root = register(*path[0])

    first = np.zeros(len(arcs_of) + 1, np.int64)
    first[1:] = np.cumsum([len(a) for a in arcs_of])
    label, target, skip = [], [], []
    for state, arcs in enumerate(arcs_of):
        passed = int(final_of[state])
        for byte, to in arcs:
            label.append(byte)
            target.append(to)
            skip.append(passed)
            passed += count_of[to]
    source = np.repeat(np.arange(len(arcs_of), dtype=np.int64), np.diff(first))
    return {"key": source * 256 + np.array(label, np.int64), "target": np.array(target, np.int64),
            "skip": np.array(skip, np.int64), "final": np.array(final_of, np.int64), "root": np.array([root], np.int64)}


def compile_lexicon(words: list[bytes], ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    words = sorted(set(words))
    auto = minimal_automaton(words)
    ids = Merger(ranks).chunks([w.decode() for w in words])
    ends = np.zeros(len(ids) + 1, np.int64)
    ends[1:] = np.cumsum([len(i) for i in ids])
    return auto | {"ends": ends, "ids": np.array([x for i in ids for x in i], np.int64)}


NAMES = ("key", "target", "skip", "final", "root", "ends", "ids")


def write_lexicon(lexicon: dict[str, np.ndarray], path: str) -> None:
    """One file: the lengths of the arrays, then the arrays, all little-endian int64."""
    with open(path, "wb") as f:
        np.array([len(lexicon[n]) for n in NAMES], "<i8").tofile(f)
        for n in NAMES:
            lexicon[n].astype("<i8").tofile(f)


def map_lexicon(path: str) -> dict[str, np.ndarray]:
    whole = np.asarray(np.memmap(path, dtype="<i8", mode="r"))  # a plain view of the mapped file
    ends = np.cumsum(whole[:len(NAMES)]) + len(NAMES)
    return {n: whole[end - size:end] for n, size, end in zip(NAMES, whole, ends)}


def numbers(lexicon: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """The number of each word in the lexicon, or -1; all words step through the automaton together."""
    out = np.full(len(words), -1, np.int64)
    if not len(words) or not len(lexicon["key"]):
        return out
    size = np.fromiter(map(len, words), np.int64, len(words))
    signs = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    begin = np.cumsum(size) - size
    alive = np.arange(len(words))
    state = np.full(len(words), lexicon["root"][0], np.int64)
    total = np.zeros(len(words), np.int64)
    step = 0
    while len(alive):
        done = size[alive] == step
        ended = alive[done]
        accepted = ended[lexicon["final"][state[ended]] == 1]
        out[accepted] = total[accepted]
        alive = alive[~done]
        if not len(alive):
            break
        wanted = state[alive] * 256 + signs[begin[alive] + step]
        arc = np.minimum(np.searchsorted(lexicon["key"], wanted), len(lexicon["key"]) - 1)
        found = lexicon["key"][arc] == wanted
        alive, arc = alive[found], arc[found]
        total[alive] += lexicon["skip"][arc]
        state[alive] = lexicon["target"][arc]
        step += 1
    return out


def gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[begin:begin + size] of each, one after another."""
    ends = np.cumsum(size)
    return flat[np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Codec:
    """Encodes and decodes with a mapped lexicon; chunks outside it are merged. A chunk met before, in this batch or
    an earlier one, is one look-up: its number leads to its ids in one array."""

    def __init__(self, lexicon: dict[str, np.ndarray], ranks: dict[bytes, int]) -> None:
        self.lexicon, self.merger = lexicon, Merger(ranks)
        self.forget()
        self.bytes_of = [b""] * (MARK_ID + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.bytes_of[MARK_ID] = MARK.encode()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, fresh: list[str]) -> None:
        """Number new chunks: ids of the lexicon's words from the mapped file, all others merged."""
        ends = self.lexicon["ends"]
        word = numbers(self.lexicon, [c.encode() for c in fresh])
        known = np.flatnonzero(word >= 0)
        size = np.zeros(len(fresh), np.int64)
        size[known] = ends[word[known] + 1] - ends[word[known]]
        merged = self.merger.chunks([fresh[i] for i in np.flatnonzero(word < 0).tolist()])
        size[word < 0] = [len(ids) for ids in merged]
        stored = gathered(self.lexicon["ids"], ends[word[known]], size[known]) if len(known) else np.zeros(0, np.int64)
        # first the lexicon's words, then the merged ones
        order = np.r_[known, np.flatnonzero(word < 0)]
        at = np.zeros(len(fresh), np.int64)
        at[order] = np.cumsum(size[order]) - size[order]
        self.number.update(zip(fresh, range(len(self.size), len(self.size) + len(fresh))))
        self.begin, self.size = np.r_[self.begin, at + len(self.flat)], np.r_[self.size, size]
        self.flat = np.concatenate([self.flat, stored.astype(np.uint32), np.array([x for ids in merged for x in ids], np.uint32)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.number) > REMEMBERED:
            self.forget()
        split = [chunks(t) if t else [] for t in texts]
        codes = [list(map(self.number.get, cs)) for cs in split]
        fresh = {c for cs, code in zip(split, codes) if None in code for c, k in zip(cs, code) if k is None}
        if fresh:
            self.learn(list(fresh))
        out = []
        for cs, code in zip(split, codes):
            if None in code:
                code = list(map(self.number.__getitem__, cs))
            at = np.array(code, np.int64)
            out.append(gathered(self.flat, self.begin[at], self.size[at]))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The decoded text in UTF-8."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
        return raw


def frequent_chunks(docs: DataFrame, words: int) -> list[bytes]:
    """The chunks most often met in all texts, at most `words`: blanks cut the text, and counts
    pre-aggregate. Chunks of equal count are in or out together."""
    parts = docs.select(F.explode(F.split(text_of("text"), " ", -1)).alias("chunk"))
    plain = parts.where(F.col("chunk").rlike(r"^[\p{L}\p{N}!-~]\S*$"))
    counts = materialise(plain.groupBy("chunk").agg(F.count("*").alias("c")).where("c > 1"), "chunks")
    least = least_count(counts, words)
    if least is None:
        return []
    return [(" " + c).encode() for c in counts.where(F.col("c") >= least).select("chunk").toPandas()["chunk"]]


@cache
def worker_codec(name: str, ranks_path: str) -> Codec:
    """One codec for all tasks of a worker."""
    return Codec(map_lexicon(SparkFiles.get(name)), byte_ranks(ranks_path))


def portions(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, some at once: at most AT_ONCE characters, or one text."""
    part: list[str] = []
    size = 0
    for t in texts:
        if part and size + len(t) > AT_ONCE:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


ENCODED = StructType([StructField("doc_id", StringType()), StructField("n_tokens", LongType()),
                      StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])


def build_lexicon(docs: DataFrame, words: int, ranks_path: str) -> str:
    """Compile the lexicon of `docs` and send it to the executors; its file name there."""
    lexicon = compile_lexicon(frequent_chunks(docs, words), byte_ranks(ranks_path))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="stray-lexicon-"), name)  # the driver's side of addFile only
    write_lexicon(lexicon, path)
    docs.sparkSession.sparkContext.addFile(path)
    return name


def encode_documents(docs: DataFrame, words: int = 200_000, ranks_path: str | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id, text): id count and digests of ids and decoded text."""
    ranks_path = ranks_path or tokenizer_path("byte_bpe_50k.tiktoken")
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text"))
    bounded_batches(docs.sparkSession)
    name = build_lexicon(docs, words, ranks_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = worker_codec(name, ranks_path)
        for batch in rows_of(batches):
            out = [(len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                    hashlib.sha256(codec.decode_bytes(ids)).hexdigest())
                   for part in portions(batch["text"].tolist()) for ids in codec.encode(part)]
            yield pd.DataFrame(out, columns=ENCODED.names[1:]).assign(doc_id=batch["doc_id"].to_numpy())[ENCODED.names]

    return (docs.select("doc_id", text_of("text").alias("text")).mapInPandas(run, ENCODED)
            .withColumn("doc_id", F.col("doc_id").cast("long")))
