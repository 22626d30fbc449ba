"""Conversation structure repair by grammar-compressed dynamic programming.

A row of a conversation is one of nine symbols: what its role begins with, whether it is
truncated, and whether it has to go (blank, or a repetition). Cheapest edits that give the
roles `(s?(ua)+)?` are a shortest path through four states (start, after s, after u, after
a), so a symbol is a 4 x 4 matrix whose entries are (cost, audit), multiplied min-plus;
equal costs are decided by the audit. Two audits of the same rows at equal cost are never
prefixes of each other (an insertion costs), so the order survives concatenation and the
product is associative: a conversation may be cut anywhere and multiplied in any order.

Re-Pair makes a grammar of all role/fault sequences at once: Spark counts the adjacent
pairs of the distinct sequences, weighted by their conversations, the most frequent ones
become rules, and again. The grammar (at most rounds x rules, whatever the data) has one
matrix per rule, made bottom-up from the matrices of its two halves with audits as ropes.
Tasks rewrite their sequences by the grammar and multiply the few symbols that are left.

Rows are dealt by ranges of (conversation, turn, role, text digest), so a conversation
with a third of all rows lies in many tasks. A conversation inside one task and one chunk
is repaired there; of all others only matrices are passed on, multiplied in order, and the
audits go back to the chunks. What a chunk holds is bounded; an audit and a digest belong
to one result row, so their streaming is as long as that conversation, with bounded memory
for the digest.

Defined cases: null ids are one conversation; null turns come first; rows of equal turn
are ordered by role, then by a digest of the text; other columns are not read; an empty
table gives no rows; a conversation without rows after the damage has zeros, an empty
audit and the digest of the empty string.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stray.llm.common import SPACES, bounded_batches, materialise

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: start, after s, after u, after a. A sequence may end at the start or after a.
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
STATES, ENDS = 4, (0, 3)
#: Symbol 0 has to go; 1 + 2 * (place in KINDS) + truncated are the others.
KINDS = ("s", "u", "a", "")
FIRST, RULE = ord("a"), 0x4E00
CHUNK_ROWS, CHUNK_BYTES = 2048, 1 << 20
LEGAL = {"su", "ua", "au"}


@dataclass(frozen=True)
class Grammar:
    """How many rounds, and how many rules a round, Re-Pair may take."""

    rounds: int = 6
    rules: int = 32


# ---------------------------------------------------------------- matrices


class Rope:
    """An audit as a tree of parts, written out when it is compared or returned."""

    __slots__ = ("parts", "text")

    def __init__(self, text: str | None, parts: tuple[Rope, Rope] | None = None) -> None:
        self.text, self.parts = text, parts

    def __str__(self) -> str:
        if self.text is None:
            out, stack = [], [self]
            while stack:
                rope = stack.pop()
                if rope.text is None:
                    stack += rope.parts[::-1]
                else:
                    out.append(rope.text)
            self.text, self.parts = "".join(out), None
        return self.text


EMPTY = Rope("")
#: A matrix has a row for each state; an entry is (cost, audit), or None where there is no way.
Matrix = list


def joined(a: Rope, b: Rope) -> Rope:
    return b if a.text == "" else a if b.text == "" else Rope(None, (a, b))


def better(x: tuple | None, y: tuple | None) -> tuple | None:
    if x is None or y is None:
        return x or y
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return x if str(x[1]) <= str(y[1]) else y


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: the best way over all middle states."""
    out = []
    for row in a:
        line = []
        for j in range(len(b[0])):
            best, ties = None, []
            for x, to in zip(row, b):
                if x is None or to[j] is None:
                    continue
                cost = x[0] + to[j][0]
                if best is None or cost < best:
                    best, ties = cost, [(x[1], to[j][1])]
                elif cost == best:
                    ties.append((x[1], to[j][1]))
            ropes = [joined(p, q) for p, q in ties]
            line.append(None if best is None else (best, ropes[0] if len(ropes) == 1 else min(ropes, key=str)))
        out.append(line)
    return out


def no_way() -> Matrix:
    return [[None] * STATES for _ in range(STATES)]


def identity() -> Matrix:
    out = no_way()
    for i in range(STATES):
        out[i][i] = (0, EMPTY)
    return out


def insertions() -> Matrix:
    """Any number of inserted rows; more than two never help."""
    one = identity()
    for sign in "ua":
        for i, j in STEPS[sign].items():
            one[i][j] = better(one[i][j], (INSERT, Rope("I")))
    return times(one, one)


def symbol_matrix(symbol: int) -> Matrix:
    """Insertions before the row, then the row kept, given another role, or deleted."""
    row = no_way()
    for i in range(STATES):
        row[i][i] = (DELETE, Rope("D"))
    if symbol:
        kind, more = KINDS[(symbol - 1) // 2], TRUNCATED * ((symbol - 1) % 2)
        for i, j in STEPS.get(kind, {}).items():
            row[i][j] = better(row[i][j], (KEEP + more, Rope("K")))
        for sign in "ua":
            for i, j in STEPS[sign].items():
                row[i][j] = better(row[i][j], (REROLE + more, Rope("R")))
    return times(insertions(), row)


def plain(matrix: Matrix) -> Matrix:
    """Audits as strings, to be sent."""
    return [[None if e is None else (e[0], Rope(str(e[1]))) for e in row] for row in matrix]


def rewritten(sequence: str, rules: list[str]) -> str:
    """The sequence with the rules applied in their order, each from left to right."""
    for k, pair in enumerate(rules):
        if len(sequence) > 1:
            sequence = sequence.replace(pair, chr(RULE + k))
    return sequence


def matrices(rules: list[str]) -> dict[str, Matrix]:
    """One matrix per terminal and per rule, bottom-up."""
    out = {chr(FIRST + i): symbol_matrix(i) for i in range(2 * len(KINDS) + 1)}
    for k, (left, right) in enumerate(rules):
        out[chr(RULE + k)] = plain(times(out[left], out[right]))
    return out


def product(sequence: str, rules: list[str], known: dict[str, Matrix]) -> Matrix:
    """The matrix of a sequence, its symbols multiplied as a balanced tree."""
    line = [known[c] for c in rewritten(sequence, rules)]
    while len(line) > 1:
        line = [times(*line[i:i + 2]) if i + 1 < len(line) else line[i] for i in range(0, len(line), 2)]
    return line[0] if line else identity()


def chosen(matrix: Matrix) -> tuple[int, str]:
    """Cost and audit of the whole, insertions at the end included."""
    last = times([matrix[0]], insertions())[0]
    best = None
    for j in ENDS:
        best = better(best, last[j])
    return best[0], str(best[1])


# ---------------------------------------------------------------- rows


def damaged_rows(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, gone): rows after the damage; a row that is dropped stays as a mark of its conversation."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    own = rows.select(F.col("conv_id").alias("conv"), "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                      F.coalesce(F.col("text").cast("string"), blank).alias("text"), (F.crc32(key) % 20).alias("c"))
    c = F.col("c")
    text = F.when(c <= 1, F.lit("")).when(c == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    changed = own.select("conv", F.when(c != 0, F.col("turn")).alias("turn"),
                         F.when(c == 0, F.lit("")).when(c == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                         (c == 0).alias("gone"), F.explode(F.sequence(F.lit(1), F.when(c == 3, F.lit(2)).otherwise(F.lit(1)))).alias("copy"))
    return changed.drop("copy")


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Rows in order within and across partitions, with digests of role and text and whether the turn is the first to say so."""
    h = F.xxhash64("conv", "gone", "role", "text")
    own = rows.select("*", h.alias("h1"), F.xxhash64(F.lit(1), "text", "role", "gone", "conv").alias("h2"))
    firsts = own.groupBy("h1", "h2").agg(F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("unknown"))
    first = F.when(F.col("unknown"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("least"))
    at = [F.col("conv").asc_nulls_first(), (~F.col("gone")).asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("h1").asc()]
    return (own.join(firsts, ["h1", "h2"]).select("conv", "gone", "turn", "role", "text", "h1", "h2", first.alias("first"))
            .repartitionByRange(*at).sortWithinPartitions(*at, "h2"))


def last_sign(text: str) -> str:
    return text.rstrip(SPACES)[-1:]


class Chunk:
    """Rows of one conversation that follow each other in one task, and their figures."""

    def __init__(self, conv, chunk: int) -> None:
        self.conv, self.chunk, self.seq, self.roles, self.texts, self.bytes = conv, chunk, [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.before = None

    def add(self, turn, role: str, text: str, first: bool) -> None:
        sign = last_sign(text)
        if not sign:
            self.blank += 1
            symbol = 0
        elif not first:
            self.duplicate += 1
            symbol = 0
        else:
            cut = sign not in ".!?"
            self.truncated += cut
            kind = role[:1] if role[:1] in ("s", "u", "a") else ""
            symbol = 1 + 2 * KINDS.index(kind) + cut
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.roles and self.roles[-1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.seq.append(chr(FIRST + symbol))
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)

    def full(self) -> bool:
        return len(self.seq) >= CHUNK_ROWS or self.bytes >= CHUNK_BYTES


CHUNKS = ("chunk long, seq string, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, "
          "illegal long, turns long, low long, high long, whole boolean")
FIGURES = tuple(f.split()[0] for f in CHUNKS.split(", "))


def chunks_of(rows: DataFrame) -> DataFrame:
    """(conv, part, chunk, seq, roles, texts, figures, whole): the rows of each conversation, cut into bounded
    chunks; `whole` where a chunk surely is its conversation."""
    kind = rows.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", kind)] + T.StructType.fromDDL(CHUNKS).fields)
    arrow = pa.schema([("chunk", pa.int64()), ("seq", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
                      + [(c, pa.int64()) for c in FIGURES[4:-1]] + [("whole", pa.bool_())])

    def written(done: list[tuple[Chunk, bool]], kind: pa.DataType) -> pa.RecordBatch:
        cols = [pa.array([c.conv for c, _ in done], kind), pa.array([c.chunk for c, _ in done], pa.int64()),
                pa.array(["".join(c.seq) for c, _ in done], pa.string())]
        cols += [pa.array([getattr(c, f) for c, _ in done], arrow.field(f).type) for f in FIGURES[2:-1]]
        return pa.RecordBatch.from_arrays([*cols, pa.array([w for _, w in done], pa.bool_())], ["conv", *FIGURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, began, done, size, kind, before = None, 0, 0, [], 0, None, None
        for batch in batches:
            kind = batch.schema.field("conv").type
            for r in batch.to_pylist():
                if now is None or r["conv"] != now.conv or now.full():
                    if now is not None:
                        # the first and last conversation of a task may go on in others
                        done.append((now, began > 0 and r["conv"] != now.conv and now.chunk == began))
                        size += now.bytes
                        if size >= 4 * CHUNK_BYTES or len(done) >= 2048:
                            yield written(done, kind)
                            done, size = [], 0
                        number += 1
                    if now is not None and r["conv"] != now.conv:
                        began = number
                    now = Chunk(r["conv"], number)
                if not r["gone"]:
                    same = (r["conv"], r["turn"], r["role"], r["h1"], r["h2"])  # equal rows are in one task, one after another
                    now.add(r["turn"], r["role"], r["text"], r["first"] and same != before)
                    before = same
        if now is not None:
            yield written([*done, (now, False)], kind)

    out = rows.select("conv", "gone", "turn", "role", "text", "h1", "h2", "first").mapInArrow(run, schema)
    return out.select(F.spark_partition_id().alias("part"), "*")


def repair_grammar(chunks: DataFrame, g: Grammar = Grammar()) -> list[str]:
    """Re-Pair over the distinct sequences: each rule is a pair of symbols."""
    seqs = materialise(chunks.groupBy("seq").agg(F.count("*").alias("n")), "sequences")
    rules: list[str] = []
    for _ in range(g.rounds):
        now = list(rules)

        def pairs(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()  # bounded by the square of the alphabet
            for batch in batches:
                for seq, n in zip(batch.column("seq").to_pylist(), batch.column("n").to_pylist()):
                    seq, last = rewritten(seq, now), -2
                    for i in range(len(seq) - 1):
                        if not (i == last + 1 and seq[i] == seq[i + 1] == seq[i - 1]):  # aaa is one pair
                            found[seq[i:i + 2]] += n
                            last = i
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["pair", "n"])

        top = (seqs.mapInArrow(pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
               .orderBy(F.desc("n"), "pair").limit(g.rules).collect())
        if not top:
            break
        rules += [r.pair for r in top]
    return rules


# ---------------------------------------------------------------- repair


def repaired(audit: str, roles: list[str], texts: list[str], at: int, odd: bool) -> list[str]:
    """The lines `role:text` that the audit leaves; `at` lines stand before, and `odd` tells of a system row."""
    out, row = [], 0
    for edit in audit:
        if edit == "D":
            row += 1
            continue
        role = "user" if (at + len(out)) % 2 == odd else "assistant"
        if edit == "I":
            out.append(f"{role}:")
            continue
        out.append(f"{roles[row] if edit == 'K' else role}:{texts[row]}")
        row += 1
    return out


def kept(audit: str) -> int:
    return len(audit) - audit.count("D")


def gaps(low, high, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, (1 << 63) - 1)


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def result_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv_id", kind)] + [T.StructField(c, T.LongType()) for c in RESULT]
                        + [T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def whole_conversations(chunks: DataFrame, rules: list[str]) -> DataFrame:
    """The results of conversations that lie in one chunk."""
    schema = result_schema(chunks.schema["conv"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = matrices(rules), {}
        for batch in batches:
            rows = []
            for r in batch.select(["seq", "roles", "texts", *FIGURES[4:-1]]).to_pylist():
                if r["seq"] not in seen:
                    if len(seen) >= 50_000:
                        seen.clear()
                    seen[r["seq"]] = chosen(product(r["seq"], rules, known))
                cost, audit = seen[r["seq"]]
                lines = repaired(audit, r["roles"], r["texts"], 0, kept(audit) % 2 == 1)
                rows.append((gaps(r["low"], r["high"], r["turns"]), r["blank"], r["duplicate"], r["truncated"], r["illegal"], cost,
                             audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
            cols = list(zip(*rows)) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), *[pa.array(c, pa.int64()) for c in cols[:6]], *[pa.array(c, pa.string()) for c in cols[6:]]], schema.names)

    return chunks.mapInArrow(run, schema)


def same(a, b) -> bool:
    return a is b or a == b


def cut_conversations(chunks: DataFrame, rules: list[str]) -> DataFrame:
    """The results of conversations that lie in several chunks or may do so."""
    kind = chunks.schema["conv"].dataType
    place = ["conv", "part", "chunk"]
    cells = "array<struct<cost:long,audit:string>>"

    def evaluated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = matrices(rules)
        for batch in batches:
            out = [[None if e is None else {"cost": e[0], "audit": str(e[1])} for row in product(s, rules, known) for e in row]
                   for s in batch.column("seq").to_pylist()]
            cell = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, cell)], [*batch.schema.names, "cells"])

    own = chunks.select("conv", "part", "chunk", "seq", F.get("roles", F.lit(0)).alias("r1"), F.element_at(
        F.when(F.size("roles") > 0, F.col("roles")), -1).alias("r2"), *FIGURES[4:-1])
    matrix = own.mapInArrow(evaluated, T.StructType([*own.schema.fields, T.StructField("cells", T.StructType.fromDDL(f"c {cells}")["c"].dataType)]))
    # the chunks of a conversation in order: only matrices and figures, no texts
    line = matrix.withColumn("rows", F.char_length("seq")).drop("seq").repartition("conv").sortWithinPartitions(*place)
    schema = T.StructType([*result_schema(kind).fields[:-1], T.StructField("part", T.IntegerType()), T.StructField("chunk", T.LongType()),
                           T.StructField("piece", T.StringType()), T.StructField("at", T.LongType()), T.StructField("odd", T.BooleanType())])

    def ended(conv, v: Matrix, f: dict, parts: list[tuple]) -> Iterator[dict]:
        """A row for each chunk with its piece of the audit; the first has the figures too."""
        cost, audit = chosen(v * STATES)
        odd, i, at = kept(audit) % 2 == 1, 0, 0
        for k, (part, chunk, rows) in enumerate(parts):
            j = i
            while rows and j < len(audit):
                rows -= audit[j] != "I"
                j += 1
            j = len(audit) if k + 1 == len(parts) else j
            first = {c: f[c] for c in RESULT[1:5]} | {"gaps": gaps(f["low"], f["high"], f["turns"]), "cost": cost, "audit": audit}
            yield ({"conv_id": conv, "part": part, "chunk": chunk, "piece": audit[i:j], "at": at, "odd": odd}
                   | (first if not k else dict.fromkeys(first)))
            i, at = j, at + kept(audit[i:j])

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, v, f, parts, arrow = None, None, {}, [], None
        for batch in batches:
            arrow = pa.schema([("conv_id", batch.schema.field("conv").type), *[(c, pa.int64()) for c in RESULT], ("audit", pa.string()),
                               ("part", pa.int32()), ("chunk", pa.int64()), ("piece", pa.string()), ("at", pa.int64()), ("odd", pa.bool_())])
            for r in batch.to_pylist():
                if v is None or not same(now, r["conv"]):
                    if v is not None:
                        yield pa.RecordBatch.from_pylist(list(ended(now, v, f, parts)), arrow)
                    now, v, parts = r["conv"], identity()[:1], []
                    f = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0) | {"low": None, "high": None, "r2": None}
                flat = [None if e is None else (e["cost"], Rope(e["audit"])) for e in r["cells"]]
                v = [[None if e is None else (e[0], Rope(str(e[1]))) for e in times(v, [flat[i:i + STATES] for i in range(0, len(flat), STATES)])[0]]]
                for c in ("blank", "duplicate", "truncated", "illegal", "turns"):
                    f[c] += r[c]
                if r["low"] is not None:
                    f["turns"] -= r["low"] == f["high"]
                    f["low"], f["high"] = r["low"] if f["low"] is None else f["low"], r["high"]
                if r["rows"]:
                    if f["r2"] is not None and f["r2"][:1] + r["r1"][:1] not in LEGAL:
                        f["illegal"] += 1
                    f["r2"] = r["r2"]
                parts.append((r["part"], r["chunk"], r["rows"]))
        if v is not None:
            yield pa.RecordBatch.from_pylist(list(ended(now, v, f, parts)), arrow)

    pieces = materialise(line.mapInArrow(combined, schema), "audit-pieces")
    texts = chunks.select("part", "chunk", "roles", "texts")
    # (part, chunk) names a chunk; the digest runs over the pieces of a conversation in order
    dealt = pieces.join(texts, ["part", "chunk"]).repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, any_ = None, hashlib.sha256(), False
        arrow = None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([head | {"repaired_sha256": digest.hexdigest()}], arrow)

        for batch in batches:
            arrow = pa.schema([*[batch.schema.field(c) for c in ("conv_id", *RESULT, "audit")], ("repaired_sha256", pa.string())])
            for r in batch.to_pylist():
                if r["cost"] is not None:  # the first chunk of a conversation
                    if head is not None:
                        yield row()
                    head, digest, any_ = {c: r[c] for c in ("conv_id", *RESULT, "audit")}, hashlib.sha256(), False
                for said in repaired(r["piece"], r["roles"], r["texts"], r["at"], r["odd"]):
                    digest.update(("\n" if any_ else "").encode() + said.encode())
                    any_ = True
        if head is not None:
            yield row()

    return dealt.select("conv_id", *RESULT, "audit", "piece", "at", "odd", "roles", "texts").mapInArrow(digested, result_schema(kind))


def repair_conversations(rows: DataFrame, g: Grammar = Grammar()) -> DataFrame:
    """Repair of rows (conv, turn, role, text, gone): one result for each conversation."""
    bounded_batches(rows.sparkSession)
    chunks = materialise(chunks_of(ordered_rows(rows)), "chunks")
    rules = repair_grammar(chunks, g)
    return whole_conversations(chunks.where("whole"), rules).unionByName(cut_conversations(chunks.where("not whole"), rules))


def dialogue_query(conversations: DataFrame) -> DataFrame:
    """Repair of every conversation after the contract's damage."""
    return repair_conversations(damaged_rows(conversations.select("conv_id", "turn", "role", "text")))
