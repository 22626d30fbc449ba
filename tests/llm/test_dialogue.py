import hashlib
import heapq
import random
import zlib

from edge import SF

from stray.llm import dialogue as D

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\r\x0b\x0c"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        say = lambda x: " " if x is None else str(x)
        c = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        if c == 0:
            continue
        if c == 1:
            text = ""
        if c == 2:
            text = "".join(s for s in text if s not in ".!?")
        if c == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if c == 3 else 1)
    return out


def cheapest(symbols):
    """Dijkstra over (row, state) by cost and audit; symbols are (initial, gone, truncated)."""
    steps = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(symbols) and state in (0, 3):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        for sign in "ua":
            if state in steps[sign]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, steps[sign][state]))
        if i < len(symbols):
            initial, gone, cut = symbols[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if not gone:
                if state in steps.get(initial, {}):
                    heapq.heappush(heap, (cost + 3 * cut, audit + "K", i + 1, steps[initial][state]))
                for sign in "ua":
                    if state in steps[sign]:
                        heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", i + 1, steps[sign][state]))


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    counts, seen, symbols = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for turn, role, text in rows:
        bare = text.strip(BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = cheapest(symbols)
    length = len(audit) - audit.count("D")
    pattern = (["system"] if length % 2 else []) + ["user", "assistant"] * (length // 2)
    lines, i = [], 0
    for edit in audit:
        if edit == "I":
            lines.append(pattern[len(lines)] + ":")
        else:
            if edit != "D":
                lines.append((rows[i][1] if edit == "K" else pattern[len(lines)]) + ":" + rows[i][2])
            i += 1
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    return {k: brute(damage(v)) for k, v in by.items()}


def got(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def odd_rows(n, seed=5):
    """Conversations of awkward rows; no two rows of a conversation have one turn and role but different texts."""
    rnd, rows = random.Random(seed), []
    for conv in range(n):
        turn = rnd.choice([0, 1, -3])
        for _ in range(rnd.randint(1, 9)):
            turn += rnd.choice([1, 1, 1, 2, 7])
            rows.append((conv, turn, rnd.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
                         rnd.choice(["One.", "One.", "cut", " \t", "", None, "Two!", "drei? ", "é. ", f"own {conv} {turn}."])))
    return rows


def test_conversations_equal_brute_force(spark):
    rows = odd_rows(600)
    rows += [(None, i, "user", f"t{i}.") for i in range(5)] + [(9_000, None, "user", "a."), (9_000, 3, "assistant", "b.")]
    rows += [(9_001, None, "user", "a."), (9_002, 5, "system", "x")]
    want = expected(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(D.dialogue_query(df)) == want
    assert len({w[5] for w in want.values()}) > 10


def test_a_table_and_copies_of_rows(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    want = expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    extra = table.selectExpr("*", "1 as conv", "2 as gone", "3 as part", "4 as first", "5 as c", "6 as cost", "7 as seq")
    assert got(D.dialogue_query(extra)) == want
    twice = table.unionByName(table)
    want = expected([tuple(r) for r in twice.select("conv_id", "turn", "role", "text").collect()])
    assert got(D.dialogue_query(twice)) == want
    assert D.dialogue_query(table.limit(0)).count() == 0


def test_a_conversation_over_many_chunks_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(D, "CHUNK_ROWS", 7)
    rnd = random.Random(2)
    rows = [(1, i + (i > 300), rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice(["same.", f"u{i}.", f"v{i}", " "]))
            for i in range(600)]
    rows += [(2, i, "user" if i % 2 else "assistant", "x" * 3000 + f"{i}.") for i in range(50)] + odd_rows(20)[:90]
    rows = [r for r in rows if r[0] != 0]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(D.dialogue_query(df)) == expected(rows)


def test_every_conversation_at_the_edge_of_a_task(spark):
    """More partitions than conversations: chunks of one row, and chunks whose rows were all dropped."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "61"}
    before = {k: spark.conf.get(k) for k in conf}
    rows = odd_rows(25, seed=9)
    rows += [(conv, turn, "user", "x.") for conv in range(100, 140) for turn in range(9) if zlib.crc32(f"{conv}:{turn}".encode()) % 20 == 0]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert got(D.dialogue_query(spark.createDataFrame(rows, SCHEMA))) == expected(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rules_change_no_product():
    rnd, known = random.Random(1), {}
    signs = [chr(D.FIRST + i) for i in range(9)]
    for _ in range(300):
        seq = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 14)))
        rules = ["".join(rnd.choice(signs) for _ in range(2)) for _ in range(3)]
        rules.append(chr(D.RULE) + chr(D.RULE + 1))
        symbols = [("" if not s else D.KINDS[(s - 1) // 2], not s, bool(s) and (s - 1) % 2 == 1) for s in (ord(c) - D.FIRST for c in seq)]
        assert D.chosen(D.product(seq, rules, D.matrices(rules))) == D.chosen(D.product(seq, [], D.matrices([]))) == cheapest(symbols)


def test_the_grammar_shares_frequent_pairs(spark):
    chunks = spark.createDataFrame([("dfdfdf",)] * 5 + [("bdf",)] * 3 + [("h",)], "seq string")
    rules = D.repair_grammar(chunks, D.Grammar(rounds=2, rules=1))
    assert rules == ["df", chr(D.RULE) * 2] and D.rewritten("dfdfdf", rules) == chr(D.RULE + 1) + chr(D.RULE)
