import hashlib
import random

import duckdb
import pytest
from edge import SCHEMA, SF, clashing, documents, edge, none

from stray.llm import line_store as S

BLANKS = " \t\n\r\x0b\x0c"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def key(line):
    return line.strip(BLANKS).translate(LOWER)


def brute(rows, least=3, size=20):
    """(doc_id, n_lines, n_dropped, kept text) of rows (doc_id, text)."""
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    last = {k: max((d for d in ds if d is not None), default=None) for k, ds in holders.items() if len(k) >= size and len(ds) >= least}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def by(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def digests(store, docs):
    return by([tuple(r) for r in store.digests(docs).collect()])


def expected(docs):
    return by([(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute([(r.doc_id, r.text) for r in docs.collect()])])


def through(docs):
    return by([tuple(r) for r in S.line_dedup_query(docs).collect()])


def test_edge_rows_and_extra_columns_equal_brute_force(spark):
    shared = [(50 + i, f" \tÉcoles SHARED line of twenty {i % 2}\x0b\nown {i}", "en", "s", 0) for i in range(9)]
    docs = edge(spark).unionByName(spark.createDataFrame(shared, SCHEMA))
    assert through(docs) == expected(docs)
    assert sum(r[2] for r in through(docs)) == 7
    more = clashing(spark).selectExpr("*", "1 as key", "2 as doc", "3 as gone", "4 as slot", "5 as turn_", "6 as _id", "7 as _t", "8 as shard", "9 as n")
    assert through(more) == expected(more)
    assert through(none(spark)) == []


def test_the_query_equals_its_sql(spark):
    docs = documents(spark)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert through(docs) == by(con.sql(S.LINE_DEDUP_SQL).fetchall()) == expected(docs)


def batch(spark, ids, seed):
    rnd = random.Random(seed)
    lines = [f"Line number {k} that documents share" for k in range(40)]
    rows = [(i, "\n".join([rnd.choice(lines) for _ in range(6)] + [f"a line of its own for {i} only"]), "en", "s", 0) for i in ids]
    return spark.createDataFrame(rows, SCHEMA)


def test_insertion_and_deletion_are_reversible(spark):
    a, b, c = batch(spark, range(30), 1), batch(spark, range(30, 50), 2), batch(spark, [200, 201, None], 3)
    one = S.LineStore.empty(spark).insert(a)
    all_ = one.insert(b).insert(c)
    ab, abc = a.unionByName(b), a.unionByName(b).unionByName(c)
    assert digests(all_, abc) == expected(abc)
    assert digests(all_.insert(a), abc) == expected(abc)  # inserted again: ignored
    assert digests(all_.delete(c), ab) == expected(ab)  # the last holders go, the next ones keep the lines
    back = all_.delete(c).delete(b.unionByName(batch(spark, [999], 4)))  # 999 is unknown
    assert digests(back, a) == expected(a) == digests(one, a)
    assert by([tuple(r) for r in back.counts.select("last", "n", "key").collect()]) == by([tuple(r) for r in one.counts.select("last", "n", "key").collect()])
    cells = lambda s: sorted(x for r in s.filters.collect() for x in S.np.frombuffer(r.cells, "<u2").tolist() if x)
    assert cells(back) == cells(one) and len(cells(one)) == one.counts.where("n >= 3").count()
    assert S.LineStore.empty(spark).delete(a).members is None
    with pytest.raises(ValueError):
        S.LineStore.empty(spark).dropped()


def test_full_filters_split_and_stashes_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_KEYS", 8)
    a, b = batch(spark, range(30), 1), batch(spark, range(30, 60), 5)
    store = S.LineStore.empty(spark).insert(a).insert(b)
    assert store.shards >= 4 and digests(store, a.unionByName(b)) == expected(a.unionByName(b))


def test_dedupe_returns_texts_and_other_columns(spark):
    docs = batch(spark, range(20), 7).selectExpr("*", "'x' as gone", "1 as _row", "2 as key")
    out = S.LineStore.empty(spark).insert(docs).dedupe(docs)
    assert out.columns == docs.columns
    assert by([(r.doc_id, r.text) for r in out.collect()]) == by([(d, t) for d, _, _, t in brute([(r.doc_id, r.text) for r in docs.collect()])])


def test_filter_never_loses_a_key_and_forgets_deleted_ones(monkeypatch):
    monkeypatch.setattr(S, "BUCKETS", 64)
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(400)]
    f = S.CuckooFilter()
    f.insert(keys)  # more than the 256 cells: the rest is in the stash
    assert f.holds(keys).all() and f.stash
    f = S.CuckooFilter(*f.row())
    f.delete(keys[:350])
    assert f.holds(keys[350:]).all() and sum(map(bool, f.cells)) + len(f.stash) == 50
    f.delete(keys[350:])
    assert not any(f.cells) and not f.stash and not f.holds(keys).any()


def test_false_positives_are_few():
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(60_000)]
    f = S.CuckooFilter()
    f.insert(keys[:S.SHARD_KEYS])
    assert not f.stash and f.holds(keys[S.SHARD_KEYS:]).mean() < 0.001
