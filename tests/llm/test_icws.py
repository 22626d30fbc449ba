import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import SCHEMA, clashing, documents, edge, none

from stray.llm import icws as N
from stray.llm.common import batch_word_hashes, mixed, shingle_hashes


def brute_groups(rows, p):
    """{doc: least doc of its group} by comparing all pairs of distinct texts that share a shingle."""
    by_text = defaultdict(list)
    for doc, text in rows:
        by_text[" ".join((text or "").lower().split())].append(doc)
    texts = [t for t in by_text if t]
    bags = [np.unique(shingle_hashes(h, 5), return_counts=True) for h in batch_word_hashes([t.encode() for t in texts])]
    seen, df = np.unique(np.concatenate([b[0] for b in bags]), return_counts=True)
    n = len(by_text) - ("" in by_text) + len(by_text.get("", []))
    often = df > max(2.0, p.floor * n)
    w = N.Weights(seen[often], df[often], n, p.floor)
    weighted = [(h, w.of(h, c)) for h, c in bags]
    parent = {t: t for t in texts}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    holders = defaultdict(list)
    for i, (h, _) in enumerate(bags):
        for x in h.tolist():
            holders[x].append(i)
    pairs = {(i, j) for own in holders.values() for a, i in enumerate(own) for j in own[a + 1:]}
    links = {(i, j) for i, j in pairs if N.weighted_jaccard(weighted[i], weighted[j]) >= p.similarity}
    for i, j in links:
        parent[root(texts[i])] = root(texts[j])
    groups = defaultdict(list)
    for t in texts:
        groups[root(t)] += by_text[t]
    out = {d: min(g) for g in groups.values() for d in g}
    return out | {d: d for d in by_text.get("", [])}


def families(n=30, size=12, words=200, edits=6, seed=2):
    rnd = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(4000)]
    rows = []
    for f in range(n):
        base = [rnd.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rnd.randint(0, edits)):
                own[rnd.randrange(words)] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(own), "en", "s", 0))
    return rows


def test_groups_equal_brute_force(spark):
    rows = families()
    docs = spark.createDataFrame(rows, SCHEMA)
    want = brute_groups([r[:2] for r in rows], N.NearDup())
    got = {r.doc_id: r.group_id for r in N.near_duplicates(docs).collect()}
    assert sum(got[d] != want[d] for d in want) <= 0.01 * len(want)


def test_documents_by_brute_force(spark):
    docs = documents(spark, "/root/testdata/sf0.01").where("n_chars < 8000")
    want = brute_groups([(r.doc_id, r.text) for r in docs.collect()], N.NearDup())
    out = N.near_duplicates(docs).collect()
    assert {r.doc_id: r.group_id for r in out} == want
    assert all(r.kept == (r.doc_id == r.group_id) for r in out)


def test_samples_agree_by_weighted_jaccard():
    p, rng = N.NearDup(bands=64, rows=1), np.random.default_rng(0)
    sampler, agree, true = N.Sampler(p), [], []
    for _ in range(60):
        h = mixed(rng.integers(0, 2 ** 62, 300).astype(np.uint64))
        a, b = (np.sort(h[:260]), rng.uniform(1, 9, 260)), (np.sort(h[60:]), rng.uniform(1, 9, 240))
        agree.append((sampler.bands(*a) == sampler.bands(*b)).mean())
        true.append(N.weighted_jaccard(a, b))
    assert np.mean(agree) == pytest.approx(np.mean(true), abs=0.02)


def test_a_group_of_many_copies_and_a_chain_of_rounds(spark):
    rows = families(n=1, size=400, words=120, edits=3) + [(1000 + i, "exact copy of one text with words enough", "en", "s", 0) for i in range(300)]
    out = N.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    groups = {r.doc_id: r.group_id for r in out}
    assert {groups[1000 + i] for i in range(300)} == {1000}
    want = brute_groups([r[:2] for r in rows[:400]], N.NearDup())
    assert sum(groups[d] != want[d] for d in want) <= 2
    assert sum(r.kept for r in out) == len(set(groups.values()))


def test_edges(spark):
    out = N.near_duplicates(edge(spark)).collect()
    assert len(out) == edge(spark).count()
    assert sum(r.kept for r in out if r.doc_id == 6) == 1 and not any(r.kept for r in out if r.doc_id == 7)
    assert all(r.kept for r in out if r.doc_id in (1, 2, 4))
    assert N.near_duplicates(none(spark)).count() == 0
    docs = clashing(spark)
    stage = N.near_dup_stage(docs)
    assert stage.columns == docs.columns and stage.count() == sum(r.kept for r in out)


def test_every_shingle_weighs_by_its_document_frequency(spark, monkeypatch):
    monkeypatch.setattr(N, "UNIT", 300)  # many units and ranges
    monkeypatch.setattr(N, "RANGE", 500)
    rows = families(n=20, size=6, words=60) + [(500 + i, f"a passage in all of these texts and then t{i}", "en", "s", 0) for i in range(30)]
    rows += [(900, None, "en", "s", 0), (901, " ", "en", "s", 0)]
    texts = {r[1] for r in rows if (r[1] or "").strip()}
    n, p = len(texts) + 2, N.NearDup()
    count = Counter(h for t in texts for h in shingle_hashes(batch_word_hashes([t.encode()])[0], 5).tolist())
    classes = N.class_table(N.keyed(spark.createDataFrame(rows, SCHEMA)))
    sums = N.bucket_sums(classes)
    weights = N.Weights(*N.common_shingles(classes, n, p, sums), n, p.floor)
    assert 0 < len(weights.shingles) < 30 and classes.count() == n
    got = classes.join(N.own_frequencies(classes, weights.shingles, n, p, int(sums.sum())), "cls").collect()
    assert len(got) == n
    seen = set()
    for r in got:
        ((h, times),) = N.shingles_of([r.z])
        df = np.array([max(2, count[x]) for x in h.tolist()])
        assert weights.of(h, times, r.own) == pytest.approx(times * (1 + np.log(n / df)))
        seen |= set(df.tolist())
    assert len(seen) >= 5


def test_shingles_of_a_batch_are_not_held_at_once(monkeypatch):
    import zstandard
    monkeypatch.setattr(N, "WORDS_BYTES", 20)
    read = []

    def packed():
        for k in range(6):
            read.append(k)
            yield zstandard.ZstdCompressor().compress(f"one two three four five six w{k}".encode())

    cut = iter(N.shingles_of(packed()))
    assert len(next(cut)[0]) == 3 and read == [0]
    assert [len(h) for h, _ in cut] == [3] * 5 and len(read) == 6


def test_no_table_holds_the_pairs_of_a_bucket(spark, monkeypatch):
    """Near copies that are not near enough to be one group: what is written grows with the texts, not with their pairs."""
    rows = families(n=1, size=400, words=400, edits=9, seed=4)
    sizes, write = Counter(), N.materialise

    def counted(df, name):
        out = write(df, name)
        sizes[name] = max(sizes[name], out.count())
        return out

    monkeypatch.setattr(N, "materialise", counted)
    want = None
    for local in (N.LOCAL, 1 << 13):  # in one task, and in rounds over lots
        monkeypatch.setattr(N, "LOCAL", local)
        got = sorted(tuple(r) for r in N.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
        want = want or got
        assert got == want
    assert len({r[1] for r in want}) > 100 and sum(r[2] for r in want) > 0
    assert max(sizes.values()) == sizes["pairs-of-bands"] < 20 * len(rows)


def test_large_clusters_go_in_lots_and_give_the_same_links(spark, monkeypatch):
    rows = families(n=3, size=120, words=100, edits=5, seed=6) + families(n=4, size=5)
    rows = [(i, *r[1:]) for i, r in enumerate(rows)] + [(900, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(tuple(r) for r in N.near_duplicates(docs).collect())
    assert sum(r[2] for r in want) > 100
    lots = []
    of = N.Rounds.__init__

    def seen(self, large, *rest):
        lots.extend(r.lots for r in large.collect())
        of(self, large, *rest)

    monkeypatch.setattr(N.Rounds, "__init__", seen)
    monkeypatch.setattr(N, "LOCAL", 1 << 14)
    assert sorted(tuple(r) for r in N.near_duplicates(docs).collect()) == want
    assert max(lots) > 2


def test_bound_loses_no_link():
    from types import SimpleNamespace
    from zstandard import ZstdCompressor
    rows = families(n=2, size=40, words=200, edits=6, seed=8)
    texts = sorted({r[1] for r in rows})
    bags = [np.unique(shingle_hashes(h, 5), return_counts=True) for h in batch_word_hashes([t.encode() for t in texts])]
    seen, df = np.unique(np.concatenate([b[0] for b in bags]), return_counts=True)
    w = N.Weights(seen[df > 2], df[df > 2], len(texts), 0.0)
    c = N.Cluster([SimpleNamespace(cls=f"{i:03d}", rank=i / 100, z=ZstdCompressor().compress(t.encode()), own=b"", buckets=[0])
                   for i, t in enumerate(texts)], w, N.NearDup())
    links = 0
    for i in range(len(texts)):
        others = np.arange(i + 1, len(texts))
        want = [j for j in others if N.weighted_jaccard(c.bags[i], c.bags[j]) >= 0.8]
        assert c.near(i, others).tolist() == want if len(others) else not want
        links += len(want)
    assert 20 < links < 2 * 40 * 39 // 2
