import hashlib

import numpy as np
import pytest
from edge import SCHEMA, SF, clashing, documents, edge, none

from stray.llm import fracsketch as S
from stray.llm.common import batch_word_hashes, shingle_hashes


def words_of(text):
    return batch_word_hashes([text.encode()])[0]


def test_documents_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "RANGE_BYTES", 40_000)  # many ranges
    rows = sorted(((r.doc_id, r.text) for r in documents(spark, SF).collect()), reverse=True)
    got = {r.doc_id: r for r in S.fingerprints(documents(spark, SF).repartition(7)).collect()}
    assert len(got) == len(rows)
    for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        new = S.edited(text, following)
        a, b, c = ((words_of(t), S.sketch(words_of(t))) for t in (text, new, following))
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (S.fingerprint(*a), S.fingerprint(*b))
        assert (r.near_edited, r.near_next) == (S.nearness(a, b), S.nearness(a, c))
        assert len(a[1]) == 0 or (r.fingerprint, r.near_next) == (S.as_text(a[1]), S.likeness(a[1], c[1]) if len(c[1]) else r.near_next)


def test_estimates_containment_of_unequal_texts():
    rng = np.random.default_rng(1)
    pool = [f"w{i}".encode() for i in range(200_000)]
    big = b" ".join(pool[i] for i in rng.permutation(100_000))
    parts = big.split()
    mixed = b" ".join(parts[2000:6000] + pool[100_000:104_000])
    a, b = S.sketch(batch_word_hashes([big])[0]), S.sketch(batch_word_hashes([mixed])[0])
    x, y = (set(shingle_hashes(batch_word_hashes([t])[0], 5).tolist()) for t in (big, mixed))
    assert S.likeness(a, b) == pytest.approx(len(x & y) / len(y), abs=0.05)
    left, right = b" ".join(parts[:500]), b" ".join(parts[496:1000])
    halves = S.merge(*(S.sketch(batch_word_hashes([t])[0]) for t in (left, right)))
    assert (halves == S.sketch(batch_word_hashes([b" ".join(parts[:1000])])[0])).all()


def test_short_texts_of_different_words_differ(spark):
    rows = [(i, f"short text number {i} here", "en", "s", 0) for i in range(200)] + [(500, "short text number 7 here", "en", "s", 0)]
    out = {r.doc_id: r for r in S.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len({r.fingerprint for d, r in out.items() if d < 200}) == 200 and out[500].fingerprint == out[7].fingerprint
    assert all(out[i].near_next == 0.0 for i in range(1, 200)) and out[0].near_next == 0.0
    empty = [i for i in range(200) if out[i].fingerprint.startswith("words:")]
    assert len(empty) > 100
    long = " ".join(f"w{i}" for i in range(2000))
    inside = spark.createDataFrame([(2, "w7 w8 w9 w10 w11 w12", "en", "s", 0), (1, long, "en", "s", 0)], SCHEMA)
    got = {r.doc_id: r.near_next for r in S.fingerprints(inside).collect()}
    assert got[2] == 1.0 and got[1] in (1.0, 0.0)  # all shingles count where a sketch is empty


def test_edges(spark):
    out = S.fingerprints(edge(spark)).collect()
    assert len(out) == edge(spark).count()
    assert len({r.fingerprint for r in out if r.doc_id == 6}) == 1
    assert {r.fingerprint for r in out if r.doc_id in (1, 2, 4)} == {""} and all(r.fingerprint for r in out if r.doc_id == 3)
    by = {r.doc_id: r for r in out if r.doc_id != 6}
    assert by[2].near_next == 1.0 and by[2].n_chars == 0
    assert S.fingerprints(none(spark)).count() == 0
    one = S.fingerprints(edge(spark).where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert S.fingerprints(edge(spark).where("doc_id is null")).count() == 2
    assert S.fingerprints(clashing(spark)).count() == len(out)


def test_equal_texts_have_equal_fingerprints(spark):
    docs = documents(spark, SF)
    r = S.fingerprints(docs).join(docs, "doc_id").groupBy("text").agg({"fingerprint": "min"})
    assert r.count() == S.fingerprints(docs).join(docs, "doc_id").select("text", "fingerprint").distinct().count()
