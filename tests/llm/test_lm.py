import math
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import SF, clashing, documents, edge, none

from stray.llm import lm


def tokens(text):
    return (text or "").encode().lower().split() + [lm.END]


def fold(doc):
    crc = zlib.crc32(str(doc).encode() if doc is not None else b"")
    return -1 if crc % 7 == 2 else crc // 7 % 2


def test_counts_and_base_score_by_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    c = Counter(t for i, x in rows if fold(i) >= 0 for t in tokens(x))
    n, v = sum(c.values()), len(c)
    texts = dict(rows)
    for shape in (lm.Shape(), lm.Shape(classes=40, frequent=300)):
        out = lm.score_documents(documents(spark, SF), shape).collect()
        assert len(out) == len(rows)
        for r in out:
            ts = tokens(texts[r.doc_id])
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(r.doc_id) < 0, len(ts), sum(c[t] > 0 for t in ts), n)
            assert r.base_score == pytest.approx(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts))


def test_model_by_brute_force(spark):
    shape = lm.Shape(classes=30, frequent=200)
    rows = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    sides = [Counter(), Counter()]
    pairs = [Counter(), Counter()]
    train = [(fold(i), tokens(x)) for i, x in rows if fold(i) >= 0]
    for f, ts in train:
        sides[f].update(ts)
    c = sides[0] + sides[1]
    n, v = sum(c.values()), len(c)
    key = {t: int(lm.word_hashes([t]).view(np.int64)[0]) for t in c}
    named = sorted(c, key=lambda t: (-c[t], key[t]))[:shape.classes - 1]
    cls = lambda t: t if t in set(named) else None
    named_set = set(named)
    for f, ts in train:
        seq = [t if t in named_set else None for t in ts]
        pairs[f].update(zip([lm.END if lm.END in named_set else None, *seq[:-1]], seq))
    # e
    e1 = 0.5
    for _ in range(shape.em_steps):
        num = 0.0
        for f in (0, 1):
            nf = sum(sides[f].values())
            for t, k in sides[1 - f].items():
                a = e1 * sides[f][t] / nf
                num += k * a / (a + (1 - e1) / (v + 1))
        e1 = num / n
    e = 1 - e1
    p1 = lambda t: (1 - e) * c[t] / n + e / (v + 1)
    classes = [*named, None]
    of = [{h: sum(k for (a, _), k in pairs[f].items() if a == h) for h in classes} for f in (0, 1)]
    out_of = [{w: sum(k for (_, b), k in pairs[f].items() if b == w) for w in classes} for f in (0, 1)]
    bucket = lambda x: 1 + int(math.log2(x)) if x > 0 else 0
    weight = {}
    for _ in range(shape.em_steps):
        num, den = Counter(), Counter()
        for f in (0, 1):
            total = sum(of[f].values())
            for (h, w), k in pairs[1 - f].items():
                b = bucket(of[f][h])
                p2 = pairs[f][(h, w)] / max(of[f][h], 1)
                low = (out_of[f][w] + 0.5) / (total + 0.5 * len(classes))
                high = weight.get(b, 0.5) * p2
                num[b] += k * high / (high + (1 - weight.get(b, 0.5)) * low)
                den[b] += k
        weight = {b: num[b] / den[b] for b in den}
    both = pairs[0] + pairs[1]
    ctx = Counter()
    for (h, _), k in both.items():
        ctx[h] += k
    rest = 1 - sum(p1(t) for t in named)

    def p(w, h):
        wc, hc = (w if w in named_set else None), (h if h in named_set else None)
        l = weight.get(bucket(ctx[hc]), 0.0) if ctx[hc] else 0.0
        p2 = both[(hc, wc)] / max(ctx[hc], 1) * (1 if wc is not None else p1(w) / rest)
        return l * p2 + (1 - l) * p1(w)

    for h in (lm.END, named[1], b"never seen"):  # it is a distribution, with one place for all unseen words
        assert sum(p(w, h) for w in c) + p(b"never seen", h) == pytest.approx(1.0)
    texts = dict(rows)
    for r in lm.score_documents(documents(spark, SF), shape).collect():
        ts = tokens(texts[r.doc_id])
        assert r.score == pytest.approx(sum(math.log10(p(w, h)) for w, h in zip(ts, [lm.END, *ts[:-1]])), rel=1e-9)


def test_held_out_text_is_likelier_than_by_the_base(spark):
    out = lm.score_documents(documents(spark, "/root/testdata/sf0.01"))
    r = out.where("held_out").selectExpr("sum(score) s", "sum(base_score) b").head()
    assert r.s > r.b


def test_edges(spark):
    out = lm.score_documents(edge(spark)).collect()
    assert len(out) == edge(spark).count()
    assert {r.n_tokens for r in out if r.doc_id in (1, 2, 4)} == {1}
    assert lm.score_documents(none(spark)).count() == 0
    held = next(i for i in range(100) if fold(i) < 0)
    only = spark.createDataFrame([(held, "a b c")], "doc_id long, text string")
    r = lm.score_documents(only).head()
    assert (r.n_known, r.train_tokens, r.score) == (0, 0, 0.0)
    assert lm.score_documents(clashing(spark)).count() == len(out)


def test_every_word_is_a_context_of_its_own(spark):
    """The model of the query by brute force: all pairs, weights by the bucket of the true context count."""
    rows = [(r.doc_id, r.text) for r in documents(spark, SF).collect()] + [(10_001, "never seen words"), (10_002, None)]
    sides, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for i, x in rows:
        if fold(i) >= 0:
            ts = tokens(x)
            sides[fold(i)].update(ts)
            pairs[fold(i)].update(zip([lm.END, *ts[:-1]], ts))
    c, both = sides[0] + sides[1], pairs[0] + pairs[1]
    n, v = sum(c.values()), len(c)
    e1 = 0.5
    steps = lm.Shape().em_steps
    for _ in range(steps):
        num = 0.0
        for f in (0, 1):
            for t, k in sides[1 - f].items():
                a = e1 * sides[f][t] / sum(sides[f].values())
                num += k * a / (a + (1 - e1) / (v + 1))
        e1 = num / n
    e = 1 - e1
    bucket = lambda x: 1 + int(math.log2(x)) if x > 0 else 0
    seen = []  # (bucket, p2, p1, times)
    for f in (0, 1):
        size = sum(sides[f].values())
        seen += [(bucket(sides[f][h]), pairs[f][(h, w)] / max(sides[f][h], 1), (1 - e) * sides[f][w] / size + e / (v + 1), k)
                 for (h, w), k in pairs[1 - f].items()]
    weight = {}
    for _ in range(steps):
        num, den = Counter(), Counter()
        for b, p2, low, k in seen:
            l = weight.get(b, 0.5)
            num[b] += k * l * p2 / (l * p2 + (1 - l) * low)
            den[b] += k
        weight = {b: num[b] / den[b] for b in den}

    def p(w, h):
        l = weight.get(bucket(c[h]), 0.0) if c[h] else 0.0
        return l * both[(h, w)] / max(c[h], 1) + (1 - l) * ((1 - e) * c[w] / n + e / (v + 1))

    for h in (lm.END, min(c, key=lambda t: (c[t], t)), b"never seen"):  # a distribution, also after a word met once
        assert sum(p(w, h) for w in c) + p(b"never seen", h) == pytest.approx(1.0)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for shape in (lm.Shape(), lm.Shape(frequent=300, pairs=500), lm.Shape(frequent=0, pairs=0)):
        out = lm.score_documents(docs, shape).collect()
        assert len(out) == len(rows)
        for r in out:
            ts = tokens(dict(rows)[r.doc_id])
            assert r.score == pytest.approx(sum(math.log10(p(w, h)) for w, h in zip(ts, [lm.END, *ts[:-1]])), rel=1e-4)
            assert r.n_known == sum(c[t] > 0 for t in ts)
