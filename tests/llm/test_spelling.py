import random
import re
import zlib
from collections import Counter

from edge import SCHEMA, clashing, documents, edge, none

from stray.llm import spelling as W

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def counts(rows, damage=199):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 5}


def neighbours(words):
    """Near words by all deletions of each word, and a check."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for group in holes.values():  # one code point replaced
        for w in group:
            near[w] |= group - {w}
    for w in words:
        for i in range(len(w)):  # one deleted
            x = w[:i] + w[i + 1:]
            if x in near:
                near[w].add(x)
                near[x].add(w)
    return near


def brute(n_of):
    near, form = neighbours(n_of), {}
    for w, xs in near.items():
        if xs:
            best = min(xs, key=lambda x: (-n_of[x], x))
            if n_of[best] >= 5 * n_of[w]:
                form[w] = best
    out = set()
    for w, n in n_of.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), n_of.get(form.get(w))))
    return out


def got(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_made_words_equal_brute_force(spark):
    rnd, words = random.Random(4), {}
    for _ in range(150):
        base = "".join(rnd.choice("abcé") for _ in range(rnd.randint(6, 9)))
        words[base] = rnd.randint(5, 3000)
        for _ in range(6):
            i, w = rnd.randrange(len(base)), base
            w = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice("abcéÿ") + w[i + 1:], w[:i] + rnd.choice("abcé") + w[i:]])
            if len(w) >= 6:
                words.setdefault(w, rnd.randint(5, 400))
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = brute(words)
    assert got(W.variants(df)) == want
    assert sum(r[1] is not None for r in want) > 200 and any(r[2] not in (r[0], r[1]) for r in want)


def test_long_words_and_runs_of_one_sign(spark):
    long = "".join(random.Random(1).choice("abcdef") for _ in range(3000))
    words = [long, long[:-1], long[1:], long[:1500] + "z" + long[1501:], long[:700] + long[701:], long + "q", "x" + long,
             *("a" * k for k in range(6, 80)), "a" * 40 + "b" + "a" * 30, "b" * 33, "b" * 32 + "c", "b" * 16 + "c" + "b" * 16, "ab" * 20, "ba" * 20]
    n_of = {w: 5 * 7 ** (i % 5) for i, w in enumerate(words)}
    assert got(W.variants(spark.createDataFrame(list(n_of.items()), "word string, n long"))) == brute(n_of)


def test_documents_equal_brute_force(spark):
    docs = documents(spark)
    want = brute(counts([(r.doc_id, r.text) for r in docs.collect()]))
    assert got(W.spelling_query(docs)) == want and len(want) > 500


def test_edge_rows_ties_and_extra_columns(spark):
    text = "Straßen Straszen " + "maison maisoN maison-Maison ÉCOLES école " * 3 + "×÷×÷×÷ " * 5
    rows = [(i, text, "en", "s", 0) for i in range(40)] + [(None, "maison maisons " * 3, "en", "s", 0)] * 2
    docs = edge(spark).unionByName(spark.createDataFrame(rows, SCHEMA))
    want = brute(counts([(r.doc_id, r.text) for r in docs.collect()]))
    assert got(W.spelling_query(docs)) == want and any(r[0] == "maisons" for r in want)
    more = clashing(spark).selectExpr("*", "1 as word", "2 as n", "3 as node", "4 as near", "5 as s", "6 as level")
    assert got(W.spelling_query(more)) == brute(counts([(r.doc_id, r.text) for r in more.collect()]))
    assert W.spelling_query(none(spark)).count() == 0
