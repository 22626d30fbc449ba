import hashlib
import random
import re

from edge import SCHEMA, clashing, documents, edge, none

from stray.llm import pii

SIMPLE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
          "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
PARTS = list("0123456789") * 2 + list(" -.()+@@ab_%x\n") + ["é", "1.2.3.4", "4111 1111 1111 1111", "+1 (499) 555-6503", "a@b.co",
                                                          "x@y.z.w@q.r", "255.255.255.256", "0001.2.3.4", "👍", "5500-0000-0000-0004"]


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in s.split(".")),
            "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in SIMPLE.items() for m in re.finditer(p, text) if valid(k, m.group())]


def test_base_spans_by_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 60))), "en", "s", 0) for i in range(2000)]
    rows += [(5001, "7" * 20000, "en", "s", 0), (5002, "a" * 50000, "en", "s", 0), (5003, "1 " * 8000, "en", "s", 0),
             (5004, "a@" + "b." * 3000 + "c", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).unionByName(documents(spark).selectExpr("doc_id + 10000 doc_id", "text", "lang", "source", "n_chars"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.pii_query(docs).collect():
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w.startswith(k) for w in want) for k in SIMPLE)
        assert r.spans.startswith(",".join(want))


def test_revealing_terms_are_generalised(spark):
    filler = lambda i: " ".join(f"q{i}z{j}" for j in range(30))
    rows = [(i, f"{filler(i)} our plumber Zebedee, writes from zb@mail.net today {filler(i)}", "en", "s", 0) for i in range(4)]
    rows += [(100 + i, f"{filler(100 + i)} the plumber came today {filler(i)}", "en", "s", 0) for i in range(40)]
    rows += [(300, "Zebedee alone", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.spans for r in pii.pii_query(docs).collect()}
    text = {r[0]: r[1] for r in rows}
    for i in range(4):
        terms = [text[i][int(a):int(b)] for k, a, b in (s.split(":") for s in got[i].split(",")) if k == "term"]
        assert "Zebedee" in terms and "plumber" not in terms and "today" not in terms
    assert got[300] == "" and got[100] == ""  # only beside the entity
    clean = {r.doc_id: (r.text, r.n_chars) for r in pii.pii_stage(docs).collect()}
    assert "plumber [TERM]," in clean[0][0] and "[EMAIL]" in clean[0][0] and "zb@" not in clean[0][0]
    assert clean[0][1] == len(clean[0][0]) and clean[100][0] == text[100]


def test_copies_prove_nothing(spark):
    rows = [(i, "our plumber Zebedee writes from zb@mail.net today", "en", "s", 0) for i in range(50)] + [(99, "else", "en", "s", 0)]
    assert all("term" not in r.spans for r in pii.pii_query(spark.createDataFrame(rows, SCHEMA)).collect())


def test_overlaps_and_edges(spark):
    rows = [(1, "ab +4222222222222 and 1.2.3.4x", "en", "s", 0)]  # a phone that holds a card
    assert pii.pii_stage(spark.createDataFrame(rows, SCHEMA)).head().text == "ab [PHONE] and [IP]x"
    out = pii.pii_query(edge(spark)).collect()
    assert len(out) == edge(spark).count() and {r.spans for r in out} == {""}
    assert pii.pii_query(none(spark)).count() == 0
    docs = clashing(spark)
    stage = pii.pii_stage(docs)
    assert stage.columns == docs.columns and stage.count() == docs.count()


def test_terms_of_whole_documents_and_of_groups(spark):
    """A name far from an address seen in one text, and a firm's name beside different addresses of its domain."""
    far = " and so on" * 20
    rows = [(1, f"Zebedee was here{far} mail zb@one.net now{far} then Zebedee left", "en", "s", 0)]
    rows += [(10 + i, f"ask Acmecorp about part q{i}z{far} at u{i}@acme.com now", "en", "s", 0) for i in range(6)]
    rows += [(100 + i, f"mail was here q{i}z now then left ask about part", "en", "s", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    text = {r[0]: r[1] for r in rows}
    got = {r.doc_id: r.spans for r in pii.pii_query(docs).collect()}

    def terms(i):
        return [text[i][int(a):int(b)] for k, a, b in (s.split(":") for s in got[i].split(",") if s) if k == "term"]

    assert terms(1) == ["Zebedee", "Zebedee"]
    assert all(terms(10 + i) == ["Acmecorp"] for i in range(6))
    assert all(got[100 + i] == "" for i in range(200))


def test_copies_do_not_hide_a_term(spark):
    told = [f"part q{i}z of Zebedee at zb@mail.net" for i in range(3)]
    rows = [(100 * i + k, t, "en", "s", 0) for i, t in enumerate(told) for k in range(30)]
    rows += [(1000 + i, f"part q{i}z alone", "en", "s", 0) for i in range(20)]
    got = {r.doc_id: r.spans for r in pii.pii_query(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(f"term:{t.index('Zebedee')}:{t.index('Zebedee') + 7}" in got[100 * i + k] for i, t in enumerate(told) for k in range(30))
