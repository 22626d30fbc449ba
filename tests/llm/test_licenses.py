from edge import SCHEMA, clashing, documents, edge, none
from pyspark.sql import functions as F

from stray.llm import licenses as L


def test_every_template_is_found_as_itself(spark):
    docs = spark.createDataFrame([(i, f"Some prose of its own.\n{t}\nMore prose", "en", "s", 0)
                                  for i, (_, t) in enumerate(L.TEMPLATES)], SCHEMA)
    got = {r.doc_id: (r.license, r.origin) for r in L.license_scan(
        docs, F.lit(None).cast("string")).select("doc.doc_id", "license", "origin").collect()}
    assert got == {i: (name, "own") for i, (name, _) in enumerate(L.TEMPLATES)}


def test_nearest_ancestor_wins(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/LICENSE", "Licensed under the Apache License, Version 2.0."),
            ("a/b/c/x", "no notice"), ("a/y", "no notice"), ("a/bb/z", "no notice"), ("q/z", "no notice"),
            ("a/b/w", "This work is licensed under the GNU General Public License, version 3."), (None, "no notice"), ("top", "none")]
    docs = spark.createDataFrame(rows, "path string, text string")
    got = {r.path: (r.license, r.origin, r.from_dir) for r in L.license_scan(docs, F.col("path")).select(
        "doc.path", "license", "origin", "from_dir").collect()}
    assert got["a/b/c/x"][1:] == ("inherited", "a/b") and got["a/b/c/x"][0] == "Apache-2.0"  # one vote each: first by name
    assert got["a/y"] == ("MIT", "inherited", "a") and got["a/bb/z"] == ("MIT", "inherited", "a")
    assert got["q/z"] == (None, None, None) == got[None] == got["top"]
    assert got["a/b/w"][:2] == ("GPL-3.0", "own")


def test_prose_is_no_notice(spark):
    docs = spark.createDataFrame([(1, "The permission of the board to use the hall with a fee is the subject of this", "en", "s", 0)], SCHEMA)
    assert L.license_query(docs).head().license is None


def test_edges(spark):
    assert L.license_query(edge(spark)).count() == edge(spark).count()
    assert L.license_query(none(spark)).count() == 0
    assert L.license_scan(clashing(spark), L.document_path()).count() == edge(spark).count()


def test_cues_are_in_every_template():
    assert all(any(c in t.lower() for c in L.CUES) for _, t in L.TEMPLATES)


def test_documents(spark):
    out = L.license_query(documents(spark))
    assert out.count() == documents(spark).count() and out.where("origin = 'own'").count() > 0
