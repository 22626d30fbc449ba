"""Licence scan: sparse TF-IDF cosine to templates, then inheritance by directory.

Every text is cut into segments (lines and sentences). A segment that names a licence
(one of the cue words) is compared with the templates: term counts times log inverse
document frequency over all documents, cosine, best template. A document takes its best
segment at or above the threshold. Documents that declare a licence for their directory
vote; every other document inherits from the nearest ancestor directory with a vote,
found by joining directory paths.

All of it is DataFrame functions. Term counts pre-aggregate before their shuffle; the
template terms are a fixed small table; directories are joined once each, not per file.

Defined cases: a null or empty text has no licence of its own; a null path has no
directory and inherits nothing; ties go to the higher score, then to the licence first
by name; repeated rows are judged each; extra columns stay in one struct and cannot
clash; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stray.llm.common import materialise, text_of

#: Licence and one of its notices or opening sentences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work has been dedicated to the public domain under the CC0 1.0 Universal license."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: A notice names a licence by one of these.
CUES = ("license", "licensed", "licence", "licenced", "permission", "redistribution", "unencumbered")
SEGMENT = r"\n|(?<=[.!?])[\x20\t]+"
NOT_WORD = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Scan:
    """Cosine from which a segment counts as a notice, and from which it speaks for its directory."""

    threshold: float = 0.6
    declares: float = 0.95


def words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), NOT_WORD), lambda w: w != "")


def template_terms(spark: SparkSession) -> DataFrame:
    """(template, license, term, tf) of the fixed templates."""
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(TEMPLATES)],
                                 "template int, license string, text string")
    return (rows.select("template", "license", F.explode(words(F.col("text"))).alias("term"))
            .groupBy("template", "license", "term").agg(F.count("*").alias("tf")))


def notices(docs: DataFrame, row: str, text: str) -> DataFrame:
    """(row, segment, term, tf): the terms of every segment with a cue."""
    cues = F.array(*[F.lit(c) for c in CUES])
    parts = docs.where(F.lower(text).rlike("licen[sc]e|permission|redistribution|unencumbered")).select(
        row, F.posexplode(F.split(F.col(text), SEGMENT, -1)).alias("segment", "part"))
    named = parts.select(row, "segment", words(F.col("part")).alias("w")).where(F.arrays_overlap("w", cues))
    return named.select(row, "segment", F.explode("w").alias("term")).groupBy(row, "segment", "term").agg(
        F.count("*").alias("tf"))


def best_notice(docs: DataFrame, row: str, text: str, scan: Scan) -> DataFrame:
    """(row, license, score) of each row's best segment at or above the threshold."""
    terms = materialise(notices(docs, row, text), "notices")
    templates = template_terms(docs.sparkSession)
    total = docs.agg(F.count("*").alias("n"))
    spread = docs.select(F.explode(F.array_distinct(words(F.col(text)))).alias("term")).groupBy("term").agg(
        F.count("*").alias("df"))
    wanted = terms.select("term").union(templates.select("term")).distinct()
    idf = materialise(
        wanted.join(spread, "term", "left").crossJoin(F.broadcast(total))  # one row
        .select("term", (F.log((1 + F.col("n")) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("idf")), "idf")
    weigh = F.col("tf") * F.col("idf")
    theirs = templates.join(idf, "term").select("template", "license", "term", weigh.alias("b"))
    norms = theirs.groupBy("template").agg(F.sqrt(F.sum(F.col("b") * F.col("b"))).alias("nb"))
    theirs = F.broadcast(theirs.join(norms, "template"))  # the fixed templates' terms, under 200 rows
    ours = materialise(terms.join(idf, "term").select(row, "segment", "term", weigh.alias("a")), "weights")
    sizes = ours.groupBy(row, "segment").agg(F.sqrt(F.sum(F.col("a") * F.col("a"))).alias("na"))
    dots = ours.join(theirs, "term").groupBy(row, "segment", "template", "license", "nb").agg(
        F.sum(F.col("a") * F.col("b")).alias("dot"))
    scored = dots.join(sizes, [row, "segment"]).select(
        row, "license", F.round(F.col("dot") / (F.col("na") * F.col("nb")), 6).alias("score"))
    return scored.where(F.col("score") >= scan.threshold).groupBy(row).agg(
        F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b")).select(
        row, "b.license", (-F.col("b.s")).alias("score"))


def directory_licenses(declared: DataFrame, dirs: DataFrame) -> DataFrame:
    """(dir, license, from_dir) for each of `dirs`: the vote of the nearest ancestor, itself included."""
    votes = declared.groupBy("dir", "license").agg(F.count("*").alias("k"), F.max("score").alias("s"))
    voted = votes.groupBy(F.col("dir").alias("from_dir")).agg(
        F.min(F.struct((-F.col("k")).alias("k"), (-F.col("s")).alias("s"), "license")).alias("v")).select(
        "from_dir", "v.license")
    parts = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(
        i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("at")))
    climbs = dirs.select("dir", F.explode(up).alias("u")).select("dir", "u.depth", F.col("u.at").alias("from_dir"))
    return climbs.join(voted, "from_dir").groupBy("dir").agg(
        F.max(F.struct("depth", "from_dir", "license")).alias("m")).select("dir", "m.license", "m.from_dir")


def license_scan(docs: DataFrame, path: Column, text: str = "text", scan: Scan = Scan()) -> DataFrame:
    """One row (doc, path, license, origin own / inherited / null, score, from_dir) per row of `docs`."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.monotonically_increasing_id().alias("row"), path.alias("path"), text_of(text).alias("text"))
    rows = rows.withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1)))
    own = materialise(best_notice(rows.select("row", "text"), "row", "text", scan), "own")
    own = own.select(F.col("row").alias("r"), "license", "score")
    marked = rows.drop("text").join(own, F.col("row") == F.col("r"), "left").drop("r")
    declared = marked.where((F.col("score") >= scan.declares) & F.col("dir").isNotNull()).select("dir", "license", "score")
    dirs = marked.where(F.col("license").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    given = directory_licenses(declared, dirs).select(
        F.col("dir").alias("d"), F.col("license").alias("given"), "from_dir")
    out = marked.join(given, (F.col("dir") == F.col("d")) & F.col("license").isNull(), "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited")
    return out.select("doc", "path", F.coalesce("license", "given").alias("license"), origin.alias("origin"),
                      "score", "from_dir")


def document_path() -> Column:
    """A path for a document: source, language, then the digits of its id, so that ids that begin alike share
    directories and shorter ids stand above longer ones."""
    return F.concat_ws("/", "source", "lang", F.array_join(F.split(F.col("doc_id").cast("string"), ""), "/"))


def license_query(docs: DataFrame) -> DataFrame:
    return license_scan(docs.select("doc_id", "source", "lang", "text"), document_path()).select(
        "doc.doc_id", "path", "license", "origin", "score", "from_dir")


_VALUES = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(TEMPLATES))
_CUES = ", ".join(f"'{c}'" for c in CUES)
LICENSE_SQL = rf"""
WITH tm(template, license, t) AS (VALUES {_VALUES}),
tt AS (SELECT template, license, term, count(*) AS tf FROM
  (SELECT template, license, unnest(string_split_regex(lower(t), '[^\p{{L}}\p{{N}}]+')) AS term FROM tm) WHERE term <> '' GROUP BY ALL),
d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
seg AS (SELECT doc_id, i, string_split_regex(lower(s), '[^\p{{L}}\p{{N}}]+') AS w FROM
  (SELECT doc_id, unnest(generate_series(1, len(p))) AS i, unnest(p) AS s FROM
    (SELECT doc_id, string_split(regexp_replace(t, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10)) AS p FROM d))),
nt AS (SELECT doc_id, i, term, count(*) AS tf FROM (SELECT doc_id, i, unnest(w) AS term FROM seg WHERE list_has_any(w, [{_CUES}]))
  WHERE term <> '' GROUP BY ALL),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM
  (SELECT doc_id, unnest(string_split_regex(lower(t), '[^\p{{L}}\p{{N}}]+')) AS term FROM d) GROUP BY term),
n AS (SELECT count(*) AS n FROM d),
idf AS (SELECT term, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf FROM
  (SELECT term FROM nt UNION SELECT term FROM tt) LEFT JOIN df USING (term), n),
b AS (SELECT template, license, term, tf * idf AS b FROM tt JOIN idf USING (term)),
nb AS (SELECT template, sqrt(sum(b * b)) AS nb FROM b GROUP BY template),
a AS (SELECT doc_id, i, term, tf * idf AS a FROM nt JOIN idf USING (term)),
na AS (SELECT doc_id, i, sqrt(sum(a * a)) AS na FROM a GROUP BY doc_id, i),
sc AS (SELECT doc_id, license, round(dot / (na * nb), 6) AS score FROM
  (SELECT doc_id, i, template, license, sum(a * b) AS dot FROM a JOIN b USING (term) GROUP BY ALL)
  JOIN na USING (doc_id, i) JOIN nb USING (template)),
own AS (SELECT doc_id, license, score FROM sc WHERE score >= 0.6
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
r AS (SELECT d.doc_id, source || '/' || lang || '/' || array_to_string(string_split(CAST(d.doc_id AS VARCHAR), ''), '/') AS path,
  license, score FROM d LEFT JOIN own USING (doc_id)),
rd AS (SELECT *, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM r),
v AS (SELECT dir, license FROM (SELECT dir, license, count(*) AS k, max(score) AS s FROM rd WHERE score >= 0.95 GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY k DESC, s DESC, license) = 1),
g AS (SELECT doc_id, v.license AS given, v.dir AS from_dir FROM rd JOIN v ON rd.dir = v.dir OR starts_with(rd.dir, v.dir || '/')
  WHERE rd.license IS NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(v.dir) DESC) = 1)
SELECT doc_id, path, coalesce(license, given) AS license,
  CASE WHEN license IS NOT NULL THEN 'own' WHEN given IS NOT NULL THEN 'inherited' END AS origin, score, from_dir
FROM rd LEFT JOIN g USING (doc_id)
"""
