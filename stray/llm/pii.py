"""Personal data: fixed patterns, and information-theoretic sanitisation around them.

Four kinds of entity are found by pattern in every whole text. The corpus then tells
how strongly other terms reveal an entity. A term t of a document that holds the entity e
discloses it if log(p(t | e) / p(t)) reaches `share` of the entity's own information
-log p(e). Both probabilities are confidence bounds, p(t | e) from below and p(t) from
above, and the text at hand does not count for p(t | e): a single text proves nothing by
itself. Evidence comes from

* the entity's value, where other texts hold it too: p(t | e) over those texts;
* its groups, which are the mail domain or number prefix, and the kind: p(t | e) over the
  distinct values of the group, so near copies with one value count once;
* the value itself: a term that a part of the address begins or ends with, or that a few
  letters of it abbreviate (`kzebedee`, `zebedee7` or `zb` for Zebedee), has p(t | e) = 1.

A term that occurs more often than any entity's information allows cannot reach the share,
and one that a single text with entities holds has no evidence by count: both are left out
before any pair is made. A disclosing term is a
span of kind `term` wherever it stands in a document that holds the entity. Sanitised
texts carry the kind in place of each entity and a generalised mark in place of each term.

All of it is DataFrame functions. Spans and terms depend on the text alone, so they are
computed once for each distinct text that may hold an entity (128 bits of hash name it) and
joined to its copies. Positions are running sums over the parts between matches; their
cost is linear. The patterns are written with possessive repeats, which match the same and
neither recurse nor go back in long runs. A document with very many entities or terms is
dealt to `lots` tasks.

Defined cases: a null text is empty and has no spans; repeated rows are treated alike;
an entity seen in all documents carries no information and discloses nothing; extra
columns of `docs` are kept in one struct, so none can clash; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stray.llm.common import materialise, text_of

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns. An email or number begins at the start of its run of signs, or
#: where the match before it ended: a later start in the same run would fail or win alike.
#: Runs of less than 13 digits are no cards, and hold no other match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this cannot hold the kind.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
BYTE_VALUE = r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})?$"
#: Beginnings and ends of an address are compared up to so many letters.
LONGEST_NAME = 32
COPY = ["h1", "h2"]
SPAN = "array<struct<kind:string,start:int,end:int,at:int,upto:int,value:string>>"


@dataclass(frozen=True)
class Disclosure:
    """share of an entity's information; z of the confidence bounds; a term is a run of at least
    `min_letters` letters; a document's pairs are dealt to `lots` tasks."""

    share: float = 0.5
    z: float = 1.645
    min_letters: int = 4
    lots: int = 16


def valid(kind: str, s: Column) -> Column:
    digits = F.regexp_replace(s, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda part: part.rlike(BYTE_VALUE))
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def copy_of(text: str) -> list[Column]:
    return [F.xxhash64(text_of(text)).alias("h1"), F.xxhash64(F.lit(1), text_of(text)).alias("h2")]


def hinted(text: str) -> Column:
    """Whether a text may hold an entity at all."""
    return text_of(text).rlike("|".join(HINTS.values()))


def cut_at(texts: DataFrame, pattern: str, *more: Column) -> DataFrame:
    """(h1, h2, value, start, end, at, upto): leftmost non-overlapping matches in `text`, with offsets in code points and bytes."""
    parts = F.arrays_zip(F.split("text", pattern, -1).alias("gap"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("value"))
    cut = texts.select(*COPY, F.posexplode(parts).alias("place", "p")).select(
        *COPY, "place", F.col("p.value").alias("value"),
        F.coalesce(F.char_length("p.value"), F.lit(0)).alias("n"), F.coalesce(F.octet_length("p.value"), F.lit(0)).alias("m"),
        F.char_length("p.gap").alias("gap"), F.octet_length("p.gap").alias("wide"))
    w = Window.partitionBy(*COPY).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    ends = cut.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(w).cast("int")).withColumn(
        "upto", F.sum(F.col("wide") + F.col("m")).over(w).cast("int"))
    return ends.where(F.col("value").isNotNull()).select(
        *COPY, "value", (F.col("end") - F.col("n")).alias("start"), "end", (F.col("upto") - F.col("m")).alias("at"), "upto", *more)


def find_entities(texts: DataFrame) -> DataFrame:
    """(h1, h2, spans): base spans by kind and start, of the distinct texts (h1, h2, text) that have any."""
    found = None
    for i, kind in enumerate(KINDS):
        own = cut_at(texts.where(F.col("text").rlike(HINTS[kind])), PATTERNS[kind]).where(valid(kind, F.col("value")))
        own = own.select(*COPY, F.struct(F.lit(i).alias("k"), "start", F.lit(kind).alias("kind"), "end", "at", "upto", "value").alias("s"))
        found = own if found is None else found.unionByName(own)
    spans = F.transform(F.sort_array(F.collect_list("s")), lambda s: F.struct(*[s[c] for c in ("kind", "start", "end", "at", "upto", "value")]))
    return found.groupBy(*COPY).agg(spans.cast(SPAN).alias("spans"))


def members(found: DataFrame) -> DataFrame:
    """(h1, h2, entity, member, value): each entity of a text. A value's members are its texts, a group's its values."""
    span = F.col("s")
    value = F.lower(span["value"])
    digits = F.regexp_replace(value, "[^0-9]", "")
    part = (F.when(span["kind"] == "email", F.regexp_extract(value, "@.*$", 0))
            .when(span["kind"] == "ip", F.concat(F.substring_index(value, ".", 2), F.lit(".")))
            .when(span["kind"] == "card", F.concat(F.substring(digits, 1, 6), F.lit("-")))
            .otherwise(F.concat(F.lit("+"), F.substring(digits, 1, 4), F.lit("-"))))
    own = F.concat_ws(":", span["kind"], value)
    text = F.concat_ws(":", *COPY)
    each = F.array(F.struct(own.alias("entity"), text.alias("member")),
                   F.struct(F.concat_ws(":", span["kind"], part).alias("entity"), own.alias("member")),
                   F.struct(span["kind"].alias("entity"), own.alias("member")))
    return (found.select(*COPY, F.explode("spans").alias("s"))
            .select(*COPY, F.explode(each).alias("e"), F.when(span["kind"] == "email", F.substring_index(value, "@", 1)).alias("local"))
            .select(*COPY, "e.entity", "e.member", F.when(F.col("e.member") == text, F.col("local")).alias("local")).distinct())


def term_pattern(d: Disclosure) -> str:
    """A term is a run without white space that consists of letters, without the punctuation at its ends."""
    return rf"(?<=(?:^|\s)\p{{P}}{{0,3}})\p{{L}}{{{d.min_letters},}}+(?=\p{{P}}*+(?:\s|$))"


def terms_of(texts: DataFrame, d: Disclosure) -> DataFrame:
    """(h1, h2, term): the distinct terms of these distinct texts."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(term_pattern(d)), F.lit(0))
    return texts.select(*COPY, F.explode(F.array_distinct(found)).alias("term"))


def places_of(texts: DataFrame, d: Disclosure) -> DataFrame:
    """(h1, h2, term, start, end, at, upto): every place of every term of these texts."""
    return cut_at(texts, term_pattern(d), F.lower("value").alias("term"))


def lower_bound(k: Column, n: Column, z: float) -> Column:
    """Least p for which k of n is not too many (Wilson); 0 for none of none."""
    p, zz = k / n, z * z
    low = (p + zz / (2 * n) - z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)
    return F.when(n > 0, low).otherwise(F.lit(0.0))


def upper_bound(k: Column, n: Column, z: float) -> Column:
    p, zz = k / n, z * z
    return (p + zz / (2 * n) + z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)


def spread_of(docs: DataFrame, text: str, wanted: DataFrame, d: Disclosure) -> DataFrame:
    """(term, held, n, info): -log p(term), bounded, of the wanted terms (term, held), each of the n distinct texts counting once."""
    words = F.filter(F.array_distinct(F.split(F.lower(text_of(text)), r"[^\p{L}]+")), lambda w: F.char_length(w) >= d.min_letters)
    # copies collapse before words are dealt; a string is shorter than an array
    once = docs.select(*copy_of(text), F.array_join(words, " ").alias("words")).dropDuplicates(COPY)
    total = docs.select(*copy_of(text)).distinct().agg(F.count("*").alias("n"))
    counts = (once.select(F.explode(F.split("words", " ")).alias("term")).groupBy("term").agg(F.count("*").alias("of_term"))
              .join(wanted, "term"))  # inner: a semi join would be moved below the count
    return counts.crossJoin(F.broadcast(total)).select(  # one row
        "term", "held", "n", (-F.log(upper_bound(F.col("of_term").cast("double"), F.col("n").cast("double"), d.z))).alias("info"))


def disclosed(docs: DataFrame, text: str, found: DataFrame, own: DataFrame, d: Disclosure) -> DataFrame:
    """(h1, h2, term): the terms that reveal an entity of their text."""
    each = materialise(members(found), "pii-members")
    wanted = materialise(own.groupBy("term").agg(F.count("*").alias("held")), "pii-wanted")
    spread = materialise(spread_of(docs, text, wanted, d), "pii-spread")
    n = F.col("n").cast("double")
    total = spread.select("n").limit(1)
    held = (each.groupBy("entity").agg(F.count_distinct("member").alias("members"), F.count_distinct(*COPY).alias("texts"))
            .crossJoin(F.broadcast(total)).select("entity", "members", F.log(n / F.col("texts")).alias("known")))
    known = materialise(held.where("known > 0"), "pii-known")
    # the least that any entity asks for bounds the terms that can matter
    least = known.agg((d.share * F.min("known")).alias("least"))
    able = spread.crossJoin(F.broadcast(least)).where(F.col("info") >= F.col("least")).select("term", "info", "held")
    some = materialise(own.join(able, "term"), "pii-terms")
    # by count: a term that one of these texts holds alone has no other text for evidence
    lot = F.pmod(F.xxhash64("term"), F.lit(d.lots)).alias("lot")
    lots = F.explode(F.sequence(F.lit(0), F.lit(d.lots - 1))).alias("lot")
    once = each.groupBy("entity", "member").agg((F.count("*") == 1).alias("once"))
    shared = (each.join(known.where("members > 1").select("entity"), "entity").join(once, ["entity", "member"])
              .select(*COPY, F.xxhash64("entity").alias("e"), F.xxhash64("member").alias("m"), "once", lots))
    both = some.where("held > 1").select(*COPY, "term", lot).join(shared, [*COPY, "lot"])
    # a member of one text counts as it is read; only those of several texts are dealt to be counted once
    single = both.where("once").groupBy("e", "term").agg(F.count("*").alias("k"))
    several = both.where("not once").select("e", "m", "term").distinct().groupBy("e", "term").agg(F.count("*").alias("k"))
    seen = single.unionByName(several).groupBy("e", "term").agg(F.sum("k").alias("k")).where("k > 1")
    rate = lower_bound((F.col("k") - 1).cast("double"), (F.col("members") - 1).cast("double"), d.z)
    shown = (seen.join(known.withColumn("e", F.xxhash64("entity")), "e").join(able.select("term", "info"), "term")
             .where(F.log(rate) + F.col("info") >= d.share * F.col("known")).select("entity", "term"))
    by_count = (some.join(materialise(shown, "pii-shown"), "term")
                .join(each.select(*COPY, "entity").distinct(), [*COPY, "entity"], "left_semi").select(*COPY, "term"))
    # terms that the address spells: its beginning or end, or what a few letters abbreviate
    part = F.explode(F.regexp_extract_all(F.col("local"), F.lit(r"\p{L}{2,}+"), F.lit(0))).alias("part")
    spelt = (each.where(F.col("local").isNotNull()).select(*COPY, "entity", part).join(known, "entity")
             .groupBy(*COPY, "part").agg(F.min("known").alias("known")))
    size = F.char_length("part")
    cuts = F.filter(F.sequence(F.lit(d.min_letters), F.lit(LONGEST_NAME)), lambda k: k <= size)
    affixes = F.array_distinct(F.flatten(F.transform(cuts, lambda k: F.array(F.left("part", k), F.right("part", k)))))
    by_name = spelt.select(*COPY, "known", F.explode(affixes).alias("term")).join(some, [*COPY, "term"])
    short = spelt.where(size < d.min_letters + 1).select(*COPY, "part", "known", F.left("part", F.lit(1)).alias("first"))
    spelling = F.concat(F.lit("^"), F.regexp_replace("part", r"(\p{L})", "[^$1]*+$1"))
    by_letters = some.withColumn("first", F.left("term", F.lit(1))).join(short, [*COPY, "first"]).where(F.rlike(F.col("term"), spelling))
    by_name = by_name.select(*COPY, "term", "info", "known").unionByName(by_letters.select(*COPY, "term", "info", "known"))
    by_name = by_name.where(F.col("info") >= d.share * F.col("known")).select(*COPY, "term")
    return by_count.unionByName(by_name).distinct()


def spans_by_text(docs: DataFrame, text: str, d: Disclosure) -> DataFrame:
    """(h1, h2, spans, terms) of every distinct text with base spans; both by start within a kind."""
    rows = docs.where(hinted(text)).select(*copy_of(text), text_of(text).alias("text"))
    texts = materialise(rows.dropDuplicates(COPY), "pii-texts")
    found = materialise(find_entities(texts), "pii-entities")
    own = materialise(terms_of(texts.join(found.select(*COPY), COPY), d), "pii-own-terms")
    shown = materialise(disclosed(docs, text, found, own, d), "pii-disclosed")
    # Of all overlapping base spans none is touched: a term is letters only, between blanks or punctuation.
    kept = places_of(texts.join(shown.select(*COPY).distinct(), COPY), d).join(shown, [*COPY, "term"])
    span = F.struct("start", F.lit("term").alias("kind"), "end", "at", "upto", F.col("term").alias("value"))
    listed_ = F.transform(F.sort_array(F.collect_list(span)), lambda s: F.struct(*[s[c] for c in ("kind", "start", "end", "at", "upto", "value")]))
    per_text = kept.groupBy(*COPY).agg(listed_.cast(SPAN).alias("terms"))
    return materialise(found.join(per_text, COPY, "left").select(*COPY, "spans", F.coalesce("terms", F.array().cast(SPAN)).alias("terms")), "pii-spans")


def find_spans(docs: DataFrame, text: str = "text", d: Disclosure = Disclosure(), keep_text: bool = True) -> DataFrame:
    """(doc, text, spans, terms): the row as a struct, base spans by kind and start, and revealing terms by start.

    Only rows whose text may hold an entity are joined; their text goes along where `keep_text`."""
    found = spans_by_text(docs, text, d)
    none = F.array().cast(SPAN)
    columns = docs.columns if keep_text else [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")
    said = [text_of(text).alias("text")] if keep_text else []
    names = ["doc", *["text"] * keep_text, "spans", "terms"]
    plain = docs.where(~hinted(text)).select(row, *said, none.alias("spans"), none.alias("terms"))
    held = docs.where(hinted(text)).select(row, *said, *copy_of(text)).join(found, COPY, "left").select(
        "doc", *["text"] * keep_text, F.coalesce("spans", none).alias("spans"), F.coalesce("terms", none).alias("terms"))
    return plain.select(*names).unionByName(held.select(*names))


def sanitised_texts(docs: DataFrame, found: DataFrame, text: str) -> DataFrame:
    """(h1, h2, clean): the texts with a mark in place of each span. A span inside what earlier spans cover has no mark."""
    marks = F.create_map(*[F.lit(x) for kv in MARKS.items() for x in kv])
    held = docs.where(hinted(text)).select(*copy_of(text), text_of(text).cast("binary").alias("raw")).dropDuplicates(COPY)
    before = Window.partitionBy(*COPY).orderBy("s.start", "s.end", "s.kind").rowsBetween(Window.unboundedPreceding, -1)
    span = F.explode(F.concat("spans", "terms")).alias("s")
    pieces = (found.select(*COPY, span).withColumn("done", F.coalesce(F.max("s.upto").over(before), F.lit(0)))
              .where(F.col("s.upto") > F.col("done"))
              .groupBy(*COPY).agg(F.sort_array(F.collect_list(F.struct("s.at", "done", "s.upto", "s.kind"))).alias("pieces")))
    cut = lambda begin, size: F.substring(F.col("raw"), begin + 1, F.greatest(F.lit(0), size)).cast("string")
    put = F.array_join(F.transform("pieces", lambda p: F.concat(cut(p["done"], p["at"] - p["done"]), marks[p["kind"]])), "")
    last = F.element_at("pieces", -1)["upto"]
    return held.join(pieces, COPY).select(*COPY, F.concat(put, cut(last, F.octet_length("raw") - last)).alias("clean"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_query(docs: DataFrame) -> DataFrame:
    """The digest of every document: counts, base digest and all spans."""
    out = find_spans(docs.select("doc_id", "text"), keep_text=False)
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in KINDS]
    counts = [(F.size("spans") - n).cast("long").alias(f"n_{k}") for n, k in zip(counts, KINDS)]
    return out.select("doc.doc_id", *counts, F.sha2(listed(F.col("spans")), 256).alias("base_sha256"),
                      listed(F.concat("spans", "terms")).alias("spans"))


def pii_stage(docs: DataFrame, text: str = "text", d: Disclosure = Disclosure()) -> DataFrame:
    """All documents with their texts sanitised; n_chars follows the text."""
    found = spans_by_text(docs, text, d)
    clean = sanitised_texts(docs, found, text)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    plain = docs.where(~hinted(text)).select(row, text_of(text).alias("clean"))
    held = docs.where(hinted(text)).select(row, text_of(text).alias("own"), *copy_of(text)).join(clean, COPY, "left")
    out = plain.unionByName(held.select("doc", F.coalesce("clean", "own").alias("clean")))
    put = {text: F.col("clean"), "n_chars": F.char_length("clean").cast("long")}
    return out.select(*[put.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
