"""Personal data: patterns for base entities, and terms that reveal them by co-occurrence.

Base spans are the leftmost non-overlapping matches of a pattern for each kind that pass its check.
The entities found are what is protected.  Over the whole corpus, the information of an entity is -log2 of the share of
lines that hold it, and the pointwise mutual information of a term and an entity tells how many bits of it the
term reveals.  Lines count as often as they occur; the share of a term's lines that hold the entity is shrunk by
``SHRINK`` lines towards the share in all lines.  The terms of an entity are those of its lines that do not
overlap the entity itself, so parts of a name beside an address count.  A term is marked in the documents that
hold the entity if it reveals at least ``MIN_BITS`` bits and ``GENERALISE`` of the entity's information, for removal
from ``REMOVE`` on.  No entity is too rare for that; one that stands in more than a line of 2**MIN_BITS has not so many
bits to reveal, so ordinary words beside a frequent address stay.

All of it is DataFrame expressions.  Positions come from the lengths of the pieces between matches,
summed in two levels, so that a text with very many matches costs no quadratic time.

Cases: a null text is empty and has no spans; repeated rows are judged alike, each with its own
result; a null id is carried; without any entity no term is marked; tables may be empty; new columns sit
beside a struct of the document, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauselens.functions.text import let
from clauselens.llm.common import WORD, preselected, stored

# fixed values: what is looked for, in the order of the kinds.  Runs are matched possessively and not
# entered in their middle, which finds the same matches without trying every start in a long run.
KINDS = ["email", "ip", "card", "phone", "generalise", "remove"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a cheap test that every match passes
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
GENERALISE, REMOVE, MIN_BITS = 0.8, 0.95, 5
SHRINK = 1
BLOCK = 256
TERM = r"[\p{L}\p{N}]++(?:[-_.'][\p{L}\p{N}]++)*+"


def running(lengths: Column) -> Column:
    """Running sums of an array of numbers, without the last: sums of blocks, then sums within a block."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    def with_blocks(array: Column, blocks: Column) -> Column:
        return let(F.transform(blocks, lambda _, i: total(F.slice(blocks, F.lit(1), i))), lambda offsets: F.transform(
            array, lambda _, i: F.get(offsets, F.floor(i / BLOCK).cast("int")) + total(F.slice(
                array, (F.floor(i / BLOCK) * BLOCK + 1).cast("int"), (i % BLOCK).cast("int")))))

    starts = lambda array: F.sequence(F.lit(0), F.floor((F.size(array) - 1) / BLOCK).cast("int"))
    return let(lengths, lambda array: let(
        F.transform(starts(array), lambda b: total(F.slice(array, b * BLOCK + 1, F.lit(BLOCK)))),
        lambda blocks: with_blocks(array, blocks)))


def matches(text: Column, pattern: str) -> Column:
    """Matches as (value, start, end) in code points, end exclusive."""
    def located(found: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, f: F.struct(
            F.length(p).cast("long").alias("gap"), F.length(f).cast("long").alias("own"), f.alias("value")))
        return let(steps, lambda s: let(
            running(F.transform(s, lambda x: x["gap"] + x["own"])),
            lambda before: F.zip_with(s, before, lambda x, b: F.struct(
                x["value"].alias("value"), (b + x["gap"]).alias("start"), (b + x["gap"] + x["own"]).alias("end")))))

    empty = F.array().cast("array<struct<value:string,start:bigint,end:bigint>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.size(found) > 0, located(found)).otherwise(empty))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does the check digit fit?  Every second digit from the right counts double."""
    def worth(d: Column, i: Column) -> Column:
        value = d.cast("int")
        return F.when(i % 2 == 0, value).when(value > 4, value * 2 - 9).otherwise(value * 2)

    figures = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), lambda i: worth(
        F.substr(digits, F.length(digits) - i, F.lit(1)), i))
    return F.aggregate(figures, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return let(digits_of(value), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits_of(value)).between(9, 15)
    return F.lit(True)


def entities(text: Column, kind: str) -> Column:
    found = F.filter(matches(text, PATTERNS[kind]), lambda m: valid(kind, m["value"]))
    if not NEEDED[kind]:
        return found
    return F.when(F.contains(text, F.lit(NEEDED[kind])), found).otherwise(
        F.array().cast("array<struct<value:string,start:bigint,end:bigint>>"))


def base_spans() -> Column:
    """All base matches as (start, rank of the kind, end, kind), in order."""
    def of(kind: str, rank: int) -> Column:
        return F.transform(kind, lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))

    return F.array_sort(F.concat(*[of(k, i) for i, k in enumerate(PATTERNS)]))


def entity_names() -> Column:
    """The different entities, each as kind:value in lower case."""
    def of(kind: str) -> Column:
        return F.transform(kind, lambda m: F.concat(F.lit(f"{kind}:"), F.lower(m["value"])))

    return F.array_distinct(F.concat(*map(of, PATTERNS)))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def found_entities(docs: DataFrame, text: str, keep: list[str] | None) -> DataFrame:
    """(doc, n_email, .., n_phone, base, names, digest, text): digest and text only where there is an entity."""
    doc = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("doc")
    rows = docs.select(doc, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    found = rows.withColumns({k: entities(F.col("text"), k) for k in PATTERNS})
    some = sum([F.size(k) for k in PATTERNS], F.lit(0)) > 0
    return found.select(
        "doc", *[F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS], base_spans().alias("base"),
        entity_names().alias("names"), F.when(some, F.sha2("text", 256)).alias("digest"), F.when(some, F.col("text")).alias("text"))


def line_terms(line: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(line, F.lit(TERM), F.lit(0)), F.lower))


def terms_beside(line: Column, name: Column) -> Column:
    """The different terms of a line that do not overlap a span of the named entity itself."""
    own = F.filter(F.concat(*[F.transform(k, lambda m: F.struct(F.concat(F.lit(f"{k}:"), F.lower(m["value"])).alias("name"), m["start"].alias("start"), m["end"].alias("end")))
                              for k in PATTERNS]), lambda m: m["name"] == name)
    return let(own, lambda spans: F.array_distinct(F.transform(F.filter(matches(line, TERM), lambda t: ~F.exists(
        spans, lambda o: (o["start"] < t["end"]) & (t["start"] < o["end"]))), lambda t: F.lower(t["value"]))))


def disclosures(docs: DataFrame, text: str, found: DataFrame) -> DataFrame:
    """(name, term, level): the terms that reveal an entity, level 1 for generalisation and 2 for removal."""
    lines = found.where("digest is not null").select(F.explode(F.split("text", "\n")).alias("line"))
    own = lines.withColumns({k: entities(F.col("line"), k) for k in PATTERNS})
    held = stored(own.select("line", F.explode(entity_names()).alias("name")).groupBy("name", "line").agg(F.count("*").alias("times")))
    # the corpus: lines with words
    every = docs.select(F.explode(F.split(F.col(f"`{text}`"), "\n")).alias("line"))
    total = every.where(F.col("line").rlike(WORD)).groupBy().agg(F.count("*").alias("n")).scalar()
    entity = stored(held.groupBy("name").agg(F.sum("times").alias("n_entity")).withColumn("total", total))
    # what stands in too many lines has too few bits to reveal, whatever its terms are
    telling = F.col("n_entity") * 2**MIN_BITS <= F.col("total")
    spans = held.join(entity.where(~telling), "name", "left_anti").withColumns({k: entities(F.col("line"), k) for k in PATTERNS})
    pairs = stored(spans.select("name", "times", F.explode(terms_beside(F.col("line"), F.col("name"))).alias("term")).groupBy(
        "name", "term").agg(F.sum("times").alias("n_both")))
    # for the terms in question the lines that hold them
    words = every.select(F.explode(line_terms(F.col("line"))).alias("term"))
    counts = preselected(words, F.col("term"), pairs.select("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    rated = pairs.join(counts, "term").join(entity.where(telling), "name")
    bits = F.log2((F.col("total") * F.col("n_both") / F.col("n_entity") + SHRINK) / (F.col("n_term") + SHRINK))
    rated = rated.withColumn("bits", F.round(bits, 9)).withColumn(
        "reveals", F.round(bits / F.log2(F.col("total") / F.col("n_entity")), 9))
    marked = rated.where((F.col("bits") >= MIN_BITS) & (F.col("reveals") >= GENERALISE))
    return marked.select("name", "term", F.when(F.col("reveals") >= REMOVE, 2).otherwise(1).alias("level"))


def marked_spans(found: DataFrame, terms: DataFrame) -> DataFrame:
    """(digest, added): the marked terms of each text with an entity, as spans that touch no base span.

    Terms stay rows until they are spans of their text: a text's words are looked up by (entity, term).
    """
    terms = stored(terms)
    texts = found.where("digest is not null").groupBy("digest").agg(
        F.first("text").alias("text"), F.first("names").alias("names"), F.first("base").alias("base"))
    free = F.filter(matches(F.col("text"), TERM), lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    words = texts.select("digest", F.explode(free).alias("w")).select("digest", F.lower("w.value").alias("term"), "w.start", "w.end")
    places = stored(preselected(words, F.col("term"), terms.select("term")).groupBy("digest", "term").agg(
        F.collect_list(F.struct("start", "end")).alias("places")))
    names = found.where("digest is not null").select("digest", F.explode("names").alias("name")).distinct()
    levels = places.select("digest", "term").join(names, "digest").join(terms, ["name", "term"]).groupBy("digest", "term").agg(
        F.max("level").alias("level"))  # removal outweighs generalisation
    kinds = {k: i for i, k in enumerate(KINDS)}
    remove = F.col("level") == 2
    spans = F.transform("places", lambda p: F.struct(
        p["start"].alias("start"), F.when(remove, kinds["remove"]).otherwise(kinds["generalise"]).alias("rank"), p["end"].alias("end"),
        F.when(remove, "remove").otherwise("generalise").alias("kind")))
    return places.join(levels, ["digest", "term"]).select("digest", spans.alias("spans")).groupBy("digest").agg(
        F.flatten(F.collect_list("spans")).alias("added"))


def find_personal_data(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc, n_email, n_ip, n_card, n_phone, base, spans): doc holds the kept columns (default all).

    Only texts with an entity are stored and shuffled, once for each different text.  The terms to be counted
    in the corpus are preselected by a broadcast table of at most ``FILTER_SLOTS`` hash slots, its proven bound.
    """
    found = stored(found_entities(docs, text, keep))
    added = marked_spans(found, disclosures(docs, text, found))
    columns = ["doc", *[f"n_{k}" for k in PATTERNS], "base"]
    rows = found.where("digest is not null").select(*columns, "digest").join(added, "digest", "left")
    both = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(rows.schema["base"].dataType))))
    # most documents have no entity, and take no part in the join
    others = found.where("digest is null").select(*columns, F.col("base").alias("spans"))
    return rows.select(*columns, both.alias("spans")).unionByName(others)
