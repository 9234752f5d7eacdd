"""Personal data: exact patterns, and terms that disclose them by corpus co-occurrence.

The patterns give spans of four kinds: email, ip, card, phone. The information-theoretic part asks of
every term near such a span how much of the entity it gives away. With p(k) the share of distinct texts that hold an
entity of kind k and p(k | t) the share of the term's texts that have the term near one, the term discloses

    PMI(t; k) / IC(k) = 1 - log p(k | t) / log p(k)

of the entity's information content: 0 when they are independent, 1 when the term always comes with it. Terms at
or above ``threshold``, seen in at least ``support`` different contexts (copies of a context count once), are spans of kind
``term`` wherever they stand near an entity of that kind.

The same is asked of every single entity, a value v (an address in lower case, a number by its digits), over whole texts: p(v)
is the share of distinct texts that hold v and p(v | t) the share of the distinct texts with t anywhere that hold v. Terms at or
above ``threshold`` that stand beside v, outside all spans, in at least ``support`` distinct texts are spans of kind ``term``
wherever they stand in any text, with or without an entity, except inside one.

A term is a run of at least three letters, lower-cased; near a span, one that lies wholly within ``REACH`` code points. Spans are in
code points, end exclusive. ``sanitise`` replaces entities by their kind and generalises disclosing
terms to ``[TERM]``. DataFrame expressions only.

Defined results: null text is empty and has no span; overlapping spans of different kinds are all reported, and replaced as
one by the kind of the first; repeated rows are scanned each and, unless ``count_copies`` asks for shares of rows near
entities of a kind, counted once; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import let, stored, whole_text

REACH = 40
KINDS = ("email", "ip", "card", "phone")

# Possessive quantifiers where the next character cannot be in the class: same matches, no backtracking into long runs.
# A run can only start a match at its beginning or where the last match ended.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_TRIGGERS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_TERM = r"\p{L}{3,}+"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
MAX_LISTED = 1000
_RUN = 256
_BLOCK = 1024
_SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Digit strings of at most 19."""

    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + value(i))
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.rlike(match, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
    if kind == "card":
        n = F.length(_digits(match))
        return F.when((n >= 16) & (n <= 19), _luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """``step`` folded over whole numbers from 0, its result at every element.

    A fold that appends copies what it has: appended are ``_RUN`` elements at most, and then runs of them.
    """
    numbers = "array<bigint>"

    def folded(values: Column) -> Column:
        def run(done: Column, at: Column) -> Column:
            def add(inner: Column, value: Column) -> Column:
                return let(
                    step(inner["last"], value),
                    lambda now: F.struct(now.alias("last"), F.concat(inner["all"], F.array(now)).alias("all")),
                )

            start = F.struct(done["last"].alias("last"), F.array().cast(numbers).alias("all"))
            return let(
                F.aggregate(F.slice(values, at + 1, F.lit(_RUN)), start, add),
                lambda r: F.struct(r["last"].alias("last"), F.concat(done["runs"], F.array(r["all"])).alias("runs")),
            )

        start = F.struct(F.lit(0).cast("long").alias("last"), F.array().cast(f"array<{numbers}>").alias("runs"))
        runs = F.aggregate(F.sequence(F.lit(0), F.size(values) - 1, F.lit(_RUN)), start, run)["runs"]
        return F.when(F.size(values) > 0, F.flatten(runs)).otherwise(F.array().cast(numbers))

    return let(values, folded)


def _blocks(text: Column) -> Column:
    """The text in strings of ``_BLOCK`` code points, to cut pieces from without a walk from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}+"), F.lit(0))


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from start to end, exclusive, of a text given in blocks; beyond its end there is nothing."""
    first = F.floor(start / _BLOCK).cast("int")
    count = F.floor((F.greatest(end, start + 1) - 1) / _BLOCK).cast("int") - first + 1
    joined = F.array_join(F.slice(blocks, first + 1, count), "")
    return F.substring(joined, (start % _BLOCK + 1).cast("int"), (end - start).cast("int"))


def _located(text: Column, pattern: str | Column) -> Column:
    """array<struct<start, end, match>> of all matches, leftmost and non-overlapping.

    What lies between the matches is what splitting leaves, so the lengths of both add up to the places.
    """

    def add(parts: Column) -> Column:
        matches, gaps = parts["matches"], parts["gaps"]
        lengths = F.transform(matches, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("long"))

        def spans(ends: Column) -> Column:
            def span(m: Column, i: Column) -> Column:
                end = F.get(ends, i)
                return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"))

            return F.transform(matches, span)

        return let(_running(lengths, lambda done, n: done + n), spans)

    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    return let(F.struct(matches.alias("matches"), F.split(text, pattern, -1).alias("gaps")), add)


def entity_spans(text: Column) -> Column:
    """All spans of the patterns, by kind as listed, then start."""

    def of(kind: str) -> Column:
        pattern, trigger = PATTERNS[kind], _TRIGGERS[kind]
        possible = F.contains(text, F.lit(trigger)) if trigger else F.rlike(text, F.lit(r"[0-9][\x20-]?[0-9]"))
        valid = F.filter(_located(text, pattern), lambda m: _valid(kind, m["match"]))
        spans = F.transform(
            valid, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
        )
        return F.when(possible, spans).otherwise(F.array().cast(_SPAN))

    return F.concat(*[of(kind) for kind in KINDS])


def _terms_near(blocks: Column, span: Column) -> Column:
    """array<struct<start, end, match>>: whole terms within reach of a span, lower-cased."""

    def side(first: Column, last: Column) -> Column:
        """Runs of letters in text[first, last) that are cut at neither end."""
        wide_first = F.greatest(first - 1, F.lit(0))
        located = let(_cut(blocks, wide_first, last + 1), lambda window: _located(window, _TERM))
        moved = F.transform(
            located,
            lambda m: F.struct(
                (m["start"] + wide_first).alias("start"),
                (m["end"] + wide_first).alias("end"),
                F.lower(m["match"]).alias("match"),
            ),
        )
        return F.filter(moved, lambda m: (m["start"] >= first) & (m["end"] <= last))

    left = side(F.greatest(span["start"] - REACH, F.lit(0)), span["start"])
    right = side(span["end"], span["end"] + REACH)
    return F.concat(left, right)


def _scanned(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Stored rows (row, digest, kept, spans, near, entities, words): the patterns run once over every text.

    ``near`` has each term beside each entity, with a hash of what surrounds the entity. ``entities`` has the distinct values,
    ``words`` the terms of a text that has any, and whether they stand outside the spans.
    """
    text = whole_text()
    kept = F.struct(*[F.col(c) for c in keep]).alias("kept")
    rows = docs.select(kept, text.alias("text")).withColumn("spans", entity_spans(F.col("text")))
    # several columns are made of them, so they are made once; texts without a span need none
    blocks = F.when(F.size("spans") > 0, _blocks(F.col("text"))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("blocks", blocks)

    def beside(span: Column) -> Column:
        first = F.greatest(span["start"] - REACH, F.lit(0))
        around = F.concat_ws(
            "|", _cut(F.col("blocks"), first, span["start"]), _cut(F.col("blocks"), span["end"], span["end"] + REACH)
        )
        return let(
            F.xxhash64(around),
            lambda context: F.transform(
                _terms_near(F.col("blocks"), span),
                lambda t: F.struct(
                    span["kind"].alias("kind"),
                    t["match"].alias("term"),
                    t["start"].alias("start"),
                    t["end"].alias("end"),
                    context.alias("context"),
                ),
            ),
        )

    near = F.flatten(F.transform("spans", beside))

    def marked(words: Column, outside: bool) -> Column:
        long = F.filter(words, lambda t: F.length(t) >= 3)
        return F.transform(long, lambda t: F.struct(t.alias("term"), F.lit(outside).alias("outside")))

    outside = sanitise(F.col("text"), F.transform("spans", lambda s: s.withField("kind", F.lit(""))))
    words = let(
        F.struct(_words(F.col("text")).alias("all"), _words(outside).alias("outside")),
        lambda w: F.concat(
            marked(F.array_intersect(w["all"], w["outside"]), True), marked(F.array_except(w["all"], w["outside"]), False)
        ),
    )
    return stored(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            _digest(F.col("text")).alias("digest"),
            "kept",
            "spans",
            near.alias("near"),
            _entities(F.col("blocks"), F.col("spans")).alias("entities"),
            F.when(F.size("spans") > 0, words).alias("words"),
        ),
        "pii",
    )


def _words(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+"))


def _digest(text: Column) -> Column:
    return F.md5(F.encode(text, "UTF-8"))


def _entities(blocks: Column, spans: Column) -> Column:
    """array<struct<kind, value>> of the distinct values; told apart as strings, which are hashed."""

    def named(span: Column) -> Column:
        match = _cut(blocks, span["start"], span["end"])
        value = F.when(span["kind"].isin("card", "phone"), _digits(match)).otherwise(F.lower(match))
        return F.concat(span["kind"], F.lit(":"), value)

    def parts(name: Column) -> Column:
        kind = F.substring_index(name, ":", 1)
        return F.struct(kind.alias("kind"), F.substring(name, F.length(kind) + 2, F.length(name)).alias("value"))

    return F.transform(F.array_distinct(F.transform(spans, named)), parts)


def _texts_with(docs: DataFrame, count_copies: bool = False) -> DataFrame:
    """(term, texts): the number of distinct texts, or of rows, that hold a term."""
    texts = docs.select(whole_text().alias("text"))
    return (
        (texts if count_copies else texts.distinct())
        .select(F.explode(_words(F.col("text"))).alias("term"))
        .filter(F.length("term") >= 3)
        .groupBy("term")
        .agg(F.count("*").alias("texts"))
    )


def revealing_terms(
    everywhere: Callable[[], DataFrame], scanned: DataFrame, threshold: float, support: int
) -> DataFrame | None:
    """(term) of those that disclose a single entity; counts are of distinct texts. None if no entity is in enough texts.

    ``everywhere()`` gives (term, texts), the number of distinct texts with a term.
    """
    held = scanned.filter(F.size("entities") > 0)
    values = held.select("digest", F.explode("entities").alias("entity")).distinct().groupBy("entity")
    values = stored(values.agg(F.count("*").alias("with_value")).filter(F.col("with_value") >= support), "entities", narrow=True)
    if values.isEmpty():
        return None
    total = scanned.select("digest").distinct().count()
    # one row per distinct text; only entities in enough texts meet its words
    texts = held.groupBy("digest").agg(F.min("row").alias("row"))
    texts = held.select("row", "entities", "words").join(texts.select("row"), "row", "left_semi")
    pairs = texts.select(F.explode("entities").alias("entity"), "words").join(values.select("entity"), "entity", "left_semi")
    together = (
        pairs.select("entity", F.explode("words").alias("word"))
        .groupBy("entity", F.col("word.term").alias("term"))
        .agg(F.count("*").alias("together"), F.count_if("word.outside").alias("beside"))
        .filter(F.col("beside") >= support)
    )
    given = F.least(F.col("together") / F.col("texts"), F.lit(1.0))
    disclosure = F.when(F.col("with_value") >= total, F.lit(0.0)).otherwise(
        1 - F.log(given) / F.log(F.col("with_value") / F.lit(total))
    )
    known = together.join(values, "entity").join(everywhere(), "term")
    return known.filter(disclosure >= threshold).select("term").distinct()


def _revealed(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(digest, anywhere): the places of the terms in every distinct text that has one.

    Places move, not texts; those of copies are the same and combine before the shuffle. A list of at most ``MAX_LISTED`` terms
    goes into the plan, so that only texts with one of them are searched for places; a longer one is joined with all places.
    """
    text = whole_text()
    places = F.transform(
        _located(text, _TERM),
        lambda m: F.struct(F.lower(m["match"]).alias("term"), m["start"].alias("start"), m["end"].alias("end")),
    )
    listed = [r["term"] for r in terms.limit(MAX_LISTED + 1).collect()]
    if len(listed) <= MAX_LISTED:
        wanted = F.split(F.lit(" ".join(sorted(listed))), " ")  # terms are letters only
        docs = docs.filter(F.arrays_overlap(F.split(F.lower(text), r"[^\p{L}]+"), wanted))
        places = F.filter(places, lambda p: F.array_contains(wanted, p["term"]))
    found = docs.select(_digest(text).alias("digest"), F.explode(places).alias("place"))
    found = found.select("digest", "place.*").join(terms, "term", "left_semi")
    span = F.struct(F.lit("term").alias("kind"), "start", "end")
    return found.groupBy("digest").agg(F.sort_array(F.collect_set(span)).alias("anywhere"))


def disclosing_terms(
    everywhere: DataFrame, scanned: DataFrame, threshold: float, support: int, count_copies: bool
) -> DataFrame:
    """(term, kind, disclosure) at or above the threshold; counts are of distinct texts, or of all rows.

    ``everywhere`` is (term, texts), the number of them that hold a term.

    Every count combines before its shuffle, so a term in a third of all texts is one row per task.
    """
    of = "row" if count_copies else "digest"
    total = scanned.select(of).distinct().count()
    kinds = (
        scanned.select(of, F.explode(F.array_distinct(F.transform("spans", lambda s: s["kind"]))).alias("kind"))
        .distinct()
        .groupBy("kind")
        .agg(F.count("*").alias("with_kind"))
    )
    pairs = F.array_distinct(F.transform("near", lambda t: F.struct(t["kind"].alias("kind"), t["term"].alias("term"))))
    together = (
        scanned.select(of, F.explode(pairs).alias("pair"))
        .distinct()
        .groupBy("pair.kind", "pair.term")
        .agg(F.count("*").alias("together"))
    )
    contexts = (
        scanned.select(F.explode("near").alias("near"))
        .select("near.kind", "near.term", "near.context")
        .distinct()
        .groupBy("kind", "term")
        .agg(F.count("*").alias("contexts"))
    )
    informed = (
        contexts.filter(F.col("contexts") >= support)
        .join(together, ["kind", "term"])
        .join(kinds, "kind")
        .join(everywhere, "term")
    )
    given = F.least(F.col("together") / F.col("texts"), F.lit(1.0))
    disclosure = F.when(F.col("with_kind") >= total, F.lit(0.0)).otherwise(
        1 - F.log(given) / F.log(F.col("with_kind") / F.lit(total))
    )
    return informed.select("term", "kind", disclosure.alias("disclosure")).filter(F.col("disclosure") >= threshold)


def _free(spans: Column, places: Column) -> Column:
    """The places that overlap no span: no span that starts before a place's end reaches beyond its start."""
    begun = F.transform(
        spans, lambda x: F.struct(x["start"].alias("at"), F.lit(1).alias("is_span"), x["end"].alias("reach"), x.alias("place"))
    )
    asked = F.transform(
        places,
        lambda x: F.struct(x["end"].alias("at"), F.lit(0).alias("is_span"), F.lit(0).cast("long").alias("reach"), x.alias("place")),
    )

    def kept(bounds: Column) -> Column:
        reached = _running(F.transform(bounds, lambda b: b["reach"]), F.greatest)
        pairs = F.zip_with(bounds, reached, lambda b, r: F.struct(b["is_span"].alias("is_span"), b["place"].alias("place"), r.alias("reached")))
        free = F.filter(pairs, lambda b: (b["is_span"] == 0) & (b["reached"] <= b["place"]["start"]))
        return F.transform(free, lambda b: b["place"])

    return let(F.array_sort(F.concat(begun, asked)), kept)


def find_personal_data(
    docs: DataFrame, keep: list[str], threshold: float = 0.9, support: int = 5, count_copies: bool = True
) -> DataFrame:
    """(kept, spans) per row: a struct of the columns to keep, and all spans, entities first.

    With ``count_copies`` the shares near entities of a kind are of rows, without of distinct texts.
    """
    scanned = _scanned(docs, keep)
    # one count of all terms serves both questions
    everywhere = stored(_texts_with(docs, count_copies), "terms-everywhere", narrow=True)
    terms = stored(disclosing_terms(everywhere, scanned, threshold, support, count_copies), "terms", narrow=True)
    near = scanned.filter(F.size("near") > 0).select("row", F.explode("near").alias("near"))
    near = near.select("row", "near.kind", "near.term", "near.start", "near.end")
    flagged = near.join(terms, ["term", "kind"], "left_semi").groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct(F.lit("term").alias("kind"), "start", "end"))).alias("terms")
    )
    rows = scanned.join(flagged, "row", "left")
    none = F.array().cast(_SPAN)
    found = F.coalesce("terms", none)
    distinct_texts = (lambda: _texts_with(docs)) if count_copies else (lambda: everywhere)
    revealing = revealing_terms(distinct_texts, scanned, threshold, support)
    if revealing is not None:
        revealing = stored(revealing, "revealing-terms", narrow=True)
    if revealing is not None and not revealing.isEmpty():
        rows = rows.join(_revealed(docs, revealing), "digest", "left")
        found = F.array_sort(F.array_union(found, _free(F.col("spans"), F.coalesce("anywhere", none))))
    return rows.select("kept", F.concat("spans", found).alias("spans"))


def sanitise(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    places = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def rebuild(places: Column, reached: Column, blocks: Column) -> Column:
        def headed(place: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(reached, i - 1)).otherwise(F.lit(0).cast("long"))
            return F.struct(place["start"].alias("start"), place["kind"].alias("kind"), before.alias("before"))

        # a run of overlapping spans starts where all before have ended
        heads = F.filter(F.transform(places, headed), lambda h: h["start"] >= h["before"])
        pieces = F.transform(
            heads, lambda h: F.concat(_cut(blocks, h["before"], h["start"]), F.lit("["), F.upper(h["kind"]), F.lit("]"))
        )
        tail = _cut(blocks, F.element_at(reached, -1), F.length(text).cast("long"))
        return F.concat(F.array_join(pieces, ""), tail)

    def parts(places: Column) -> Column:
        reached = _running(F.transform(places, lambda p: p["end"]), F.greatest)
        values = F.struct(reached.alias("reached"), _blocks(text).alias("blocks"))
        return let(values, lambda v: rebuild(places, v["reached"], v["blocks"]))

    return F.when(F.size(spans) > 0, let(places, parts)).otherwise(text)
