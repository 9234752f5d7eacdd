"""Benchmark decontamination by template canonicalisation, in DataFrame expressions only.

Texts are split at white space. What a question can be re-parameterised by becomes a typed placeholder: numbers ``<num>``, numbers
with a unit attached ``<num><unit>``, a unit after a number ``<unit>``, a capitalised word after another word of its
sentence ``<name>``. All else is lower-cased and loses its punctuation; tokens that lose everything are dropped. The
replacements run over the whole text and keep its white space, so the n-th canonical token stems from the n-th raw
one. Windows of ``WINDOW`` canonical tokens of the benchmark (a shorter item is one window) are hash-joined with those of
every document; a window carries the raw values in its slots. What the first word of an item is depends on what precedes
it in a document (a heading without a full stop, a number), so its windows stand for every reading; in one that is not
the item's own, the word itself must be the same.

Windows of one item at one alignment make a match if they are at least ``coverage`` of the item's windows, or cover a run
of ``RUN`` canonical tokens of it without a gap. The slots
rate it: windows with the same fillings on both sides are literal, and are a match if they alone are enough. Otherwise
at least half of the slots must be consistent, that is follow a one-to-one map between the values of the item and of the
document, one map per type of placeholder, the commonest pairs of values first. So a copy with other numbers is found,
also if some of them became equal or different, and a chance template with unrelated fillings is not.

The documents' windows are broadcast-joined only with a list of distinct benchmark hashes that has been counted and
is within ``MAX_BROADCAST``; a larger benchmark goes through a shuffled join. Defined results: null text is empty;
empty texts and items match nothing; repeated rows match alike; an empty table or benchmark gives no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import let, stored, whole_text

WINDOW = 8
RUN = 13  # canonical tokens in a row that are a match whatever the item's length
MAX_BROADCAST = 1_000_000  # distinct window hashes, 8 bytes each

# fixed values: units that may follow a number
UNITS = (
    "percent km m cm mm miles mile feet foot inches inch kg g mg lb lbs pounds ounces tons l ml liters litres gallons "
    "seconds second minutes minute hours hour days day weeks week months month years year dollars dollar cents euros "
    "degrees mph km/h hz kb mb gb"
).split()

# Each pattern starts with the character class that is rare, and looks back from there.
_NAME = r"\p{Lu}(?<=[\p{L}\p{N}]\s\p{Lu})\p{Ll}+(?![\p{L}\p{N}])"
_NUMBER = r"[0-9](?<![\p{L}\p{N}][0-9])[0-9.,:/]*(?![\p{L}\p{N}%])"
_WITH_UNIT = r"[0-9](?<![\p{L}\p{N}][0-9])[0-9.,]*[\p{L}%]+(?![\p{L}\p{N}%])"
_UNIT = r"(?<=<num>\s)(?:" + "|".join(UNITS) + r")(?![\p{L}\p{N}])"


def canonical(text: Column) -> Column:
    """The text with typed placeholders, lower-cased, without punctuation; its white space is kept."""
    named = F.lower(F.regexp_replace(F.translate(text, "<>", ""), _NAME, "<name>"))

    def numbered(t: Column) -> Column:
        filled = F.regexp_replace(F.regexp_replace(t, _NUMBER, "<num>"), _WITH_UNIT, "<num><unit>")
        return F.when(F.rlike(t, F.lit("[0-9]")), F.regexp_replace(filled, _UNIT, "<unit>")).otherwise(t)

    return F.regexp_replace(let(named, numbered), r"[^\p{L}\p{N}\s<>]+", "")


def tokens(text: Column) -> Column:
    """array<struct<value, canonical>>: the raw tokens and what they stand for."""
    pairs = F.zip_with(
        F.split(text, r"\s"),
        F.split(canonical(text), r"\s"),
        lambda raw, form: F.struct(raw.alias("value"), form.alias("canonical")),
    )
    return F.filter(pairs, lambda t: t["canonical"] != "")


def _values(window: Column) -> Column:
    """What fills the placeholders of a window of tokens, in order; punctuation around it does not count."""
    slots = F.filter(window, lambda t: t["canonical"].startswith("<"))
    return F.transform(slots, lambda t: F.lower(F.regexp_replace(t["value"], r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}%]+$", "")))


def _windows(text: Column, lengths: list[int]) -> Column:
    """array<struct<at, hash, slots>> of all windows of the given lengths."""
    none = F.array().cast("array<struct<at:int,hash:bigint,slots:array<string>>>")
    no_slots = F.array().cast("array<string>")

    def of(hashes: Column, n: int, slots) -> Column:
        def window(i: Column) -> Column:
            hashed = F.xxhash64(*[F.get(hashes, i + d) for d in range(n)])
            return F.struct(i.alias("at"), hashed.alias("hash"), slots(i, n).alias("slots"))

        all_windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - n), window)
        return F.when(F.size(hashes) >= n, all_windows).otherwise(none)

    def plain(form: Column) -> Column:
        """Most texts have no placeholder: their raw tokens are not needed."""
        hashes = F.transform(F.filter(F.split(form, r"\s"), lambda t: t != ""), lambda t: F.xxhash64(t))
        return let(hashes, lambda h: F.concat(*[of(h, n, lambda i, n: no_slots) for n in lengths]))

    def filled(parsed: Column) -> Column:
        def every(h: Column) -> Column:
            return F.concat(*[of(h, n, lambda i, n: _values(F.slice(parsed, i + 1, n))) for n in lengths])

        return let(F.transform(parsed, lambda t: F.xxhash64(t["canonical"])), every)

    if not lengths:
        return none
    return let(
        canonical(text),
        lambda form: F.when(F.contains(form, F.lit("<")), let(tokens(text), filled)).otherwise(plain(form)),
    )


def _consistent(fillings: Column) -> Column:
    """How many of the slots follow a one-to-one map of values per type; equal values and frequent pairs map first."""
    pairs = F.transform(fillings, lambda f: F.struct(f["kind"].alias("kind"), f["ours"].alias("ours"), f["theirs"].alias("theirs")))

    def mapped(every: Column) -> Column:
        def ranked(p: Column) -> Column:
            n = F.size(F.filter(every, lambda q: q == p))
            return F.struct((-n).alias("order"), (p["ours"] != p["theirs"]).alias("other"), p.alias("pair"), n.alias("n"))

        def add(done: Column, r: Column) -> Column:
            p = r["pair"]
            taken = F.exists(
                done["map"], lambda q: (q["kind"] == p["kind"]) & ((q["ours"] == p["ours"]) | (q["theirs"] == p["theirs"]))
            )
            longer = F.struct((done["n"] + r["n"]).alias("n"), F.concat(done["map"], F.array(p)).alias("map"))
            return F.when(taken, done).otherwise(longer)

        none = F.struct(F.lit(0).alias("n"), F.array().cast("array<struct<kind:string,ours:string,theirs:string>>").alias("map"))
        order = F.array_sort(F.transform(F.array_distinct(every), ranked))
        return F.aggregate(order, none, add, lambda done: done["n"])

    return let(pairs, mapped)


def _run(places: Column) -> Column:
    """The length of the longest run of consecutive numbers among distinct ones."""

    def add(done: Column, at: Column) -> Column:
        now = F.when(at == done["last"] + 1, done["now"] + 1).otherwise(F.lit(1))
        return F.struct(at.alias("last"), now.alias("now"), F.greatest(done["best"], now).alias("best"))

    none = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("now"), F.lit(0).alias("best"))
    return F.aggregate(F.array_sort(places), none, add, lambda done: done["best"])


def _benchmark(items: DataFrame) -> DataFrame:
    """(item, n, hash, at, slots, windows, reading) of every window of the benchmark, the first ones in every reading."""
    text = F.regexp_replace(whole_text(), r"^\s+", "")
    capital, small = [F.concat(of(F.substring(text, 1, 1)), F.substring(text, F.lit(2), F.length(text))) for of in (F.upper, F.lower)]
    # after a digit and a space the first word is a name if it can be one, or a unit
    after = [F.filter(tokens(F.concat(F.lit("1 "), t)), lambda x, i: i > 0) for t in (capital, small)]
    own = tokens(text)
    forms = [F.transform(t, lambda x: x["canonical"]) for t in (own, *after)]
    other = [F.when(form != forms[0], t) for form, t in zip(forms[1:], after)]
    readings = F.array_distinct(F.filter(F.array(own, *other), lambda t: t.isNotNull()))
    parsed = items.select(F.col("item_id").alias("item"), F.posexplode(readings).alias("reading", "tokens"))
    parsed = parsed.filter(F.size("tokens") > 0).withColumn("n", F.least(F.size("tokens"), F.lit(WINDOW)))
    parsed = parsed.withColumn("windows", F.size("tokens") - F.col("n") + 1)
    # only windows that hold the first word differ between the readings
    last = F.when(F.col("reading") == 0, F.col("windows") - 1).otherwise(F.lit(0))
    at = parsed.select("*", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    # a hash of hashes, as of the documents' windows
    hashes = F.transform(F.slice("tokens", F.col("at") + 1, F.col("n")), lambda t: F.xxhash64(t["canonical"]))
    by_length = F.coalesce(
        *[
            F.when(F.col("n") == n, F.xxhash64(*[F.get(F.col("hashes"), F.lit(d)) for d in range(n)]))
            for n in range(1, WINDOW + 1)
        ]
    )
    at = at.withColumn("hashes", hashes).withColumn("hash", by_length)
    held = F.slice(F.col("tokens"), F.col("at") + 1, F.col("n"))
    kinds = F.transform(held, lambda t, i: F.struct((F.col("at") + i).alias("place"), t["canonical"].alias("kind")))
    places = F.filter(kinds, lambda k: k["kind"].startswith("<"))
    slots = F.zip_with(
        places, _values(held), lambda k, v: F.struct(k["place"].alias("place"), k["kind"].alias("kind"), v.alias("value"))
    )
    return at.select("item", "n", "hash", "at", slots.alias("slots"), "windows", "reading")


def find_contamination(docs: DataFrame, items: DataFrame, coverage: float = 0.25) -> DataFrame:
    """(doc_id, text_hash, item_id, matched, windows, exact): the best alignment of every item that a document holds."""
    benchmark = stored(_benchmark(items), "benchmark-windows", narrow=True)
    lengths = sorted(r["n"] for r in benchmark.select("n").distinct().collect())  # at most WINDOW of them
    wanted = benchmark.select("hash").distinct()
    if wanted.count() <= MAX_BROADCAST:
        wanted = F.broadcast(wanted)
    text = whole_text()
    all_windows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.explode(_windows(text, lengths)).alias("w"))
    hits = all_windows.select("doc_id", "text_hash", F.col("w.at").alias("doc_at"), "w.hash", F.col("w.slots").alias("doc_slots"))
    hits = stored(hits.join(wanted, "hash", "left_semi").distinct(), "window-hits", narrow=True)
    same_word = (F.col("reading") == 0) | (F.get("slots", F.lit(0))["value"] == F.get("doc_slots", F.lit(0)))
    met = hits.join(benchmark, "hash").filter(same_word).select(
        "doc_id",
        "text_hash",
        F.col("item").alias("item_id"),
        (F.col("doc_at") - F.col("at")).alias("shift"),
        "at",
        "windows",
        "n",
        F.zip_with(
            "slots",
            "doc_slots",
            lambda s, v: F.struct(s["place"].alias("place"), s["kind"].alias("kind"), s["value"].alias("ours"), v.alias("theirs")),
        ).alias("fillings"),
    )
    met = met.withColumn("literal", F.forall("fillings", lambda f: f["ours"] == f["theirs"]))
    # a window each per place of the item: no more rows in a group than the item has windows
    aligned = met.groupBy("doc_id", "text_hash", "item_id", "shift", "windows", "n").agg(
        F.collect_set("at").alias("all"),
        F.collect_set(F.when(F.col("literal"), F.col("at"))).alias("literal"),
        F.array_distinct(F.flatten(F.collect_set("fillings"))).alias("fillings"),
    )

    def enough(places: str) -> Column:
        share = F.size(places) >= F.ceil(coverage * F.col("windows"))
        return share | (_run(F.col(places)) + F.col("n") - 1 >= RUN)

    consistent = 2 * _consistent(F.col("fillings")) >= F.size("fillings")
    exact = F.forall("fillings", lambda f: f["ours"] == f["theirs"])
    matches = aligned.filter(enough("all")).filter(enough("literal") | consistent).withColumn("matched", F.size("all").cast("long"))
    best = F.max(F.struct("matched", exact.alias("exact"), "windows"))
    return (
        matches.groupBy("doc_id", "text_hash", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "text_hash", "item_id", "best.matched", "best.windows", "best.exact")
    )


def decontaminate(docs: DataFrame, items: DataFrame, coverage: float = 0.25) -> DataFrame:
    """The documents that hold no benchmark item, all columns."""
    found = find_contamination(docs, items, coverage).select("doc_id", "text_hash").distinct()
    found = found.toDF("held_id", "held_hash")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", F.xxhash64(whole_text()).alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.col("text_hash") == F.col("held_hash"))
    return rows.join(found, same, "left_anti").select("doc.*")
