"""Document fingerprints from closed syncmers, in DataFrame expressions only.

A text's units are its runs of anything but white space (case kept), long runs in pieces of ``LONGEST`` code points, and single code
points in scripts that are written without spaces; this holds for texts of any length. A text is framed by marks, so short ones have windows too.
Of the windows of ``K`` units those are *closed syncmers*, whose smallest sub-window of ``S`` units, by hash, lies at either edge
of the window. Whether a window is chosen depends on nothing outside it, so equal passages have equal anchors wherever they stand;
``anchors`` lists them with their positions.

The fingerprint has all anchors in the order of their positions, 16 hex digits each; the c-th occurrence of an anchor has a hash of its own.
*Positional matching*: equal hashes of two fingerprints are matches, and a match counts if it keeps the order of the others. Counted are
the matches that lie behind all matches before them, or, if there are more, those that lie before all matches after them; both are
chains of matches in the same order on both sides. The likeness is twice their number over the number of anchors on both sides: an insertion, an
edit or one passage moved away costs what it changes, passages in another order do not match.

Defined results: null text is empty; the empty text has the empty fingerprint, like itself (1) and unlike any other (0).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import let, shuffle_width, whole_text

K, S = 4, 2  # units in a window, and in its sub-windows
LONGEST = 16  # code points in a unit
# Thai and Lao, Myanmar, Khmer, kana, Han and its compatibility forms and extensions.
UNSPACED = r"฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\x{20000}-\x{3FFFF}"
UNIT = rf"[{UNSPACED}]|[^\s{UNSPACED}]{{1,{LONGEST}}}"
_FRAME = 0  # stands for what is before and after a text


def _framed(text: Column) -> Column:
    """Hashes of the units, between K - 1 marks at either end; none for a text without units."""
    hashes = F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), lambda u: F.xxhash64(u))
    marks = F.array(*[F.lit(_FRAME).cast("bigint")] * (K - 1))
    return let(hashes, lambda h: F.when(F.size(h) > 0, F.concat(marks, h, marks)).otherwise(h))


def anchors(text: Column) -> Column:
    """array<struct<position int, hash long>> of the closed syncmers; positions count units from 0 and are negative in the frame."""

    def chosen(h: Column, pieces: Column) -> Column:
        ends = K - S

        def closed(i: Column) -> Column:
            inner = [F.get(pieces, i + d) for d in range(1, ends)]
            edge = F.least(F.get(pieces, i), F.get(pieces, i + ends))
            return reduce(lambda x, y: x & y, [edge <= p for p in inner])

        def anchor(i: Column) -> Column:
            hashed = F.xxhash64(*[F.get(h, i + d) for d in range(K)])
            return F.struct((i - (K - 1)).alias("position"), hashed.alias("hash"))

        every = F.transform(F.filter(F.sequence(F.lit(0), F.size(h) - K), closed), anchor)
        return F.when(F.size(h) > 0, every).otherwise(F.array().cast("array<struct<position:int,hash:bigint>>"))

    def with_pieces(h: Column) -> Column:
        pieces = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + d) for d in range(1, S)]))
        return let(pieces, lambda p: chosen(h, p))

    return let(_framed(text), with_pieces)


def _numbered(hashes: Column) -> Column:
    """Each hash made unique by the number of its occurrence, from 1, in the order given."""

    def slow(hashes: Column) -> Column:
        def by_runs(ordered: Column) -> Column:
            starts = F.filter(
                F.transform(ordered, lambda x, j: F.when((j == 0) | (x["hash"] != F.get(ordered, j - 1)["hash"]), j)),
                lambda j: j.isNotNull(),
            )

            def run(first: Column, r: Column, starts: Column) -> Column:
                n = F.coalesce(F.get(starts, r + 1), F.size(ordered)) - first

                def member(c: Column) -> Column:
                    x = F.get(ordered, first + c - 1)
                    return F.struct(x["at"].alias("at"), F.xxhash64(x["hash"], c).alias("key"))

                return F.transform(F.sequence(F.lit(1), n), member)

            return let(starts, lambda s: F.flatten(F.transform(s, lambda first, r: run(first, r, s))))

        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
        return F.transform(F.sort_array(let(ordered, by_runs)), lambda x: x["key"])

    unique = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(unique, F.transform(hashes, lambda h: F.xxhash64(h, F.lit(1)))).otherwise(slow(hashes))


def sketch(text: Column) -> Column:
    """The hashes of the anchors in the order of the text, each one once."""
    return let(F.transform(anchors(text), lambda a: a["hash"]), _numbered)


def fingerprint(sketched: Column) -> Column:
    """A sketch as text, 16 hex digits per hash."""
    return F.array_join(F.transform(sketched, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Between two sketches: 0 to 1."""

    def tagged(hashes: Column, side: int) -> Column:
        return F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), F.lit(side).alias("side"), i.alias("at")))

    def matches(both: Column) -> Column:
        """(place in a, place in b) of equal hashes, which lie side by side."""

        def pair(x: Column, i: Column) -> Column:
            following = F.get(both, i + 1)
            found = F.struct(x["at"].alias("ours"), following["at"].alias("theirs"))
            return F.when(x["hash"] == following["hash"], found)

        return F.sort_array(F.filter(F.transform(both, pair), lambda x: x.isNotNull()))

    def chain(pairs: Column, start: int, follows) -> Column:
        none = F.struct(F.lit(start).alias("last"), F.lit(0).alias("n"))

        def add(done: Column, x: Column) -> Column:
            longer = F.struct(x["theirs"].alias("last"), (done["n"] + 1).alias("n"))
            return F.when(follows(x["theirs"], done["last"]), longer).otherwise(done)

        return F.aggregate(pairs, none, add, lambda done: done["n"])

    def longest(pairs: Column) -> Column:
        behind = chain(pairs, -1, lambda at, last: at > last)
        before = chain(F.reverse(pairs), (1 << 31) - 1, lambda at, last: at < last)
        return F.greatest(behind, before)

    def in_order(common: Column) -> Column:
        """Of the common hashes, as either side orders them; mostly both do alike."""
        ours, theirs = common["ours"], common["theirs"]
        both = F.sort_array(F.concat(tagged(ours, 0), tagged(theirs, 1)))
        return F.when(ours == theirs, F.size(ours)).otherwise(let(let(both, matches), longest))

    total = F.size(a) + F.size(b)
    common = F.struct(F.array_intersect(a, b).alias("ours"), F.array_intersect(b, a).alias("theirs"))
    return F.when(total == 0, F.lit(1.0)).otherwise(2 * let(common, in_order) / total)


def _bounds(docs: DataFrame) -> list[int]:
    """Some doc_ids, ascending, that cut the documents into parts; the last is the greatest. At most one a shuffle partition."""
    width = shuffle_width(docs.sparkSession)
    shares = [(i + 1) / width for i in range(width)]
    found = docs.agg(F.percentile_approx(_key(), shares, 10 * width).alias("some"), F.max(_key()).alias("last")).head()
    return sorted({*(found["some"] or []), *([] if found["last"] is None else [found["last"]])})


def _key() -> Column:
    """doc_id for ordering and ranges; a null one comes after all others, which sorting sees to."""
    return F.coalesce("doc_id", F.lit(-(2**63)))


def with_successors(docs: DataFrame) -> DataFrame:
    """(doc_id, text, own, next) of every document; own is its sketch, next the successor's text and sketch.

    The successor is the next document by descending doc_id, after the last the first; nulls are the smallest ids. Rows of one
    doc_id share a successor; a doc_id that occurs more than once is, as a successor, its smallest text.

    Texts are shuffled once, into ranges of doc_id. The first document of a range goes to the range before it, too, so each successor is found in
    the same task, with the sketch made there.
    """
    bounds = _bounds(docs)
    last = len(bounds) - 1
    every = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    at = F.size(F.filter(every, lambda b: b < F.col("_key")))
    first_of_range = F.array_contains(every, F.col("_key"))
    ghost = F.struct(F.when(F.col("_range") == last, 0).otherwise(F.col("_range") + 1).alias("range"), F.lit(True).alias("ghost"))
    here = F.struct(F.col("_range").alias("range"), F.lit(False).alias("ghost"))
    rows = docs.select("doc_id", whole_text().alias("text"), _key().alias("_key")).withColumn("_range", at)
    rows = rows.withColumn("place", F.explode(F.when(first_of_range, F.array(here, ghost)).otherwise(F.array(here))))
    rows = rows.select("doc_id", "text", "place.range", "place.ghost", F.col("doc_id").isNull().alias("none"), F.bitwise_not("_key").alias("down"))
    rows = rows.repartition("range").withColumn("own", sketch(F.col("text")))
    ordered = Window.partitionBy("range").orderBy("ghost", "none", "down", "text")
    of_one_id = Window.partitionBy("range", "ghost", "none", "down")
    following = F.lead(F.struct("ghost", "none", "down", "text", "own")).over(ordered)
    other = F.col("f.ghost") | (F.col("f.none") != F.col("none")) | (F.col("f.down") != F.col("down"))
    rows = rows.withColumn("f", following).withColumn("f", F.when(other, F.col("f")))
    rows = rows.withColumn("next", F.max("f").over(of_one_id))
    return rows.filter(~F.col("ghost")).select("doc_id", "text", "own", "next")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text and its successor in descending doc_id order.

    The edit replaces the last third (floor) of the code points by as many first ones of the next document, after the smallest
    doc_id by those of the largest.
    """
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next.text", F.lit(1), third))
    rows = with_successors(docs).withColumn("edited", edited)
    rows = rows.withColumn("changed", sketch(F.col("edited")))
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next.own")).alias("near_next"),
    )
