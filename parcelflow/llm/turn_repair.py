"""Conversation structure repair: the cheapest edits that make the roles of every conversation ``(s?(ua)+)?``.

*Faults.* Rows of a conversation are taken by turn (nulls first), then role, then SHA-256 of the text. Each has at most one fault: ``blank`` (nothing
but white space), ``duplicate`` (role and text stood in an earlier row of the conversation), ``truncated`` (the last character that is not white
space is none of ``.!?``). Blank and duplicate rows must go; a truncated row that stays costs 1.

*Edits* are those of ``turn_edits``: forward and backward four-state cost vectors meet mid-conversation, the ASCII-least of the cheapest crossings is
taken, and both halves are solved alike in linear space.

*Distribution.* Narrow rows (no text) are sorted into ranges, so a range holds whole conversations but for its first and last. A conversation
that spreads over ranges is solved as blocks: each block gives its 4 x 4 summary, the summaries of a conversation (at most one a range) give the
states between blocks, and the blocks are then solved in parallel like any other. Texts move once, to the task that writes their
conversation; they stream through it row by row, as SHA-256 demands, and are never held together.

Defined results: a null role or text is one space (blank, and no role that may stay); null turns come first and do not count among gaps; a null conv_id is
a conversation of its own; repeated rows are duplicates; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import shuffle_width, stored
from parcelflow.llm.turn_edits import (
    NOTHING,
    TAIL,
    USER,
    crossings,
    inserted,
    kept,
    kind_of,
    least_edits,
    summary,
)

FAULTS = ("", "blank", "duplicate", "truncated")
KEY = ("conv_id", "turn", "role", "digest")  # rows equal in these are copies
_WHITE = " \t\n\x0b\x0c\r"
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damage(turns: DataFrame) -> DataFrame:
    """Conversation rows with faults that the CRC-32 of ``conv_id:turn`` deals out; nulls are one space."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fault = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).filter("fault <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def plain_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the text's digest; a null role or text is one space."""
    rows = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _same(left: str, right: str, *columns: str) -> Column:
    """Equal columns, nulls included."""
    found = F.lit(True)
    for c in columns:
        found = found & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return found


def find_faults(turns: DataFrame) -> DataFrame:
    """(KEY, row, fault code): rows in order, numbered so that a range of numbers is a range of the order; no texts."""
    solid = F.rtrim("text", F.lit(_WHITE))
    cut_off = ~F.substring(solid, -1, 1).isin(".", "!", "?")
    state = F.when(solid == "", 1).when(cut_off, 3).otherwise(0)
    narrow = turns.select(*KEY, state.alias("fault"))
    width = shuffle_width(turns.sparkSession)
    ranges = narrow.repartitionByRange(width, *KEY).sortWithinPartitions(*KEY)
    rows = stored(ranges.withColumn("row", F.monotonically_increasing_id()), "turns")
    said = ["conv_id", "role", "digest"]
    again = rows.filter("fault <> 1").groupBy(*said).agg(F.min("row").alias("first"), F.count("*").alias("n")).filter("n > 1")
    joined = rows.alias("r").join(again.alias("a"), _same("r", "a", *said), "left")
    fault = F.when((F.col("fault") != 1) & (F.col("row") > F.col("first")), 2).otherwise(F.col("fault"))
    return stored(joined.select(*[f"r.{c}" for c in KEY], "row", fault.alias("fault")), "faults")


def _part() -> Column:
    return F.shiftright("row", 33)


def _in_order(rows: DataFrame) -> DataFrame:
    """The rows of a range together and in order again."""
    return rows.repartition(shuffle_width(rows.sparkSession), "part").sortWithinPartitions("row")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], bytes]]:
    """(rows, kinds) of each conversation within each range."""
    rows: list[pa.RecordBatch] = []
    kinds, now = bytearray(), None
    for batch in batches:
        names = list(zip(batch["part"].to_pylist(), batch["conv_id"].to_pylist(), strict=True))
        found = bytes(
            kind_of(role[:1], fault == 3, fault in (1, 2))
            for role, fault in zip(batch["role"].to_pylist(), batch["fault"].to_pylist(), strict=True)
        )
        edges = [i for i, name in enumerate(names) if name != (names[i - 1] if i else now)]
        for nth, (first, end) in enumerate(zip([0, *edges], [*edges, len(names)], strict=True)):
            if nth and rows:  # the first slice goes on with the batch before
                yield rows, bytes(kinds)
                rows, kinds = [], bytearray()
            if first < end:
                rows.append(batch.slice(first, end - first))
                kinds += found[first:end]
        now = names[-1] if names else now
    if rows:
        yield rows, bytes(kinds)


def _value(rows: list[pa.RecordBatch], column: str):
    return rows[0][column][0].as_py()


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, kinds in _blocks(batches):
        vectors = [number for vector in summary(kinds) for pair in vector for number in pair]
        columns = [pa.array([_value(rows, c)], pa.int64()) for c in ("conv_id", "part")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([vectors], pa.list_(pa.int64()))], ["conv_id", "part", "vectors"])


def _cross(blocks: pd.DataFrame) -> pd.DataFrame:
    blocks = blocks.sort_values("part")
    vectors = [
        [[(v[8 * s + 2 * q], v[8 * s + 2 * q + 1]) for q in range(4)] for s in range(4)]
        for v in ([int(x) for x in found] for found in blocks["vectors"])
    ]
    found = crossings(vectors)
    last = [i == len(found) - 1 for i in range(len(found))]
    return blocks[["conv_id", "part"]].assign(
        state=[s for s, _ in found], goal=[list(goal) for _, goal in found], ends=last
    )


def find_crossings(rows: DataFrame) -> DataFrame:
    """(conv_id, part, state, goal, ends) for the blocks of conversations that lie in several ranges."""
    named = F.struct(F.col("conv_id").alias("conv_id")).alias("c")
    edges = rows.groupBy("part").agg(F.min_by(F.struct("conv_id"), "row").alias("a"), F.max_by(F.struct("conv_id"), "row").alias("z"))
    ends = edges.select("part", F.explode(F.array_distinct(F.array("a", "z"))).alias("c")).select("part", "c.conv_id")
    split = ends.groupBy("conv_id").agg(F.count("*").alias("parts")).filter("parts > 1").select(named)  # at most one a range
    blocks = rows.alias("r").join(split.alias("s"), F.col("r.conv_id").eqNullSafe(F.col("s.c.conv_id")), "left_semi")
    summaries = _in_order(blocks).mapInArrow(_summarise, "conv_id long, part long, vectors array<long>")
    schema = "conv_id long, part long, state int, goal array<long>, ends boolean"
    return stored(summaries.groupBy("conv_id").applyInPandas(_cross, schema), "crossings")


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[pa.RecordBatch] = []
    letters: list[str] = []
    tails: list[str] = []

    def flush() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(done).select([*KEY, "row", "fault"])
        table = table.append_column("letters", pa.array(letters, pa.string())).append_column("tail", pa.array(tails, pa.string()))
        yield from table.combine_chunks().to_batches()
        for full in (done, letters, tails):
            full.clear()

    for rows, kinds in _blocks(batches):
        goal = _value(rows, "goal")
        if goal is None:  # a whole conversation
            found, state = least_edits(kinds)
        else:
            found, state = least_edits(kinds, _value(rows, "state"), tuple(goal))
        done += rows
        letters += found
        tails += [""] * (len(kinds) - 1) + [TAIL[state] if goal is None or _value(rows, "ends") else ""]
        if len(letters) >= 10_000:
            yield from flush()
    if done:
        yield from flush()


EDITS = "conv_id long, turn long, role string, digest binary, row long, fault int, letters string, tail string"


def find_edits(turns: DataFrame) -> DataFrame:
    """Every row of ``plain_turns`` without its text, with the letters of the edits that end with it.

    ``letters`` are insertions before the row and what becomes of it, ``tail`` the insertions after a conversation's last row.
    """
    rows = find_faults(turns).withColumn("part", _part())
    known = find_crossings(rows).alias("k")
    here = rows.alias("r").join(known, _same("r", "k", "conv_id", "part"), "left")
    return _in_order(here.select("r.*", "k.state", "k.goal", "k.ends")).mapInArrow(_solve, EDITS)


@dataclass
class Conversation:
    """What is known of a conversation so far; its repaired rows go into the digest and out."""

    conv_id: int | None
    state: int = NOTHING
    position: int = 0
    cost: int = 0
    illegal: int = 0
    turns: int = 0
    lowest: int | None = None
    highest: int | None = None
    initial: str | None = None
    faults: list[int] = field(default_factory=lambda: [0] * len(FAULTS))
    audit: list[str] = field(default_factory=list)
    digest: hashlib._Hash = field(default_factory=hashlib.sha256)

    def write(self, role: str, text: str) -> tuple:
        self.digest.update(("\n" if self.position else "").encode() + f"{role}:{text}".encode())
        self.position += 1
        return (self.conv_id, self.position - 1, role, text)

    def insert(self, text: str = "") -> tuple:
        role = "user" if inserted(self.state) == USER else "assistant"
        self.state = inserted(self.state)
        return self.write(role, text)

    def take(self, row: dict, letters: str, tail: str, fault: int) -> Iterator[tuple]:
        """Account for a row in order, and give the repaired rows it leads to."""
        initial = row["role"][:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        turn = row["turn"]
        if turn is not None:
            self.turns += turn != self.highest
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = turn
        self.faults[fault] += 1
        self.audit.append(letters + tail)
        self.cost += sum(COSTS[x] for x in letters + tail) + (fault == 3 and letters[-1] != "D")
        for letter in letters + tail:
            if letter == "I":
                yield self.insert()
            elif letter == "R":
                yield self.insert(row["text"])
            elif letter == "K":
                self.state = kept(self.state, initial)
                yield self.write(row["role"], row["text"])

    def figures(self) -> tuple:
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.turns
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def _write(batches: Iterator[pa.RecordBatch], each, done) -> None:
    """Stream edits and texts, sorted by key with a key's edits first; copies of a row take its edits in turn."""
    now, key, waiting = None, None, deque()
    for batch in batches:
        for row in batch.to_pylist():
            if now is None or row["conv_id"] != now.conv_id:
                if now is not None:
                    done(now)
                now, key, waiting = Conversation(row["conv_id"]), None, deque()
            if row["letters"] is not None:
                here = tuple(row[c] for c in KEY)
                if here != key:
                    key, waiting = here, deque()
                waiting.append((row["letters"], row["tail"], row["fault"]))
            else:
                for out in now.take(row, *waiting.popleft()):
                    each(out)
        yield
    if now is not None:
        done(now)
    yield


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 7 + [pa.string()] * 2
    names = ["conv_id", "gaps", *FAULTS[1:], "illegal", "cost", "audit", "repaired_sha256"]
    ready: list[tuple] = []
    for _ in _write(batches, lambda out: None, lambda conversation: ready.append(conversation.figures())):
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), types, strict=True)], names)
            ready.clear()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    ready: list[tuple] = []
    for _ in _write(batches, ready.append, lambda conversation: None):
        if ready:
            columns = [pa.array(c, t) for c, t in zip(zip(*ready), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "position", "role", "text"])
            ready.clear()


def _streamed(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits and texts of whole conversations in order; the texts' only shuffle."""
    none = {"row": "long", "fault": "int", "letters": "string", "tail": "string"}
    texts = turns.select(*KEY, *[F.lit(None).cast(t).alias(c) for c, t in none.items()], "text")
    both = edits.withColumn("text", F.lit(None).cast("string")).unionByName(texts)
    order = [*KEY, F.col("letters").isNull(), "row"]
    return both.repartition(shuffle_width(turns.sparkSession), "conv_id").sortWithinPartitions(*order)


def repair_figures(turns: DataFrame) -> DataFrame:
    """(conv_id, FIGURES): faults, cost and edits of every conversation that has rows."""
    plain = plain_turns(turns)
    return _streamed(plain, find_edits(plain)).mapInArrow(_figures, f"conv_id long, {FIGURES}")


def repair_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the repaired conversations."""
    plain = plain_turns(turns)
    return _streamed(plain, find_edits(plain)).mapInArrow(_repaired, "conv_id long, position long, role string, text string")
