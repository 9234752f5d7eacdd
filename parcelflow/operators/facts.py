"""Facts that follow changes of their inputs without being rebuilt.

A fact is a left row joined with other tables (left joins, fan-out included). Its stored rows keep the key of the left row they came
from. When inputs change, the fact's rows that must change are those of left rows that changed themselves, and those
whose join key occurs among the changed rows of a joined table: a match that came late also takes back the row that had
found none. The left rows concerned are joined again, and nothing else is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.operators.joins import with_key_in, without_key_in
from parcelflow.operators.versioned import VersionedTable

# Rows a part should hold; the number of parts is set when a fact is built in full.
ROWS_PER_PART = 4_000_000
# Beyond this share of changed left rows a full build costs less.
FULL_BUILD_SHARE = 0.25
# A task of a full build may write into this many parts; beyond it rows are gathered by part first.
_FILES_PER_TASK = 32


@dataclass(frozen=True)
class Input:
    """A table a fact is made from, and what it has become since."""

    table: VersionedTable
    key: str  # the fact's column that the table is joined on; for the left table its own key
    dimension: bool = False  # small: compared as a whole when it changed


class FactTable:
    """A fact in hash parts of ``part_key``, refreshed from the changes of its inputs.

    ``left`` gives for each column of the left rows the fact's column that holds it; ``event`` names the left rows' own
    key, which the stored rows carry and readers do not see if ``hidden``.
    """

    def __init__(self, spark: SparkSession, path: str, event: str, part_key: str, left: dict[str, str], hidden: bool):
        self.spark, self.event, self.part_key, self.left, self.hidden = spark, event, part_key, left, hidden
        self.table = VersionedTable(spark, path)

    def read(self) -> DataFrame:
        rows = self.table.read()
        return rows.drop(self.event) if self.hidden else rows

    def columns(self) -> list[str]:
        return [c for c in self.table.schema.fieldNames() if not (self.hidden and c == self.event)]

    def _part(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.part_key), F.lit(buckets)).cast("bigint") if buckets > 1 else F.lit(0).cast("bigint")

    def _parted(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.withColumn("part", self._part(buckets))

    def holding(self, keys: DataFrame) -> DataFrame:
        """The rows whose ``part_key`` is among the keys; only their parts are opened."""
        known = self.table.state().inputs
        rows = self.table.read(self._parts_of(keys, known["buckets"])) if known else self.table.read()
        return with_key_in(rows, keys, self.part_key)

    def _parts_of(self, keys: DataFrame, buckets: int) -> list[int] | None:
        """The parts of some keys, None for all."""
        return [r[0] for r in keys.select(self._part(buckets)).distinct().collect()] if buckets > 1 else None

    # --- refreshing --------------------------------------------------------

    def refresh(
        self,
        left: Input,
        joined: dict[str, Input],
        all_left: Callable[[], DataFrame],
        compute: Callable[[DataFrame, bool], DataFrame],
        buckets: int | None = None,
    ) -> str:
        """Bring the fact up to date in one commit; returns ``full``, ``changes`` or ``nothing``.

        ``compute(left rows, whole)`` makes fact rows of left rows; ``whole`` tells that these are all of them. ``buckets`` fixes the
        number of parts, otherwise it follows from the number of left rows.
        """
        states = {name: i.table.state() for name, i in {"": left, **joined}.items()}
        versions = {name: state.last for name, state in states.items()}
        state = self.table.state()
        known = state.inputs
        wanted = buckets or _parts_for(states[""].count())
        if known is None or set(known["versions"]) != set(versions) or not known["buckets"] <= wanted <= 4 * known["buckets"]:
            return self._build(all_left, compute, wanted, versions)
        if known["versions"] == versions:
            return "nothing"
        changed = {n: i for n, i in {"": left, **joined}.items() if versions[n] != known["versions"][n]}
        gained = states[""].gained(known["versions"][""])  # from the manifest, without a job
        if gained is not None and gained > FULL_BUILD_SHARE * states[""].count():
            return self._build(all_left, compute, wanted, versions)
        changes: dict[str, DataFrame] = {}
        try:
            for name, source in changed.items():
                rows = source.table.changes_since(known["versions"][name], source.key if name else None)
                if rows is None:
                    return self._build(all_left, compute, wanted, versions)
                # few rows next to the table, used several times
                changes[name] = (distinct_keys(rows, source.key) if name else rows).persist()
                if not source.dimension and changes[name].count() > FULL_BUILD_SHARE * states[name].count():
                    return self._build(all_left, compute, wanted, versions)
            return self._apply(changes, joined, compute, known["buckets"], versions)
        finally:
            for rows in changes.values():
                rows.unpersist()

    def _build(self, all_left, compute, buckets: int, versions: dict) -> str:
        rows = self._parted(compute(all_left(), True), buckets)
        if buckets > _FILES_PER_TASK:
            rows = rows.hint("rebalance", "part")  # else every task would write into every part
        before = {part for _, part in self.table.state().folders()}
        table = VersionedTable(self.spark, self.table.path, rows.drop("part").schema)
        table.commit(rows, sorted(before | set(range(buckets))), inputs={"versions": versions, "buckets": buckets})
        return "full"

    def _apply(self, changes: dict[str, DataFrame], joined: dict[str, Input], compute, buckets: int, versions: dict) -> str:
        inputs = {"versions": versions, "buckets": buckets}
        left = changes.get("")
        keys = [(joined[name].key, found) for name, found in changes.items() if name]
        gone = None if left is None else left.filter("added < 0").select(self.event).distinct()
        events = [self._events(column, found, buckets) for column, found in keys]
        if gone is not None:
            events.append(self._events(self.event, gone, buckets))
        new = None if left is None else left.filter("added > 0").drop("added")
        replaced: list[int] = []
        if events:
            # few next to the fact: those whose key changed
            touched = reduce(DataFrame.unionByName, events).distinct().persist()
            try:
                replaced = [r["part"] for r in touched.select("part").distinct().collect()]
                stored = self.table.with_part(replaced)
                concerned = touched.select(self.event).distinct()
                if replaced:
                    again = with_key_in(stored, concerned, self.event).dropDuplicates([self.event])
                    again = again.select(*[F.col(c).alias(name) for name, c in self.left.items()])
                    if gone is not None:
                        again = again.join(gone, self.event, "left_anti")
                    new = again if new is None else new.select(*again.columns).unionByName(again)
                if new is None:
                    self._note(inputs)
                    return "nothing"
                new = new.persist()  # few again, and read for their keys as well
                rows = self._parted(compute(new, False), buckets)
                if replaced:
                    rows = without_key_in(stored, concerned, self.event).unionByName(rows)
                    if buckets > _FILES_PER_TASK:
                        rows = rows.hint("rebalance", "part")
                self.table.commit(rows, replaced, inputs=inputs)
            finally:
                touched.unpersist()
                if new is not None:
                    new.unpersist()
        elif new is not None:
            self.table.commit(self._parted(compute(new, False), buckets), [], inputs=inputs)
        return "changes"

    def _events(self, column: str, keys: DataFrame, buckets: int) -> DataFrame:
        """(part, event) of the stored rows whose ``column`` is one of the keys."""
        parts = self._parts_of(keys, buckets) if column == self.part_key else None
        stored = self.table.with_part(parts).select("part", self.event, *({column} - {self.event}))
        return with_key_in(stored, keys, column).select("part", self.event)

    def _note(self, inputs: dict) -> None:
        """An empty commit that tells which versions the rows follow from."""
        nothing = self.table.read([]).withColumn("part", F.lit(0).cast("bigint"))
        self.table.commit(nothing, [], inputs=inputs)


def distinct_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key).filter(F.col(key).isNotNull()).distinct()


def _parts_for(rows: int) -> int:
    """A power of two, so that parts hold about ROWS_PER_PART."""
    return 1 << max(0, (rows - 1) // ROWS_PER_PART).bit_length()
